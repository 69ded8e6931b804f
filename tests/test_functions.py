
import pytest
from pyspark.sql import functions as F

CASES = [  # JSON value of "a", lenient int, strict int
    ('12', 12, 12), ('"12"', 12, 12), ('" 12 "', 12, 12), ('1.7', 1, None),
    ('-1.7', -1, None), ('"1.7"', 0, None), ('"x"', 0, None), ('""', 0, None),
    ('true', 1, None), ('null', 0, None),
]


@pytest.mark.parametrize("js,lenient,strict", CASES)
def test_int_coercion(spark, js, lenient, strict):
    from cartscope.functions import safe_int, strict_int
    df = spark.createDataFrame([(f'{{"a": {js}}}',)], "j string").select(F.parse_json("j").alias("v"))
    r = df.select(safe_int(F.col("v"), "$.a").alias("l"), strict_int(F.col("v"), "$.a").alias("s")).first()
    assert (r.l, r.s) == (lenient, strict)


def test_missing_key_defaults(spark):
    from cartscope.functions import safe_float, safe_int
    df = spark.createDataFrame([("{}",)], "j string").select(F.parse_json("j").alias("v"))
    r = df.select(safe_int(F.col("v"), "$.a").alias("i"), safe_float(F.col("v"), "$.a").alias("f")).first()
    assert (r.i, r.f) == (0, None)


@pytest.mark.parametrize("js,expected", [('7.5', 7.5), ('"7.5"', 7.5), ('"abc"', None),
                                         ('null', None), ('"NaN"', None)])
def test_float_coercion(spark, js, expected):
    from cartscope.functions import safe_float
    df = spark.createDataFrame([(f'{{"a": {js}}}',)], "j string").select(F.parse_json("j").alias("v"))
    assert df.select(safe_float(F.col("v"), "$.a")).first()[0] == expected


def test_clean_text_and_day_names(spark):
    from cartscope.functions import clean_text, dow_name
    df = spark.createDataFrame([("\t A \n", 0), ("　b ", 6), ("c", 9), (None, None)],
                               "s string, d int")
    got = [tuple(r) for r in df.select(clean_text("s"), dow_name("d")).collect()]
    assert got == [("A", "Sunday"), ("b", "Saturday"), ("c", "Unknown"), (None, "Unknown")]


def test_half_even_rates(spark):
    from cartscope.functions import rate_pct, ratio_pct
    df = spark.createDataFrame([(1, 16, 0.0625), (1, 8, 0.125)], "r long, n long, m double")
    got = [tuple(x) for x in df.select(rate_pct(F.col("r"), F.col("n")), ratio_pct(F.col("m"))).collect()]
    assert got == [(6.2, 6.2), (12.5, 12.5)]
