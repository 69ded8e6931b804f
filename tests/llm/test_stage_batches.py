"""What the pipeline's stages send to Python: each text once, searched in bounded chunks."""

import re

from pyspark.sql import functions as F

from cartscope.llm import decontaminate, language_id
from cartscope.llm.common import text_column

ITEM = "seven quick ravens crossed the frozen river before dawn while twelve lanterns burned"


def _docs(spark, kind="string"):
    words = "the old bridge near our village was built from grey stone by three brothers"
    rows = [(1, f"{words} {ITEM} {words}"), (2, words), (3, None), (None, f"{ITEM} {words}"), (2, words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select("doc_id", F.col("text").cast(kind).alias("text"), F.lit("en").alias("lang"))


def _bench(spark):
    return spark.createDataFrame([(1, ITEM)], "item_id long, text string")


def _sent(df):
    """Columns that go into ``mapInArrow``."""
    plan = df._jdf.queryExecution().analyzed().toString()
    return re.search(r"MapInArrow \w+\(([^)]*)\)", plan).group(1)


def test_a_text_travels_once(spark):
    docs = _docs(spark)
    assert text_column(docs, "text") == []
    sent = _sent(decontaminate.clean_documents(docs, _bench(spark)))
    assert sent.startswith("row#") and "," not in sent.split("#", 1)[1]
    sent = _sent(language_id.keep_identified(docs))
    assert sent.startswith("row#") and "," not in sent.split("#", 1)[1]


def test_texts_of_other_types_are_read_as_strings(spark):
    want = decontaminate.clean_documents(_docs(spark), _bench(spark)).select("doc_id", "text")
    got = decontaminate.clean_documents(_docs(spark, "binary"), _bench(spark))
    assert sorted((r["doc_id"], r["text"]) for r in want.fillna("", "text").collect()) == \
        [(2, want.first()["text"])] * 2 + [(3, "")]
    assert sorted((r["doc_id"], bytes(r["text"] or b"").decode()) for r in got.collect()) == \
        sorted((r["doc_id"], r["text"] or "") for r in want.collect())


def test_rows_do_not_depend_on_the_chunk(spark, monkeypatch):
    docs = _docs(spark).orderBy("doc_id")
    import pyarrow as pa
    texts = pa.array([r["text"] for r in docs.collect()], pa.string())
    vocabulary, classes = decontaminate.build_classes([(1, ITEM)])
    want = list(decontaminate._hits(texts, vocabulary, classes, decontaminate.RATE))
    monkeypatch.setattr(decontaminate, "HIT_BYTES", 64)
    assert want and list(decontaminate._hits(texts, vocabulary, classes, decontaminate.RATE)) == want
