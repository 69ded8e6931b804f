"""The fused dashboard refresh returns exactly what the direct queries return."""

from conftest import SF_SMALL


def test_refresh_equals_direct_queries(spark):
    from cartscope.plans.dashboard import refresh
    from cartscope.registry import QUERIES, REGISTERED_KEYWORD
    from cartscope.sources.warehouse import warehouse_tables
    orders, items = warehouse_tables(spark, SF_SMALL)
    fused = refresh(spark, orders, items, keyword=REGISTERED_KEYWORD)
    assert len(fused) == 36
    for name, df in fused.items():
        direct = QUERIES[name](spark, SF_SMALL)
        assert df.columns == direct.columns, name
        a = [tuple(r) for r in df.collect()]
        b = [tuple(r) for r in direct.collect()]
        assert a == b, name   # same rows in the same order


def test_batches_add_up_to_a_refresh(spark, scratch):
    """After three batches, cut so that users, products and cells span them, all
    series equal those of the whole tables; a repeated batch counts once."""
    import os
    import uuid

    from pyspark.sql import functions as F

    from cartscope.plans.dashboard import add_batch, direct, incremental
    from cartscope.sources.warehouse import warehouse_tables
    orders, items = warehouse_tables(spark, SF_SMALL)
    state = os.path.join(scratch, uuid.uuid4().hex)
    for k in (0, 1, 2, 2):
        mine = F.col("order_id") % 3 == k
        add_batch(spark, state, str(k), orders.filter(mine), items.filter(mine))
    found, plain = incremental(spark, state), direct(orders, items)
    assert len(found) == 36
    for name, df in found.items():
        assert [tuple(r) for r in df.collect()] == [tuple(r) for r in plain[name].collect()], name


def test_one_scan_of_each_table(spark):
    from cartscope.plans.dashboard import cubes
    from cartscope.sources.warehouse import warehouse_tables
    for cube in cubes(*warehouse_tables(spark, SF_SMALL)).values():
        plan = cube._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and "Expand" in plan


def test_exact_mean_is_the_same_in_any_order(spark):
    from pyspark.sql import functions as F

    from cartscope.functions.exact import exact_mean
    values = [(0.1,), (1e7 / 3,), (0.7,), (100 / 3,), (200 / 3,), (None,), (1e-7,), (54321.05,)] * 37
    df = spark.createDataFrame(values, "v double")
    got = {df.repartition(n).orderBy(F.rand(n)).agg(exact_mean(F.col("v")).alias("m")).first()["m"] for n in (1, 3, 7)}
    assert len(got) == 1
    known = [v for v, in values if v is not None]
    assert abs(got.pop() - sum(known) / len(known)) < 1e-6
    assert spark.createDataFrame([(None,)], "v double").agg(exact_mean(F.col("v")).alias("m")).first()["m"] is None


def test_empty_tables_give_the_same_series(spark):
    from cartscope.plans.dashboard import direct, refresh
    from cartscope.sources.warehouse import warehouse_tables
    orders, items = (t.limit(0) for t in warehouse_tables(spark, SF_SMALL))
    fused, plain = refresh(spark, orders, items), direct(orders, items)
    assert set(fused) == set(plain)
    for name in plain:
        assert [tuple(r) for r in fused[name].collect()] == [tuple(r) for r in plain[name].collect()], name
