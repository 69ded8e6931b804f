"""Load validation and verification queries (V1–V5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartscope.schema import ORDER_ITEMS_COLUMNS, ORDERS_SORT_KEY


def _count(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("table_name"), "n")


def count_table(spark: SparkSession, pairs: list[tuple[str, DataFrame]]) -> DataFrame:
    """One row per table: ``table_name``, ``n`` (one aggregate per table, unioned)."""
    out = None
    for table, df in pairs:
        c = _count(df, table)
        out = c if out is None else out.unionByName(c)
    if out is None:
        out = spark.createDataFrame([], "table_name string, n long")
    return out


def validate_counts(expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """V1: loaded vs transformed rows per table.

    ``expected`` and ``loaded`` are ``count_table`` results. A table passes when
    ``loaded >= expected``; it is not checked when nothing was expected (0).
    Surplus rows pass (the check does not see duplicates from an append rerun).
    """
    e = expected.withColumnRenamed("n", "expected")
    l_ = loaded.withColumnRenamed("n", "loaded")
    j = e.join(l_, "table_name", "full")
    ok = F.when(F.coalesce(F.col("expected"), F.lit(0)) == 0, F.lit(True)) \
          .otherwise(F.coalesce(F.col("loaded"), F.lit(0)) >= F.col("expected"))
    return j.select("table_name",
                    F.coalesce("expected", F.lit(0)).cast("long").alias("expected"),
                    F.coalesce("loaded", F.lit(0)).cast("long").alias("loaded"),
                    ok.alias("ok"))


def validate_nonempty(counts: DataFrame) -> DataFrame:
    """V2: every table must hold at least one row."""
    return counts.select("table_name", F.col("n").alias("row_count"),
                         (F.col("n") > 0).alias("ok"))


def assert_valid(result: DataFrame, what: str) -> None:
    """Raise in a job when any row of a V1/V2 result fails (driver gets flags only)."""
    bad = result.filter(~F.col("ok")).select("table_name").collect()
    if bad:
        raise ValueError(f"{what} failed for: {', '.join(r.table_name for r in bad)}")


def table_counts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """V3: ``tabel``, ``total`` per table."""
    return (orders.agg(F.count(F.lit(1)).alias("total")).select(F.lit("orders").alias("tabel"), "total")
            .unionByName(items.agg(F.count(F.lit(1)).alias("total"))
                         .select(F.lit("order_items").alias("tabel"), "total")))


def sample_orders(orders: DataFrame, n: int = 5) -> DataFrame:
    """V4: first rows of ``orders`` in sort-key order (top-k, no full sort)."""
    return orders.orderBy(*[F.col(c).asc_nulls_last() for c in ORDERS_SORT_KEY]).limit(n)


def sample_order_items(items: DataFrame, n: int = 5) -> DataFrame:
    """V5: first rows of ``order_items``; every column breaks ties, because the
    sort key (order_id, product_id) repeats."""
    return items.orderBy(*[F.col(c).asc_nulls_last() for c in ORDER_ITEMS_COLUMNS]).limit(n)
