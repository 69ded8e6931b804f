"""Warehouse loads (W3, W4) and table DDL.

``load`` writes ``orders`` first, then ``order_items``, like the source
pipeline. The default is a snapshot *overwrite*: re-running the same load (a
retry, a daily re-fetch of the full payload) leaves the tables unchanged. The
source's plain append (which doubles rows on every rerun) stays available as
``mode="append"``.

Layout is the one of ``sources.warehouse``: range-partitioned on the sort key,
sorted within files. Nulls that raw-mode staging carries into NOT NULL columns
become the type default on load (0 / ''), as the source warehouse does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartscope.operators.normalize import fill_load_defaults
from cartscope.session import make_dirs, work_root
from cartscope.schema import (
    ORDER_ITEMS_SCHEMA, ORDER_ITEMS_SORT_KEY, ORDERS_SCHEMA, ORDERS_SORT_KEY,
)
from cartscope.sources.warehouse import write_sorted

LOAD_MODES = ("overwrite", "append")
SORT_KEYS = {"orders": ORDERS_SORT_KEY, "order_items": ORDER_ITEMS_SORT_KEY}
SCHEMAS = {"orders": ORDERS_SCHEMA, "order_items": ORDER_ITEMS_SCHEMA}


def _files(spark: SparkSession) -> int:
    """Default file count when the caller does not size the load (pass
    ``files=session.file_count(spark, input_paths)`` for large inputs)."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism)


def load_table(df: DataFrame, table: str, dest: str, mode: str = "overwrite",
               files: int | None = None, observation=None) -> str:
    """Write one flat table into ``dest/<table>`` (``append`` or ``overwrite``).
    ``observation`` receives the written row count as ``n`` (no second pass)."""
    if mode not in LOAD_MODES:
        raise ValueError(f"mode must be one of {LOAD_MODES}")
    path = f"{dest}/{table}"
    n = files or _files(df.sparkSession)
    write_sorted(fill_load_defaults(df, table), path, SORT_KEYS[table], n, mode=mode,
                 observation=observation)
    return path


def load(orders: DataFrame, items: DataFrame, dest: str, mode: str = "overwrite",
         skip_empty: bool = False, observations: dict | None = None,
         files: int | None = None) -> dict[str, str]:
    """Load both tables, orders first. With ``skip_empty`` an empty input
    table is not written (the scheduled pipeline's behaviour)."""
    out = {}
    obs = observations or {}
    for table, df in (("orders", orders), ("order_items", items)):
        if skip_empty and df.isEmpty():
            continue
        out[table] = load_table(df, table, dest, mode, files=files, observation=obs.get(table))
    return out


def _ddl_columns(table: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
                     for f in SCHEMAS[table].fields)


def create_database(spark: SparkSession, database: str = "ecommerce",
                    location: str | None = None) -> None:
    """Create the database if absent, located under the shared work folder
    unless ``location`` says otherwise (never in the process's current folder)."""
    loc = location or f"{work_root(spark)}/cartscope/databases/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{loc}'")


def create_table(spark: SparkSession, table: str, name: str, location: str) -> None:
    """Create ``orders`` / ``order_items`` if absent, as an external
    Parquet table at ``location``."""
    make_dirs(spark, location)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl_columns(table)}) "
              f"USING parquet LOCATION '{location}'")


def insert_into(df: DataFrame, table: str, name: str, overwrite: bool = False,
                files: int | None = None) -> None:
    """Insert into a created table in its sort-key layout."""
    from pyspark.sql import functions as F
    n = files or _files(df.sparkSession)
    key = SORT_KEYS[table]
    (fill_load_defaults(df, table)
        .repartitionByRange(n, *[F.col(c) for c in key])
        .sortWithinPartitions(*key)
        .write.insertInto(name, overwrite=overwrite))
