"""The two warehouse tables: build once, publish atomically, scan many times.

A dashboard refresh scans ``orders`` and ``order_items`` a few dozen times, so
they are materialised Parquet tables, exactly like the source system's loaded
tables. The build is keyed by the input files (path, length, modification
time) and by the adapter code, so a change to either yields a new build.

Layout: each table is range-partitioned on its sort key and sorted within
files (``orders`` on ``(user_id, order_id)``, ``order_items`` on
``(order_id, product_id)``). Range bounds split a hot key over several files,
so file sizes stay even however skewed the keys are; the Parquet min/max
statistics then prune point lookups by key. (Bucketing on ``user_id`` would
give shuffle-free per-user aggregation, but one hot user would become one hot
bucket scanned by a single task.)

Publication: build under a unique staging folder, then rename it to the keyed
folder. Intermediate results are written tables, so an executor lost late in
the build does not recompute the whole lineage.
"""

from __future__ import annotations

import hashlib
import inspect
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartscope.operators import sequence
from cartscope.schema import (
    ORDER_ITEMS_SCHEMA, ORDER_ITEMS_SORT_KEY, ORDERS_SCHEMA, ORDERS_SORT_KEY,
)
from cartscope.session import file_count, path_exists, rename_path, scratch_path, work_root
from cartscope.sources import fixtures

SOURCE_TABLES = ("orders", "lineitem", "part")


def _file_stamp(spark: SparkSession, path: str) -> str:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    st = fs.getFileStatus(p)
    return f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}"


def warehouse_key(spark: SparkSession, sf_dir: str) -> str:
    h = hashlib.sha1()
    for t in SOURCE_TABLES:
        h.update(_file_stamp(spark, f"{sf_dir.rstrip('/')}/{t}.parquet").encode())
    for mod in (fixtures, sequence, sys.modules[__name__]):
        h.update(inspect.getsource(mod).encode())
    return h.hexdigest()[:16]


def warehouse_path(spark: SparkSession, sf_dir: str) -> str:
    return f"{work_root(spark)}/cartscope/warehouse/{warehouse_key(spark, sf_dir)}"


def _files_for(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> int:
    """Files per output table, sized from the input tables it derives from."""
    return file_count(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables])


def write_sorted(df: DataFrame, path: str, sort_key: list[str], files: int,
                 mode: str = "overwrite", observation=None) -> None:
    """Range-partition on the sort key, sort inside each file, write Parquet.

    ``observation`` (a ``pyspark.sql.Observation``) counts the rows as they are
    written. It sits above the range exchange: the bound-sampling pass runs the
    plan below the exchange too, and an observation there would count twice.
    """
    ranged = df.repartitionByRange(files, *[F.col(c) for c in sort_key])
    if observation is not None:
        ranged = ranged.observe(observation, F.count(F.lit(1)).alias("n"))
    ranged.sortWithinPartitions(*sort_key).write.mode(mode).parquet(path, compression="zstd")


def build_warehouse(spark: SparkSession, sf_dir: str, dest: str) -> None:
    """Adapter -> ``dest/orders`` and ``dest/order_items`` (plus a lineage cut)."""
    # 1. per-customer numbering (several shuffles) is materialised once and
    #    read back twice: by the items join and by the final orders table.
    stage = scratch_path(spark, "stage")   # never published; left for retention
    seq_path = f"{stage}/orders_sequenced"
    fixtures.sequenced_orders(spark, sf_dir).write.mode("overwrite").parquet(seq_path, compression="zstd")
    seq = spark.read.parquet(seq_path)

    # 2. items: lineitem x orders x part, staged once (the reorder flag reads
    #    it twice: first purchase per (user, product), then the join back).
    joined_path = f"{stage}/items_joined"
    fixtures.joined_items(spark, sf_dir, seq).write.mode("overwrite").parquet(joined_path, compression="zstd")
    items = fixtures.with_reorder_flag(spark.read.parquet(joined_path))
    write_sorted(items, f"{dest}/order_items", ORDER_ITEMS_SORT_KEY,
                 _files_for(spark, sf_dir, ("lineitem", "part")))

    # 3. per-order totals from the written items; orders with none get 0.
    orders = fixtures.orders_with_totals(seq, spark.read.parquet(f"{dest}/order_items"))
    write_sorted(orders, f"{dest}/orders", ORDERS_SORT_KEY, _files_for(spark, sf_dir, ("orders",)))


_RESOLVED: dict[tuple[str, str], str] = {}


def ensure_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Path of a complete warehouse for ``sf_dir``; builds it when absent.

    A published build never changes, so its path is remembered per application.
    """
    memo = (spark.sparkContext.applicationId, sf_dir)
    if memo in _RESOLVED:
        return _RESOLVED[memo]
    final = warehouse_path(spark, sf_dir)
    if path_exists(spark, f"{final}/orders/_SUCCESS"):
        _RESOLVED[memo] = final
        return final
    staging = scratch_path(spark, "warehouse-staging")
    build_warehouse(spark, sf_dir, staging)
    if not rename_path(spark, staging, final):
        # another build published first; it is equivalent (same key)
        if not path_exists(spark, f"{final}/orders/_SUCCESS"):
            raise RuntimeError(f"could not publish warehouse to {final}")
    _RESOLVED[memo] = final
    return final


def warehouse_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(orders, order_items) scans of the materialised warehouse."""
    root = ensure_warehouse(spark, sf_dir)
    # declared schemas: no footer reads to infer them on every query
    return (spark.read.schema(ORDERS_SCHEMA).parquet(f"{root}/orders"),
            spark.read.schema(ORDER_ITEMS_SCHEMA).parquet(f"{root}/order_items"))


def warehouse_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table of the warehouse's data files with their key ranges (built once)."""
    from cartscope.sinks.versions import TABLES, file_table
    root = ensure_warehouse(spark, sf_dir)
    path = f"{root}-files"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        staging = scratch_path(spark, "file-tables")
        parts = [file_table(spark.read.schema(schema).parquet(f"{root}/{t}"), t) for t, (schema, _) in TABLES.items()]
        parts[0].unionByName(parts[1]).write.parquet(staging)
        if not rename_path(spark, staging, path) and not path_exists(spark, f"{path}/_SUCCESS"):
            raise RuntimeError(f"could not publish {path}")
    return spark.read.parquet(path)


def default_sf_dir() -> str:
    return os.environ.get("CARTSCOPE_SF_DIR", "/root/testdata/sf0.01")
