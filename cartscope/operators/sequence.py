"""Skew-safe numbering of rows within a group.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` plus ``lag`` puts every
row of one key into one task. If one key holds a third of the data, that task
holds a third of the data. This operator computes the same two columns while
splitting any key across many tasks:

1. range-partition on ``(key, *order)`` — the sampled range bounds cut a hot
   key into several slices, each a contiguous run of its ordering;
2. number rows and take the lag inside each ``(slice, key)`` run — groups are
   bounded by slice size;
3. per ``(key, slice)`` keep the run length and the last row's value (read
   off the run's last row, same partitioning) — at most ``#keys + #slices``
   rows — and turn them into a starting offset and the predecessor of each run
   with a window over ``key`` (≤ #slices rows per key);
4. join the offsets back on ``(key, slice)``.

The slicing is cut from its lineage with a reliable ``checkpoint()`` (to the
folder named by ``spark.checkpoint.dir``): steps 2 and 3 read it in two plan
branches, and a recomputed range exchange would sample new bounds, so both
must see one fixed assignment of rows to slices — also after an executor loss.

The result equals the plain window (ties in ``order`` must be broken by the
caller, as for any deterministic ``row_number``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartscope.session import work_root


def number_within_groups(df: DataFrame, key: str, order: list[str], lag_col: str,
                         seq_name: str = "seq", prev_name: str = "prev",
                         slices: int | None = None) -> DataFrame:
    """Add ``seq_name`` (1-based position of the row in its ``key`` group by
    ``order``) and ``prev_name`` (``lag_col`` of the preceding row, NULL for
    the first)."""
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols: list[Column] = [F.col(c) for c in order]

    work_root(spark)  # makes sure a checkpoint folder is configured
    sliced = (df.repartitionByRange(n, F.col(key), *order_cols)
                .withColumn("_slice", F.spark_partition_id())
                .checkpoint(eager=True))
    w_local = Window.partitionBy("_slice", key).orderBy(*order_cols)
    w_run = Window.partitionBy("_slice", key)
    local = (sliced
             .withColumn("_lrn", F.row_number().over(w_local))
             .withColumn("_lprev", F.lag(lag_col).over(w_local))
             .withColumn("_n", F.count(F.lit(1)).over(w_run)))

    # the last row of each run carries its length and last value; both windows
    # share one partitioning and sort, so this needs no further shuffle or sort
    runs = (local.filter(F.col("_lrn") == F.col("_n"))
                 .select(key, "_slice", "_n", F.col(lag_col).alias("_last")))
    w_runs = Window.partitionBy(key).orderBy("_slice")
    offsets = (runs
               .withColumn("_offset", F.coalesce(
                   F.sum("_n").over(w_runs.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
               .withColumn("_run_prev", F.lag("_last").over(w_runs))
               .select(key, "_slice", "_offset", "_run_prev"))

    out = (local.join(offsets, [key, "_slice"], "inner")
                .withColumn(seq_name, (F.col("_lrn") + F.col("_offset")).cast("long"))
                .withColumn(prev_name, F.when(F.col("_lrn") == 1, F.col("_run_prev"))
                                        .otherwise(F.col("_lprev")))
                .drop("_slice", "_lrn", "_lprev", "_n", "_offset", "_run_prev"))
    return out
