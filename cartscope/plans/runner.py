"""The order pipeline as one Spark application: ingest -> flatten -> load -> validate.

Stages map to the source pipeline's tasks (extract, transform, load,
validate); there are no local temp files, so there is no cleanup task. The landing
is parsed once into a written table (``plans.staging``) that feeds both outputs, the
rejects and the counts. ``plans.loads`` has the same run with versions that change
both tables at once and a ledger of every step.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartscope.operators import validate as V
from cartscope.plans.staging import stage_landing
from cartscope.session import file_count
from cartscope.sinks.tables import load


@dataclass
class EtlResult:
    warehouse: str
    rejects: str
    validation: DataFrame          # V1 rows
    nonempty: DataFrame            # V2 rows
    summary: DataFrame             # S2 row: documents, found, claimed, unreadable


def run_etl(spark: SparkSession, landing: str, warehouse: str,
                 mode: str = "lenient", load_mode: str = "overwrite",
                 multi_line: bool = False, fail_on_invalid: bool = True,
                 require_nonempty: bool = False, skip_empty: bool = False,
                 fail_on_bad_documents: bool = True) -> EtlResult:
    """Flatten every landed payload document under ``landing`` into
    ``warehouse/orders`` and ``warehouse/order_items``; rejects go to
    ``warehouse/_rejects``, written with the load's mode. A document that can't
    be read (not JSON, beyond the VARIANT limit of 128 MiB, or of a shape that
    holds no orders) fails the run before anything is loaded; with
    ``fail_on_bad_documents=False`` it is a reject. Raises when the count reconciliation fails
    (``fail_on_invalid``, the scheduled pipeline's check) and, with
    ``require_nonempty``, when a loaded table is empty (the runner's check).
    ``skip_empty`` leaves a table untouched when the transform produced no rows
    for it (the scheduled pipeline's load); its expected count is then 0."""
    staged = stage_landing(spark, landing, mode, multi_line)
    seen = staged.seen
    n_bad = seen["unreadable"]
    summary = spark.createDataFrame(
        [(seen["documents"], seen["found"], seen["claimed"], n_bad)],
        "documents long, order_count long, total_orders long, unreadable_documents long"
    ).withColumn("fetched_at", F.current_timestamp())
    rejects_path = f"{warehouse}/_rejects"
    if n_bad and fail_on_bad_documents:
        failed = f"{warehouse}/_rejects_failed/{uuid.uuid4().hex}"  # those of the last good run stay
        staged.rejects().write.parquet(failed)
        raise ValueError(f"{n_bad} unreadable documents, see {failed}; nothing was loaded")
    staged.rejects().write.mode(load_mode).parquet(rejects_path)
    paths = load(staged.orders(), staged.items(), warehouse, load_mode,
                 files=file_count(spark, [staged.path]), skip_empty=skip_empty)
    # counted while the landing was parsed, before the load
    expected = spark.createDataFrame(
        [(t, seen[f"{name}_accepted"] if t in paths else 0) for t, name in (("orders", "orders"), ("order_items", "items"))],
        "table_name string, n long")
    loaded = V.count_table(spark, [(t, spark.read.parquet(p)) for t, p in paths.items()])
    checks = V.validate_counts(expected, loaded)
    nonempty = V.validate_nonempty(loaded)
    if fail_on_invalid:
        V.assert_valid(checks, "count reconciliation")
    if require_nonempty:
        V.assert_valid(nonempty, "non-empty check")
    return EtlResult(warehouse, rejects_path, checks, nonempty, summary)
