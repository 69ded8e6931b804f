"""ETL, sink and validation operators as registered queries.

Each takes ``(spark, sf_dir)``; inputs are the payload landed from the
warehouse tables of ``sf_dir`` (``sources.payload_fixture``). Sink queries
write to a fresh folder under the shared work folder and return what they
read back. Run-time stamps are left out of the returned columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartscope.operators import validate as V
from cartscope.operators.normalize import Flattened, flatten, transform_summary
from cartscope.plans import dashboard
from cartscope.plans.loads import load_version, merge_version
from cartscope.plans.staging import stage_landing
from cartscope.schema import ORDER_ITEMS_COLUMNS, ORDERS_SORT_KEY
from cartscope.session import file_count, scratch_path, work_root
from cartscope.sinks import files as sink_files
from cartscope.sinks import tables as sink_tables
from cartscope.sinks import versions
from cartscope.sources import payload as P
from cartscope.sources import payload_fixture as fixture
from cartscope.sources.payload_fixture import ensure_landing
from cartscope.sources.warehouse import warehouse_files, warehouse_key, warehouse_tables
from cartscope.streaming import start_ingest, start_merge_ingest


def _flat(spark: SparkSession, sf_dir: str, mode: str = "lenient") -> Flattened:
    return flatten(P.read_orders_payload(spark, ensure_landing(spark, sf_dir), mode=mode), mode)


# ------------------------------------------------------------------- sources

def q_read_orders_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order of every landed document."""
    o = P.read_orders_payload(spark, ensure_landing(spark, sf_dir))
    return o.select(
        F.try_variant_get("o", "$.order_id", "bigint").alias("order_id"),
        F.try_variant_get("o", "$.user_id", "bigint").alias("user_id"),
        F.size(F.coalesce(F.try_variant_get("o", "$.products", "array<variant>"),
                          F.array().cast("array<variant>"))).alias("n_products"))


def q_payload_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, orders found, orders claimed."""
    return P.payload_summary(P.read_documents(spark, ensure_landing(spark, sf_dir)),
                             with_timestamp=False)


def q_read_flat_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: flat items written as NDJSON staging and read back with the schema."""
    flat = _flat(spark, sf_dir)
    dest = scratch_path(spark, "staging")
    paths = sink_files.write_flat_staging(flat.orders, flat.items, dest)
    return P.read_flat_staging(spark, paths["order_items"], "order_items")


# --------------------------------------------------------------------- flatten

def q_flatten_orders(spark, sf_dir):
    """Lenient flatten, orders."""
    return _flat(spark, sf_dir).orders


def q_flatten_order_items(spark, sf_dir):
    """Lenient flatten, one row per product carrying order and user ids."""
    return _flat(spark, sf_dir).items


def q_dow_name(spark, sf_dir):
    """Day index -> name (unknown indexes -> Unknown), with order counts."""
    o = _flat(spark, sf_dir).orders
    return o.groupBy("order_dow", "order_dow_name").agg(F.count(F.lit(1)).alias("orders"))


def q_total_items(spark, sf_dir):
    """T4: products per order (0 for an empty or absent list)."""
    return _flat(spark, sf_dir).orders.select("order_id", "total_items")


def q_total_reordered(spark, sf_dir):
    """T5: products per order whose reordered value is 1."""
    return _flat(spark, sf_dir).orders.select("order_id", "total_reordered")


def q_safe_int(spark, sf_dir):
    """Integer coercion of order scalars (quoted numbers, fractions)."""
    return _flat(spark, sf_dir).orders.select("order_id", "order_number", "order_dow",
                                             "order_hour_of_day")


def q_safe_float(spark, sf_dir):
    """Gap-day coercion (quoted numbers, junk -> NULL)."""
    return _flat(spark, sf_dir).orders.select("order_id", "days_since_prior_order")


def q_clean_text(spark, sf_dir):
    """Product texts stripped of surrounding whitespace."""
    return _flat(spark, sf_dir).items.select("order_id", "product_id", "add_to_cart_order",
                                            "product_name", "aisle", "department")


def q_default_fields(spark, sf_dir):
    """Defaults for absent fields (eval_set -> prior, products -> none)."""
    return _flat(spark, sf_dir).orders.select("order_id", "eval_set", "total_items")


def q_flatten_orders_raw(spark, sf_dir):
    """Raw-mode flatten, orders that pass."""
    return _flat(spark, sf_dir, "raw").orders


def q_flatten_order_items_raw(spark, sf_dir):
    """Raw-mode flatten, items of orders that pass."""
    return _flat(spark, sf_dir, "raw").items


def q_flatten_rejects(spark, sf_dir):
    """Raw-mode rejects with their reason (record text left out)."""
    return _flat(spark, sf_dir, "raw").rejects.select("mode", "stage", "reason", "order_id")


def q_transform_summary(spark, sf_dir):
    """Output row counts."""
    return transform_summary(_flat(spark, sf_dir), with_timestamp=False)


# ----------------------------------------------------------------------- sinks

def q_land_raw(spark, sf_dir):
    """Landed documents copied to bronze unchanged, then counted."""
    dest = scratch_path(spark, "bronze")
    sink_files.land_raw(spark, ensure_landing(spark, sf_dir), dest)
    return P.payload_counts(P.read_documents(spark, dest))


def q_write_flat_staging(spark, sf_dir):
    """Both staging outputs written, read back and counted."""
    flat = _flat(spark, sf_dir)
    paths = sink_files.write_flat_staging(flat.orders, flat.items, scratch_path(spark, "staging"))
    return V.count_table(spark, [(t, P.read_flat_staging(spark, p, t)) for t, p in paths.items()]) \
            .withColumnRenamed("n", "row_count")


def _counts(version_files: DataFrame) -> DataFrame:
    return version_files.groupBy("table_name").agg(F.sum("rows").alias("row_count"))


def q_load_append(spark, sf_dir):
    """The same load appended twice doubles the tables (source behaviour)."""
    dest = scratch_path(spark, "load-append")
    for _ in range(2):
        done = load_version(spark, ensure_landing(spark, sf_dir), dest, load_mode="append")
    return _counts(spark.read.parquet(done.version.files))


def q_load_snapshot(spark, sf_dir):
    """The same load run twice as a snapshot leaves one copy; returns the rows
    of both tables."""
    dest = scratch_path(spark, "load-snapshot")
    for _ in range(2):
        done = load_version(spark, ensure_landing(spark, sf_dir), dest)
    tables = [versions.read_table(spark, dest, t, done.version).withColumn("table_name", F.lit(t))
              for t in versions.TABLES]
    return tables[0].unionByName(tables[1], allowMissingColumns=True)


def _merged(spark, dest: str) -> DataFrame:
    """Orders of the newest version with the items loaded for each."""
    items = versions.read_table(spark, dest, "order_items").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("loaded_items"))
    return (versions.read_table(spark, dest, "orders").join(items, "order_id", "left")
            .withColumn("loaded_items", F.coalesce("loaded_items", F.lit(0).cast("long"))))


def q_load_merge(spark, sf_dir):
    """W3, keyed: a delivery of every fifth document, some orders changed, merged
    into a full load; files without a delivered order are kept."""
    orders, items = warehouse_tables(spark, sf_dir)
    dest, landing = scratch_path(spark, "load-merge"), scratch_path(spark, "landing-part")
    load_version(spark, ensure_landing(spark, sf_dir), dest)
    docs = fixture.payload_documents(*fixture.redelivery(orders, items), ids=True,
                                     parts=fixture.deal_count(spark, sf_dir))
    fixture.land(docs.filter("doc_id % 5 = 0"), landing)
    merge_version(spark, stage_landing(spark, landing), dest)
    return _merged(spark, dest)


def _created_table(spark, sf_dir, table: str) -> DataFrame:
    staged = stage_landing(spark, ensure_landing(spark, sf_dir))
    db = "ecommerce"
    sink_tables.create_database(spark, db)
    key = warehouse_key(spark, sf_dir)
    name = f"`{db}`.`{table}_{key}`"
    sink_tables.create_table(spark, table, name, f"{work_root(spark)}/cartscope/tables/{table}-{key}")
    sink_tables.insert_into(staged.orders() if table == "orders" else staged.items(), table, name, overwrite=True,
                            files=file_count(spark, [staged.path]))
    return spark.table(name)


def q_orders_table(spark, sf_dir):
    """Database + orders table created if absent, loaded, scanned."""
    return _created_table(spark, sf_dir, "orders")


def q_order_items_table(spark, sf_dir):
    """Database + order_items table created if absent, loaded, scanned."""
    return _created_table(spark, sf_dir, "order_items")


# ------------------------------------------------------------------ validation

def q_validate_counts(spark, sf_dir):
    """V1: loaded vs transformed rows per table."""
    done = load_version(spark, ensure_landing(spark, sf_dir), scratch_path(spark, "load-validate"))
    return done.ledger.filter("step = 'loaded'").select(
        "table_name", "expected", F.col("actual").alias("loaded"), "ok")


def q_validate_nonempty(spark, sf_dir):
    """V2: both loaded tables hold rows."""
    done = load_version(spark, ensure_landing(spark, sf_dir), scratch_path(spark, "load-validate"))
    return _counts(spark.read.parquet(done.version.files)).withColumn("ok", F.col("row_count") > 0)


def q_reconcile_ledger(spark, sf_dir):
    """What every step of a load took in and gave out."""
    return load_version(spark, ensure_landing(spark, sf_dir), scratch_path(spark, "load-ledger")).ledger


def q_document_rejects(spark, sf_dir):
    """Documents that can't hold orders, with the reason (record text left out)."""
    landing = scratch_path(spark, "landing-damaged")
    fixture.land(fixture.damaged_documents(*warehouse_tables(spark, sf_dir),
                                           parts=fixture.deal_count(spark, sf_dir)), landing)
    return (stage_landing(spark, landing).rejects().filter("stage = 'document'")
            .select("mode", "stage", "reason", "order_id"))


def q_table_counts(spark, sf_dir):
    """V3: per-table counts of the warehouse."""
    return V.table_counts(*warehouse_tables(spark, sf_dir))


def q_sample_orders(spark, sf_dir):
    """V4: five orders in sort-key order, from the files that can hold them."""
    return versions.first_rows(warehouse_files(spark, sf_dir), "orders", 5, ORDERS_SORT_KEY)


def q_sample_order_items(spark, sf_dir):
    """V5: five items, fully tie-broken, from the files that can hold them."""
    return versions.first_rows(warehouse_files(spark, sf_dir), "order_items", 5, ORDER_ITEMS_COLUMNS)


#: The customer whose orders the registered lookup reads.
LOOKUP_USER = 7


def q_lookup_user_orders(spark, sf_dir):
    """W6's sort key as an index: all orders of one customer."""
    return versions.lookup(warehouse_files(spark, sf_dir), "orders", "user_id", LOOKUP_USER, LOOKUP_USER)


def q_incremental_ingest(spark, sf_dir):
    """Daily run as a stream: every landed file flattened and loaded once
    (availableNow trigger, file-source checkpoint); returns the loaded orders."""
    dest = scratch_path(spark, "stream-warehouse")
    start_ingest(spark, ensure_landing(spark, sf_dir), dest,
                 checkpoint=scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.parquet(f"{dest}/orders").drop("ingest_batch")


def q_ingest_redelivery(spark, sf_dir):
    """Daily run on a source that delivers everything again: a first delivery, then
    all orders once more, some changed and some new; returns each order once."""
    orders, items = warehouse_tables(spark, sf_dir)
    landing, dest = scratch_path(spark, "landing-daily"), scratch_path(spark, "merge-warehouse")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    for delivered in (fixture.first_delivery(orders, items), fixture.redelivery(orders, items)):
        fixture.land(fixture.payload_documents(*delivered, parts=fixture.deal_count(spark, sf_dir)), landing,
                     mode="append")
        start_merge_ingest(spark, landing, dest, checkpoint=checkpoint).awaitTermination()
    return _merged(spark, dest)


# ------------------------------------------------------------------- dashboard

#: The report's keyword does not occur in the test data's product names.
DASHBOARD_KEYWORD = "rod"


def q_dashboard_refresh(spark, sf_dir):
    """All dashboard series as text rows, from one scan of each table."""
    return dashboard.as_rows(dashboard.refresh(spark, *warehouse_tables(spark, sf_dir), DASHBOARD_KEYWORD))


def q_dashboard_incremental(spark, sf_dir):
    """The same from three batches of orders, each scanned once and then merged."""
    orders, items = warehouse_tables(spark, sf_dir)
    state = scratch_path(spark, "dashboard-state")
    for k in range(3):
        mine = F.col("order_id") % 3 == k
        dashboard.add_batch(spark, state, str(k), orders.filter(mine), items.filter(mine))
    return dashboard.as_rows(dashboard.incremental(spark, state, DASHBOARD_KEYWORD))


ETL_QUERIES = {
    "read_orders_payload": q_read_orders_payload,
    "payload_summary": q_payload_summary,
    "read_flat_staging": q_read_flat_staging,
    "land_raw": q_land_raw,
    "write_flat_staging": q_write_flat_staging,
    "load_append": q_load_append,
    "load_snapshot": q_load_snapshot,
    "load_merge": q_load_merge,
    "orders_table": q_orders_table,
    "order_items_table": q_order_items_table,
    "flatten_orders": q_flatten_orders,
    "flatten_order_items": q_flatten_order_items,
    "dow_name": q_dow_name,
    "total_items": q_total_items,
    "total_reordered": q_total_reordered,
    "safe_int": q_safe_int,
    "safe_float": q_safe_float,
    "clean_text": q_clean_text,
    "default_fields": q_default_fields,
    "flatten_orders_raw": q_flatten_orders_raw,
    "flatten_order_items_raw": q_flatten_order_items_raw,
    "flatten_rejects": q_flatten_rejects,
    "transform_summary": q_transform_summary,
    "document_rejects": q_document_rejects,
    "incremental_ingest": q_incremental_ingest,
    "ingest_redelivery": q_ingest_redelivery,
    "validate_counts": q_validate_counts,
    "validate_nonempty": q_validate_nonempty,
    "reconcile_ledger": q_reconcile_ledger,
    "table_counts": q_table_counts,
    "sample_orders": q_sample_orders,
    "sample_order_items": q_sample_order_items,
    "lookup_user_orders": q_lookup_user_orders,
    "dashboard_refresh": q_dashboard_refresh,
    "dashboard_incremental": q_dashboard_incremental,
}
