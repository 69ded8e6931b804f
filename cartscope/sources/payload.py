"""Nested order payloads (S1, S2) and flat staging files (S3).

A payload *document* is either an envelope ``{"orders": [...], "total_orders": N}``
or a bare list of orders. Documents are read as VARIANT — one per line for
JSON Lines landings (splittable: many tasks per file), or one per file with
``multi_line=True`` for pretty-printed single documents (one task per file, so
land many files). VARIANT keeps every value's JSON type, which the coercion
rules need (``1.7`` vs ``"1.7"`` vs ``true``), and distinguishes a missing key
from an explicit null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartscope.schema import ORDER_ITEMS_SCHEMA, ORDERS_SCHEMA


def read_documents(spark: SparkSession, path: str | list[str],
                   multi_line: bool = False, landed: bool = False) -> DataFrame:
    """One row per payload document: ``doc`` (VARIANT, NULL if unreadable),
    ``source_file``. ``landed`` reads what ``land_raw(whole_files=True)`` wrote."""
    if landed:
        return (spark.read.parquet(path)
                .select(F.try_parse_json(F.decode("content", "UTF-8")).alias("doc"),
                        F.col("path").alias("source_file")))
    r = spark.read.option("singleVariantColumn", "doc")
    if multi_line:
        r = r.option("multiLine", "true")
    return (r.json(path)
             .withColumn("source_file", F.input_file_name()))


def orders_array(doc: F.Column, element: str = "variant") -> F.Column:
    """Orders of a document — the envelope's ``orders``, or the list itself —
    cast to ``array<element>``."""
    t = f"array<{element}>"
    # one order per line: an object with an order_id and no orders is an order
    single = F.try_variant_get(doc, "$.orders", "variant").isNull() \
        & F.try_variant_get(doc, "$.order_id", "variant").isNotNull()
    return F.coalesce(F.try_variant_get(doc, "$.orders", t),
                      F.try_variant_get(doc, "$", t),
                      F.when(single, F.array(F.try_variant_get(doc, "$", element))),
                      F.array().cast(t))


def document_problem(doc: F.Column) -> F.Column:
    """Why a document can't hold orders (null if it can): the reader gives NULL
    for what is not JSON or beyond the VARIANT size limit; other documents must
    be a list, or an object whose ``orders``, if present, is a list. Values are
    probed as booleans, which are not copied (a variant of a part is built anew)."""
    no_list = F.try_variant_get(doc, "$.orders", "array<boolean>").isNull()
    return (F.when(doc.isNull(), "not JSON or beyond the size limit")
            .when(F.try_variant_get(doc, "$", "array<boolean>").isNotNull(), F.lit(None))
            .when(F.try_variant_get(doc, "$", "map<string,boolean>").isNull(), "not an object or list")
            .when(no_list & F.try_variant_get(doc, "$.orders", "variant").isNotNull(), "orders is not a list"))


def document_rejects(docs: DataFrame, mode: str = "lenient") -> DataFrame:
    """Documents that can't hold orders, as reject rows of stage ``document``;
    ``record`` names the file and, where it parses, the document."""
    text = F.when(F.col("doc").isNotNull(), F.to_json("doc"))
    return (docs.withColumn("reason", document_problem(F.col("doc"))).filter("reason IS NOT NULL")
            .select(F.lit(mode).alias("mode"), F.lit("document").alias("stage"), "reason",
                    F.lit(None).cast("long").alias("order_id"),
                    F.concat_ws(" ", "source_file", text).alias("record")))


def is_list(doc: F.Column) -> F.Column:
    """Is the document a bare list? An O(1) probe of the first element: the
    optimizer may evaluate this once per *order* (it is inlined above the
    explode), so it must not materialise the document. An empty list reads as
    "not a list", which is harmless: it has no orders."""
    return F.try_variant_get(doc, "$[0]", "variant").isNotNull()


def explode_orders(docs: DataFrame, typed: dict[str, str] | None = None) -> DataFrame:
    """One row per order: ``o`` (VARIANT), ``doc_is_list``, ``source_file``,
    plus one column per entry of ``typed`` (name -> struct type): the order
    cast to that type.

    The casts run once per *document* (the whole ``orders`` array at once) and
    are zipped with the VARIANT array before the explode, so every later
    per-order expression is a struct-field access; a cast above the explode
    would be inlined by predicate pushdown into each reference of it.
    A bare list and an envelope both yield their orders; an envelope without
    ``orders`` yields none. Narrow (no shuffle): runs in the scan's tasks.
    """
    doc = F.col("doc")
    arrays = [orders_array(doc).alias("o")]
    arrays += [orders_array(doc, t).alias(name) for name, t in (typed or {}).items()]
    # Document-level columns are computed *below* the explode: anything left in
    # the explode's own select is evaluated after it, which would carry the
    # whole document on every generated order row.
    per_doc = docs.select("source_file", is_list(doc).alias("doc_is_list"),
                          F.arrays_zip(*arrays).alias("_orders"))
    # explode_outer: an inner explode makes the optimizer add a
    # ``size(array) > 0`` filter that evaluates the casts a second time.
    return (per_doc.select("source_file", "doc_is_list", F.explode_outer("_orders").alias("_z"))
                   .filter(F.col("_z").isNotNull())
                   .select("source_file", "doc_is_list", "_z.*"))


def read_orders_payload(spark: SparkSession, path: str | list[str],
                        multi_line: bool = False, mode: str | None = None) -> DataFrame:
    """Landed payload files -> one row per order. With a flatten ``mode``
    the rows also carry that mode's one-pass casts (see ``operators.normalize``)."""
    typed = None
    if mode is not None:
        from cartscope.operators.normalize import cast_targets
        typed = cast_targets(mode)
    return explode_orders(read_documents(spark, path, multi_line), typed)


def claimed_orders(doc: F.Column) -> F.Column:
    """Orders the source says a document holds: ``total_orders``, or the number
    found when it is absent or the payload is a list."""
    return claimed_of(is_list(doc), F.try_variant_get(doc, "$.total_orders", "bigint"),
                      F.size(orders_array(doc)).cast("long"))


def claimed_of(doc_is_list: F.Column, total_orders: F.Column, found: F.Column) -> F.Column:
    return F.when(doc_is_list, found).otherwise(F.coalesce(total_orders, found))


def payload_summary(docs: DataFrame, with_timestamp: bool = True) -> DataFrame:
    """Documents, orders found, and orders the source claims to hold
    (``total_orders``; the found count when absent or when the payload is a list)."""
    found = F.size(orders_array(F.col("doc")))
    claimed = claimed_orders(F.col("doc"))
    out = docs.agg(F.count(F.lit(1)).alias("documents"),
                   F.sum(found).cast("long").alias("order_count"),
                   F.sum(claimed).cast("long").alias("total_orders"))
    if with_timestamp:
        out = out.withColumn("fetched_at", F.current_timestamp())
    return out


def payload_counts(docs: DataFrame) -> DataFrame:
    """Documents, orders and product rows of a landing, in one pass without
    exploding (per-document sizes summed with a higher-order ``aggregate``)."""
    orders = orders_array(F.col("doc"))
    n_items = F.aggregate(
        orders, F.lit(0).cast("long"),
        lambda acc, o: acc + F.size(F.coalesce(F.try_variant_get(o, "$.products", "array<variant>"),
                                               F.array().cast("array<variant>"))))
    return docs.agg(F.count(F.lit(1)).alias("documents"),
                    F.sum(F.size(orders)).cast("long").alias("order_count"),
                    F.sum(n_items).cast("long").alias("item_count"))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


# Staging files may carry nulls (raw mode); the load fills type defaults.
STAGING_SCHEMAS = {"orders": _nullable(ORDERS_SCHEMA),
                   "order_items": _nullable(ORDER_ITEMS_SCHEMA)}


def read_flat_staging(spark: SparkSession, path: str, table: str,
                      fmt: str = "json") -> DataFrame:
    """S3: re-read flat staging rows with the declared schema (no inference)."""
    schema = STAGING_SCHEMAS[table]
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    return spark.read.schema(schema).parquet(path)
