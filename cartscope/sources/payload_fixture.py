"""Nested payload landed from the warehouse tables (ETL round trip input).

The two flat tables are re-nested into the source's payload shape — orders
with a ``products`` array, grouped into documents — and written as JSON Lines
(one document per line, so the scan splits). The ETL operators then flatten
it again; the oracle derives the expected tables relationally, so agreement is
evidence for both directions.

Deterministic dirty values, keyed by ``order_id`` (fixed rules, mirrored as
CASE expressions in the oracle; the first matching rule wins per field):

=====================  ====================================================
order_id % 97 = 0      ``days_since_prior_order`` is the string "abc"
order_id % 73 = 0      ``days_since_prior_order`` is its number as a string
order_id % 89 = 0      ``order_number`` is its number as a string
order_id % 67 = 0      ``order_hour_of_day`` is hour + 0.5 (a fraction)
order_id % 61 = 0      ``order_dow`` is dow + 7 (an unknown day)
order_id % 79 = 0      ``eval_set`` key is absent
order_id % 83 = 0      product texts are wrapped in tab/space/newline
order_id % 71 = 0      ``reordered`` is "0"/"1" (strings)
no items, even id      ``products`` is ``[]``; odd id: the key is absent
=====================  ====================================================

Documents: ``doc_id = order_id div 1000`` (so at most 1000 orders per
document); doc_id % 5 = 4 is a bare list, doc_id % 7 = 3 an envelope without
``total_orders``, other envelopes claim ``found + doc_id % 3`` orders.
"""

from __future__ import annotations

import hashlib
import inspect
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartscope.session import file_count, path_exists, rename_path, scratch_path, work_root
from cartscope.sources.warehouse import ensure_warehouse, warehouse_key, warehouse_tables

ORDERS_PER_DOC = 1000

#: Warehouse bytes dealt to one task, which holds its items twice while it nests them:
#: about 50 bytes of memory a compressed byte, so 100 MB, and nothing is spilled.
DEALT_BYTES = 2 * 1024 * 1024


def _number(c: Column) -> Column:
    """JSON text of a number, ``null`` without one."""
    return F.coalesce(c.cast("string"), F.lit("null"))


def _quoted(c: Column) -> Column:
    """JSON text of a number as a string (digits only, no escaping needed)."""
    return F.coalesce(F.concat(F.lit('"'), c.cast("string"), F.lit('"')), F.lit("null"))


def _pad(c: Column, oid: Column) -> Column:
    return F.when(oid % 83 == 0, F.concat(F.lit("\t "), c, F.lit(" \n"))).otherwise(c)


#: Nulls stay in the text: the raw flatten tells a null from an absent key.
_NULLS = {"ignoreNullFields": "false"}


def _doc_id(oid: Column) -> Column:
    return F.floor(oid / ORDERS_PER_DOC).cast("long")


def deal_count(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that nest the warehouse tables of ``sf_dir``: one per ``DEALT_BYTES``."""
    root = ensure_warehouse(spark, sf_dir)
    return file_count(spark, [f"{root}/orders", f"{root}/order_items"], DEALT_BYTES)


def nested_orders(orders: DataFrame, items: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per order: ``order_id``, ``doc_id``, ``order_json`` (text), dealt into
    ``parts`` (by default as many as a shuffle has).

    Orders and items are dealt by document once, as typed columns; both groupings
    (items of an order here, orders of a document in ``payload_documents``) run
    where the rows then are. Texts are made from the columns, never parsed again."""
    oid = F.col("order_id")
    o_cols = ["user_id", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order", "eval_set"]
    i_cols = ["product_id", "product_name", "aisle_id", "aisle", "department_id", "department",
              "add_to_cart_order", "reordered"]
    rows_o = orders.select(_doc_id(oid).alias("doc_id"), oid, F.struct(*o_cols).alias("o"))
    rows_i = (items.filter(oid.isNotNull())
              .select(_doc_id(oid).alias("doc_id"), oid, F.struct(*i_cols).alias("i")))
    rows = rows_o.unionByName(rows_i, allowMissingColumns=True)
    dealt = rows.repartition(parts, "doc_id") if parts else rows.repartition("doc_id")

    def item_json(i: Column) -> Column:
        def of(reordered: Column) -> Column:
            texts = ("product_name", "aisle", "department")
            values = {n: _pad(i[n], oid) if n in texts else i[n] for n in i_cols} | {"reordered": reordered}
            return F.to_json(F.named_struct(*[x for n, v in values.items() for x in (F.lit(n), v)]), _NULLS)
        return F.when(oid % 71 == 0, of(i["reordered"].cast("string"))).otherwise(of(i["reordered"]))

    # texts are made item by item where the rows were dealt to, before they are collected
    item = F.col("i")
    both = (dealt.select("doc_id", "order_id", "o", F.when(item.isNotNull(), item_json(item)).alias("text"))
            .groupBy("doc_id", "order_id").agg(F.collect_list("o").alias("os"), F.collect_list("text").alias("texts")))

    # an order that is there twice is nested twice, with all items of its id
    o = (both.filter(F.size("os") > 0)
         .select("doc_id", "order_id", F.size("texts").alias("n"),
                 F.concat_ws(",", "texts").alias("texts"), F.explode("os").alias("o"))
         .select("doc_id", "order_id", "n", "texts", "o.*"))
    days = F.col("days_since_prior_order")
    days_v = (F.when(oid % 97 == 0, F.lit('"abc"')).when(oid % 73 == 0, _quoted(days)).otherwise(_number(days)))
    number = F.col("order_number")
    number_v = F.when(oid % 89 == 0, _quoted(number)).otherwise(_number(number))
    hour = F.col("order_hour_of_day")
    hour_v = F.when(oid % 67 == 0, _number(F.concat(hour.cast("string"), F.lit(".5")))).otherwise(_number(hour))
    dow = F.col("order_dow")
    dow_v = _number(F.when(oid % 61 == 0, dow + 7).otherwise(dow))
    eval_v = F.concat(F.lit(","), F.regexp_extract(F.to_json(F.struct("eval_set"), _NULLS), r"(?s)^\{(.*)\}$", 1))
    no_products = (F.col("n") == 0) & (oid % 2 == 1)
    order_json = F.concat(
        F.lit('{"order_id":'), _number(oid), F.lit(',"user_id":'), _number(F.col("user_id")),
        F.lit(',"order_number":'), number_v, F.lit(',"order_dow":'), dow_v,
        F.lit(',"order_hour_of_day":'), hour_v, F.lit(',"days_since_prior_order":'), days_v,
        F.when(oid % 79 == 0, F.lit("")).otherwise(eval_v),
        F.when(no_products, F.lit("")).otherwise(F.concat(F.lit(',"products":['), F.col("texts"), F.lit("]"))),
        F.lit("}"))
    return o.select("order_id", "doc_id", order_json.alias("order_json"))


def payload_documents(orders: DataFrame, items: DataFrame, ids: bool = False,
                      parts: int | None = None) -> DataFrame:
    """One row per document: ``value`` = its JSON text, with ``ids`` also ``doc_id``."""
    docs = (nested_orders(orders, items, parts)
            .groupBy("doc_id")
            .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("order_json")),
                          F.lit("]")).alias("arr"),
                 F.count(F.lit(1)).alias("found")))
    d = F.col("doc_id")
    claimed = (F.col("found") + d % 3).cast("string")
    value = (F.when(d % 5 == 4, F.col("arr"))
              .when(d % 7 == 3, F.concat(F.lit('{"orders":'), F.col("arr"), F.lit("}")))
              .otherwise(F.concat(F.lit('{"orders":'), F.col("arr"),
                                  F.lit(',"total_orders":'), claimed, F.lit("}"))))
    return docs.select(*(["doc_id"] if ids else []), value.alias("value"))


def first_delivery(orders: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All orders but those whose id ends in 7, which come with the next delivery."""
    early = F.col("order_id") % 10 != 7
    return orders.filter(early), items.filter(early)


def redelivery(orders: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All orders again; those whose id ends in 3 changed: five hours later, and
    without the products beyond cart position 5."""
    changed = F.col("order_id") % 10 == 3
    hour = F.col("order_hour_of_day")
    return (orders.withColumn("order_hour_of_day", F.when(changed, (hour + 5) % 24).otherwise(hour).cast("short")),
            items.filter(~(changed & (F.col("add_to_cart_order") > 5))))


def damaged_documents(orders: DataFrame, items: DataFrame, parts: int | None = None) -> DataFrame:
    """Documents of which three in four can't be read: by the document id modulo 4,
    1 is cut short, 2 has a text for ``orders``, 3 is a bare text."""
    docs = payload_documents(orders, items, ids=True, parts=parts)
    kind = F.col("doc_id") % 4
    value = F.col("value")
    return docs.select(
        F.when(kind == 1, F.substring(value, F.lit(1), F.length(value) - 1))
         .when(kind == 2, F.lit('{"orders": "none", "total_orders": 1}'))
         .when(kind == 3, F.lit('"text"')).otherwise(value).alias("value"))


def land(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write documents as JSON Lines, compressed: keys and product texts repeat in
    every item, so the files have about a twentieth of the text's size. Such a file
    is read by one task; there is one for each task that wrote."""
    docs.select("value").write.mode(mode).option("compression", "gzip").text(path)


_RESOLVED: dict[tuple[str, str], str] = {}


def ensure_landing(spark: SparkSession, sf_dir: str) -> str:
    """Folder of landed JSON Lines payload documents for ``sf_dir`` (built once)."""
    memo = (spark.sparkContext.applicationId, sf_dir)
    if memo in _RESOLVED:
        return _RESOLVED[memo]
    code = hashlib.sha1(inspect.getsource(sys.modules[__name__]).encode()).hexdigest()[:8]
    final = f"{work_root(spark)}/cartscope/landing/{warehouse_key(spark, sf_dir)}-{code}"
    if path_exists(spark, f"{final}/_SUCCESS"):
        _RESOLVED[memo] = final
        return final
    orders, items = warehouse_tables(spark, sf_dir)
    staging = scratch_path(spark, "landing-staging")
    land(payload_documents(orders, items, parts=deal_count(spark, sf_dir)), staging)
    if not rename_path(spark, staging, final) and not path_exists(spark, f"{final}/_SUCCESS"):
        raise RuntimeError(f"could not publish landing to {final}")
    _RESOLVED[memo] = final
    return final
