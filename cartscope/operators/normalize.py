"""Flatten nested orders into the two warehouse tables.

Two modes reproduce the two flatten paths of the source pipeline:

``lenient`` (default)
    Every scalar is coerced like Python ``int()`` / ``float()`` with a default
    (0, or NULL for the gap); missing text -> ``''``; missing ``eval_set`` ->
    ``'prior'``; a missing ``products`` -> no items, one that is null or not a
    list rejects the order. In scalars and texts an explicit JSON null
    counts as missing (``'prior'``/``''`` rather than the string ``"None"``),
    and NaN gaps become NULL.
``raw``
    Values pass through typed but uncoerced: a bare-list document, a missing
    ``order_id``, a non-integer scalar, an unparsable gap or a null
    ``products`` rejects the order (and its items); a null or non-string
    product text, or an unparsable ``reordered``, rejects the item. Nulls stay
    NULL (the load fills type defaults). ``total_reordered`` counts only
    ``reordered`` values that are the JSON number 1 (or ``true``), not ``"1"``.

In both modes a value outside the unsigned width of its warehouse column
(or negative) rejects the row instead of wrapping.

A failing row never fails the job: it goes to ``rejects`` with a reason.
Everything is a native expression over VARIANT, evaluated in the scan's tasks;
the only wide operation downstream is whatever the caller does next.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartscope.functions import clean_field, clean_text, dow_name
from cartscope.schema import (
    DEFAULT_EVAL_SET, ORDER_ITEMS_COLUMNS, ORDER_ITEMS_SCHEMA, ORDERS_COLUMNS, ORDERS_SCHEMA, UNSIGNED_BITS,
)

MODES = ("lenient", "raw")


@dataclass
class Flattened:
    orders: DataFrame
    items: DataFrame
    rejects: DataFrame
    staged: DataFrame | None = None   # one row per order with ``_reason``, ``products``
    mode: str = "lenient"


def _out_of_range(c: Column, name: str) -> Column:
    hi = (1 << UNSIGNED_BITS[name]) - 1
    return c.isNotNull() & ((c < 0) | (c > hi))


def _first_reason(pairs: list[tuple[Column, str]]) -> Column:
    """Reason of the first failing check, or NULL when all pass."""
    out = F.lit(None).cast("string")
    for cond, reason in reversed(pairs):
        out = F.when(cond, F.lit(reason)).otherwise(out)
    return out


def _is_string(field: Column) -> Column:
    return F.to_json(field).startswith('"')


# Target types of the one-pass casts. Casting a VARIANT to a struct converts
# every field with try-semantics (a field that does not convert is NULL, the
# rest survive), which is exactly the per-field lenient coercion; ``variant``
# fields keep the JSON value so raw mode can tell missing, null and text apart.
_ORDER_SCALARS = ("order_id", "user_id", "order_number", "order_dow", "order_hour_of_day")
_ITEM_INTS = ("product_id", "aisle_id", "department_id", "add_to_cart_order")
_ITEM_TEXTS = ("product_name", "aisle", "department")

LENIENT_ITEM_TYPE = ("struct<product_id bigint, product_name string, aisle_id bigint, "
                     "aisle string, department_id bigint, department string, "
                     "add_to_cart_order bigint, reordered bigint>")
LENIENT_ORDER_TYPE = ("struct<order_id bigint, user_id bigint, order_number bigint, "
                      "order_dow bigint, order_hour_of_day bigint, "
                      "days_since_prior_order double, eval_set string, "
                      f"products array<{LENIENT_ITEM_TYPE}>>")
RAW_ITEM_TYPE = "struct<" + ", ".join(
    f"{n} variant" for n in ("product_id", "product_name", "aisle_id", "aisle", "department_id",
                             "department", "add_to_cart_order", "reordered")) + ">"
RAW_ORDER_TYPE = "struct<" + ", ".join(
    f"{n} variant" for n in _ORDER_SCALARS + ("days_since_prior_order", "eval_set")) \
    + f", products array<{RAW_ITEM_TYPE}>>"


def cast_targets(mode: str) -> dict[str, str]:
    """Column name -> struct type of the one-pass cast a mode needs."""
    return {"t": LENIENT_ORDER_TYPE if mode == "lenient" else RAW_ORDER_TYPE}


_EMPTY = "array<{}>"


def _text(v: Column) -> Column:
    """JSON text of a (small) sub-variant: strings as-is, numbers as digits."""
    return F.try_variant_get(v, "$", "string")


def _strict_int(v: Column) -> Column:
    return _text(v).try_cast("bigint")


def _present(v: Column) -> Column:
    """Key present and not JSON null."""
    return v.isNotNull() & ~F.is_variant_null(v)


def _nan_to_null(d: Column) -> Column:
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def _order_level(mode: str, has_products: Column, t: Column | None = None,
                 ) -> tuple[dict[str, Column], list[tuple[Column, str]], Column]:
    """Typed order columns, (failure, reason) checks and the typed item array,
    all in terms of ``t`` (the one-pass cast of the order, by default the column
    of that name) and of whether the order has the key ``products``."""
    t = F.col("t") if t is None else t
    # an element of the orders list that is not a JSON object
    checks: list[tuple[Column, str]] = [(t.isNull(), "order not an object")]
    if mode == "lenient":
        cols = {n: F.coalesce(t[n], F.lit(0).cast("bigint")) for n in _ORDER_SCALARS}
        cols["days_since_prior_order"] = _nan_to_null(t["days_since_prior_order"])
        cols["eval_set"] = F.coalesce(t["eval_set"], F.lit(DEFAULT_EVAL_SET))
        # only a missing key means an empty basket
        checks.append((t["products"].isNull() & has_products, "products null or not a list"))
        products = F.coalesce(t["products"], F.array().cast(_EMPTY.format(LENIENT_ITEM_TYPE)))
        counts = lambda p: F.coalesce(p["reordered"], F.lit(0)) == 1
    else:
        cols = {n: _strict_int(t[n]) for n in _ORDER_SCALARS}
        d = _text(t["days_since_prior_order"]).try_cast("double")
        cols["days_since_prior_order"] = _nan_to_null(d)
        cols["eval_set"] = F.when(t["eval_set"].isNull(), F.lit(DEFAULT_EVAL_SET)) \
                            .otherwise(_text(t["eval_set"]))
        # a missing list is told from one that is null or not a list by its key;
        # the typed list comes from the one cast
        typed = t["products"]
        products = F.when(~has_products, F.array().cast(_EMPTY.format(RAW_ITEM_TYPE))) \
                    .otherwise(typed)
        checks.insert(0, (F.col("doc_is_list"), "payload is a list"))
        checks.append((t["order_id"].isNull(), "order_id missing"))
        for n in _ORDER_SCALARS:
            checks.append((_present(t[n]) & cols[n].isNull(), f"{n} not an integer"))
        checks.append((_present(t["days_since_prior_order"]) & d.isNull(),
                       "days_since_prior_order not a number"))
        checks.append((has_products & typed.isNull(), "products null or not a list"))

        def counts(p: Column) -> Column:
            r = p["reordered"]
            return F.coalesce(~_is_string(r) & (F.try_variant_get(r, "$", "double") == 1.0),
                              F.lit(False))
    # a product that is not a JSON object fails its cast (NULL element); the
    # source scripts would stop on it, so the whole order is rejected
    checks.append((F.exists(products, lambda p: p.isNull()), "product not an object"))
    for n in _ORDER_SCALARS:
        checks.append((_out_of_range(cols[n], n), f"{n} out of range"))
    checks.append((F.size(products) > (1 << UNSIGNED_BITS["total_items"]) - 1,
                   "total_items out of range"))
    cols["total_items"] = F.size(products)
    cols["total_reordered"] = F.size(F.filter(products, counts))
    return cols, checks, products


def _item_level(mode: str, c=F.col) -> tuple[dict[str, Column], list[tuple[Column, str]]]:
    """Typed item columns and checks; ``c(name)`` gives an item field (a column
    after ``inline``, or a struct field inside a higher-order function)."""
    checks: list[tuple[Column, str]] = []
    if mode == "lenient":
        cols = {n: F.coalesce(c(n), F.lit(0).cast("bigint")) for n in _ITEM_INTS + ("reordered",)}
        for n in _ITEM_TEXTS:
            cols[n] = clean_field(F.coalesce(c(n), F.lit("")))
    else:
        cols = {n: _strict_int(c(n)) for n in _ITEM_INTS}
        for n in _ITEM_INTS:
            checks.append((_present(c(n)) & cols[n].isNull(), f"{n} not an integer"))
        for n in _ITEM_TEXTS:
            cols[n] = F.when(c(n).isNull(), F.lit("")).otherwise(clean_text(_text(c(n))))
            checks.append((c(n).isNotNull() & (F.is_variant_null(c(n)) | ~_is_string(c(n))),
                           f"{n} null or not text"))
        reo = F.try_variant_get(c("reordered"), "$", "bigint")
        cols["reordered"] = F.when(c("reordered").isNull(), F.lit(0).cast("bigint")).otherwise(reo)
        checks.append((c("reordered").isNotNull() & reo.isNull(), "reordered not an integer"))
    for n in _ITEM_INTS + ("reordered",):
        checks.append((_out_of_range(cols[n], n), f"{n} out of range"))
    return cols, checks


# --------------------------------------------------------------------- flatten

_ORDER_TYPES = {"order_id": "long", "user_id": "long", "order_number": "long",
                "order_dow": "short", "order_hour_of_day": "short",
                "days_since_prior_order": "float", "total_items": "int",
                "total_reordered": "int"}
_ITEM_TYPES = {"order_id": "long", "user_id": "long", "product_id": "long",
               "aisle_id": "int", "department_id": "short", "add_to_cart_order": "short",
               "reordered": "short"}


def flatten(orders_v: DataFrame, mode: str = "lenient") -> Flattened:
    """``orders_v`` has one VARIANT order per row in column ``o`` and
    ``doc_is_list`` — ideally from ``read_orders_payload(..., mode=mode)``,
    which also carries the mode's one-pass cast ``t`` (done once per document,
    before the explode). Orders and items are then plain column expressions
    over that struct, and the items come from ``inline`` of its typed product
    array — no per-field path lookups in the hot loop.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    targets = cast_targets(mode)
    cast = orders_v
    for name, target in targets.items():
        if name not in orders_v.columns:   # caller did not cast at the explode
            cast = cast.withColumn(name, F.try_variant_get("o", "$", target))
    cols, checks, products = _order_level(mode, F.try_variant_get("o", "$.products", "variant").isNotNull())
    staged = cast.select(
        "o",
        *[col.alias(n) for n, col in cols.items()],
        products.alias("products"),
        _first_reason(checks).alias("_reason"),
    ).withColumn("order_dow_name", dow_name(F.col("order_dow")))

    ok = staged.filter(F.col("_reason").isNull())
    orders = ok.select(*[F.col(n).cast(_ORDER_TYPES[n]).alias(n) if n in _ORDER_TYPES
                         else F.col(n) for n in ORDERS_COLUMNS])

    exploded = ok.select("order_id", "user_id", F.inline("products"))
    icols, ichecks = _item_level(mode)
    items_staged = exploded.select(
        "order_id", "user_id",
        F.struct(*[F.col(n) for n in exploded.columns if n not in ("order_id", "user_id")])
         .alias("p"),
        *[col.alias(n) for n, col in icols.items()],
        _first_reason(ichecks).alias("_reason"))
    items = items_staged.filter(F.col("_reason").isNull()).select(
        *[F.col(n).cast(_ITEM_TYPES[n]).alias(n) if n in _ITEM_TYPES else F.col(n)
          for n in ORDER_ITEMS_COLUMNS])

    # Rejects in one pass over the orders: a rejected order yields one row;
    # an accepted order yields one row per failing product, found by running
    # the item checks inside higher-order functions on its product array.
    def item_reason(p: Column) -> Column:
        return _first_reason(_item_level(mode, lambda n: p[n])[1])

    def reject(stage: str, reason: Column, record: Column) -> Column:
        return F.struct(F.lit(stage).alias("stage"), reason.alias("reason"),
                        record.alias("record"))
    # each product's checks run once: tag, keep the failing ones, shape them
    tagged = F.transform("products", lambda p: F.struct(item_reason(p).alias("why"),
                                                        p.alias("p")))
    bad_items = F.transform(
        F.filter(tagged, lambda x: x["why"].isNotNull()),
        lambda x: reject("item", x["why"], F.to_json(F.to_variant_object(x["p"]))))
    per_order = F.when(F.col("_reason").isNotNull(),
                       F.array(reject("order", F.col("_reason"), F.to_json("o")))) \
                 .otherwise(bad_items)
    rejects = (staged.select(F.col("order_id").cast("long").alias("order_id"),
                             F.explode(per_order).alias("r"))
                     .select(F.lit(mode).alias("mode"), "r.stage", "r.reason", "order_id",
                             "r.record"))
    return Flattened(orders, items, rejects, staged, mode)


#: Cast of an order to its keys: values that are not objects become nulls uncopied.
ORDER_KEYS_TYPE = "map<string,map<string,boolean>>"


def _has_products(keys: Column) -> Column:
    return F.coalesce(F.map_contains_key(keys, "products"), F.lit(False))


def order_fails(mode: str, t: Column, keys: Column) -> Column:
    """Whether ``staged_rows`` gives the order a ``reason``."""
    return _first_reason(_order_level(mode, _has_products(keys), t)[1]).isNotNull()


def staged_rows(orders_v: DataFrame, mode: str = "lenient", keep: tuple[str, ...] = ()) -> DataFrame:
    """The flatten as one row per order, to be written once and read for every
    output: the typed order columns, ``items``, ``reason`` and ``record`` of a failing
    order, and the columns ``keep`` of the input. ``orders_v`` has one order per row:
    its casts (``cast_targets``), ``keys`` (``ORDER_KEYS_TYPE``), ``doc_is_list`` and,
    needed for orders that fail only, the order ``o`` itself.

    Lenient items stay as they were cast, for ``staged_items`` to check where they are
    read, in generated code; raw ones are checked here, as a VARIANT in them would
    have to be written: typed, each with ``reason`` and, if it fails, ``record``."""
    cols, checks, products = _order_level(mode, _has_products(F.col("keys")))
    staged = orders_v.select(*keep, "o", *[c.alias(n) for n, c in cols.items()], products.alias("products"),
                             _first_reason(checks).alias("reason")) \
        .withColumn("order_dow_name", dow_name(F.col("order_dow")))
    bad = F.col("reason").isNotNull()
    kept = F.when(~bad, F.col("products")).otherwise(F.slice("products", 1, 0))

    def item(p: Column) -> Column:
        icols, ichecks = _item_level(mode, lambda n: p[n])
        return F.struct(*[icols[n].cast(_ITEM_TYPES.get(n, "string")).alias(n) for n in ORDER_ITEMS_COLUMNS
                          if n in icols],
                        _first_reason(ichecks).alias("reason"), p.alias("p"))

    def shown(x: Column) -> Column:
        return F.struct(*[x[n].alias(n) for n in ORDER_ITEMS_COLUMNS if n not in ("order_id", "user_id")],
                        x["reason"].alias("reason"),
                        F.when(x["reason"].isNotNull(), F.to_json(F.to_variant_object(x["p"]))).alias("record"))
    items = kept if mode == "lenient" else F.transform(F.transform(kept, item), shown)
    return staged.select(
        *keep, *[F.col(n).cast(_ORDER_TYPES[n]).alias(n) if n in _ORDER_TYPES else F.col(n) for n in ORDERS_COLUMNS],
        items.alias("items"), "reason", F.when(bad, F.to_json("o")).alias("record"))


def staged_items(rows: DataFrame, mode: str = "lenient") -> DataFrame:
    """The items of staged orders, one per row: typed, with ``reason`` and, if the
    item fails, ``record``."""
    flat = rows.select("order_id", "user_id", F.inline("items"))
    if mode != "lenient":
        return flat
    cols, checks = _item_level(mode)
    reason = _first_reason(checks)
    product = F.struct(*[F.col(n) for n in flat.columns if n not in ("order_id", "user_id")])
    return flat.select(
        "order_id", "user_id", *[cols[n].cast(_ITEM_TYPES.get(n, "string")).alias(n) for n in ORDER_ITEMS_COLUMNS
                                 if n in cols],
        reason.alias("reason"), F.when(reason.isNotNull(), F.to_json(F.to_variant_object(product))).alias("record"))


def transform_summary(flat: Flattened, with_timestamp: bool = True) -> DataFrame:
    """Row counts of both outputs, in one aggregate over the accepted
    orders (items counted per order with the item checks in a filter)."""
    ok = flat.staged.filter(F.col("_reason").isNull())
    passing = F.filter("products", lambda p: _first_reason(
        _item_level(flat.mode, lambda n: p[n])[1]).isNull())
    out = ok.agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum(F.size(passing)).cast("long").alias("order_item_count"))
    if with_timestamp:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


def load_value(field, column: Column) -> Column:
    """A value as the warehouse stores it: NULL in a NOT NULL column becomes the
    type default (0 / '')."""
    c = column.cast(field.dataType)
    if field.nullable:
        return c
    default = F.lit("") if field.dataType.typeName() == "string" else F.lit(0)
    return F.coalesce(c, default.cast(field.dataType))


def fill_load_defaults(df: DataFrame, table: str) -> DataFrame:
    """Staging -> warehouse: type defaults for nulls in NOT NULL columns, as the
    warehouse does on insert; the gap column stays nullable."""
    schema = ORDERS_SCHEMA if table == "orders" else ORDER_ITEMS_SCHEMA
    return df.select(*[load_value(f, F.col(f.name)).alias(f.name) for f in schema.fields])


def row_hash(table: str, get=F.col) -> Column:
    """Hash of a row's stored values; ``get(name)`` gives a column's value. The sum
    of a table's hashes doesn't depend on the order or place of its rows."""
    schema = ORDERS_SCHEMA if table == "orders" else ORDER_ITEMS_SCHEMA
    return F.xxhash64(*[load_value(f, get(f.name)) for f in schema.fields]).cast("decimal(28,0)")


__all__ = ["Flattened", "flatten", "transform_summary", "fill_load_defaults", "load_value", "row_hash",
           "staged_rows", "staged_items", "order_fails", "ORDER_KEYS_TYPE", "MODES"]
