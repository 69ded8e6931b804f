"""Dashboard refresh: every series from one scan of each table.

Run one by one, the overview, KPI, dashboard and insight queries scan the two
tables about thirty times. A refresh computes one cube per table instead, with
grouping sets, writes it, and derives all 36 series from it:

=========  ===============================  ==============================
table      grouping set                     series derived from it
=========  ===============================  ==============================
orders     weekday, hour                    overview, order KPIs, weekday,
                                            hour and heatmap series, R1-R3
           basket size                      basket sizes
           gap value                        gap histogram
           evaluation set, user             evaluation sets, distinct and
                                            top users
items      product name, department, aisle  product rankings, R4, R5
           department, aisle, product id    departments, aisles, item KPIs
           cart position                    cart positions
=========  ===============================  ==============================

Cubes of different rows merge: counts and sums add up, maxima and distinct
users and products follow from the merged groups, and means are kept as exact
whole-number sums (``functions.exact``). So a batch of new rows costs one scan of
the batch: ``add_batch`` keeps its cube, ``incremental`` merges the cubes of all
batches without a look at earlier rows. Results equal those of the direct queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartscope.functions.exact import fraction_units, mean_of_parts, whole_part
from cartscope.plans import insights as R
from cartscope.plans import metrics as M
from cartscope.session import scratch_path


# every series the refresh returns: all metric and insight queries
SERIES = list(M.METRICS) + list(R.INSIGHTS)


def _n() -> F.Column:
    return F.count(F.lit(1))


_ORDER_SETS = {"cells": ["order_dow", "order_dow_name", "order_hour_of_day"], "baskets": ["total_items"],
               "gaps": ["days_since_prior_order"], "eval_users": ["eval_set", "user_id"]}
_ITEM_SETS = {"products": ["product_name", "department", "aisle"],
              "aisle_products": ["department", "aisle", "product_id"], "carts": ["add_to_cart_order"]}
#: Measures that add up when cubes merge; the others are maxima.
_SUMS = ("n", "items", "n_gap", "gap_whole", "gap_units", "n_pct", "pct_whole", "pct_units", "r")


def _cube(df: DataFrame, sets: dict[str, list[str]], measures: list[F.Column]) -> DataFrame:
    """All grouping sets in one pass; ``level`` names the set of a row."""
    keys = list(dict.fromkeys(k for cols in sets.values() for k in cols))
    # bit i (from the left) of the grouping id is set where key i is not grouped by
    ids = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in cols)
           for name, cols in sets.items()}
    cube = df.groupingSets([[F.col(k) for k in cols] for cols in sets.values()], *keys).agg(
        F.grouping_id().alias("_set"), *measures)
    level = F.lit(None).cast("string")
    for name, number in ids.items():
        level = F.when(F.col("_set") == number, name).otherwise(level)
    return cube.withColumn("level", level).drop("_set")


def cubes(orders: DataFrame, items: DataFrame) -> dict[str, DataFrame]:
    """The two cubes (lazy plans, one scan each)."""
    # measures are computed below the grouping sets: a key column is null above
    gap, pct = F.col("days_since_prior_order"), M.order_reorder_pct()
    wide = orders.select(
        *dict.fromkeys(k for cols in _ORDER_SETS.values() for k in cols), "order_number",
        F.col("total_items").alias("_items"), gap.alias("_gap"), pct.alias("_pct"))
    o = _cube(wide, _ORDER_SETS, [
        _n().alias("n"), F.sum("_items").alias("items"), F.max("order_number").alias("max_order_number"),
        F.count("_gap").alias("n_gap"), F.sum(whole_part(F.col("_gap"))).alias("gap_whole"),
        F.sum(fraction_units(F.col("_gap"))).alias("gap_units"),
        F.count("_pct").alias("n_pct"), F.sum(whole_part(F.col("_pct"))).alias("pct_whole"),
        F.sum(fraction_units(F.col("_pct"))).alias("pct_units")])
    i = _cube(items, _ITEM_SETS, [_n().alias("n"), F.sum("reordered").alias("r")])
    return {"orders": o, "items": i}


_STATE = {
    "orders": "order_dow smallint, order_dow_name string, order_hour_of_day smallint, total_items int, "
              "days_since_prior_order float, eval_set string, user_id long, n long, items long, "
              "max_order_number long, n_gap long, gap_whole long, gap_units long, n_pct long, pct_whole long, "
              "pct_units long, batch string, level string",
    "items": "product_name string, department string, aisle string, product_id long, "
             "add_to_cart_order smallint, n long, r long, batch string, level string"}


def add_batch(spark: SparkSession, state: str, batch: str, orders: DataFrame, items: DataFrame) -> None:
    """Keep the cubes of one batch of new rows under ``state``. The batch's name
    makes a repeated call replace its own cubes instead of counting twice."""
    for name, cube in cubes(orders, items).items():
        cube.write.mode("overwrite").partitionBy("level").parquet(f"{state}/{name}/batch={batch}")


def _merge(df: DataFrame, keys: list[str]) -> DataFrame:
    out = [F.sum(c).alias(c) for c in df.columns if c in _SUMS]
    if "max_order_number" in df.columns:
        out.append(F.max("max_order_number").alias("max_order_number"))
    return df.groupBy(*keys).agg(*out)


def first_level(orders_cube: DataFrame, items_cube: DataFrame) -> dict[str, DataFrame]:
    """The small aggregates every series is derived from, out of written cubes
    (several batches merge here; partition pruning reads one level each)."""
    def level(cube: DataFrame, sets: dict[str, list[str]], name: str, keys: list[str] | None = None) -> DataFrame:
        return _merge(cube.filter(F.col("level") == name), keys or sets[name])
    o, i = (lambda name: level(orders_cube, _ORDER_SETS, name)), (lambda name: level(items_cube, _ITEM_SETS, name))
    cells, eval_users = o("cells"), o("eval_users")
    users = _merge(eval_users, ["user_id"])
    kpis = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_orders"), F.sum("items").alias("total_items_ordered"),
                     *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_gap", "gap_whole", "gap_units")])
    products = i("aisle_products")
    return {
        "kpis": R._one_row(kpis, users.agg(_n().alias("total_users"))),
        "cells": cells.select("order_dow", "order_dow_name", "order_hour_of_day", "n"),
        "baskets": o("baskets").select("total_items", "n"),
        "gaps": o("gaps").filter("days_since_prior_order IS NOT NULL").select("days_since_prior_order", "n"),
        "eval_sets": eval_users.groupBy("eval_set").agg(F.sum("n").alias("total_orders"), _n().alias("total_users")),
        "users": users.select(
            "user_id", F.col("n").alias("total_orders"), F.col("items").alias("total_items_ordered"),
            "max_order_number",
            F.bround(mean_of_parts(F.col("gap_whole"), F.col("gap_units"), F.col("n_gap")), 1)
             .alias("avg_days_between_orders"),
            mean_of_parts(F.col("pct_whole"), F.col("pct_units"), F.col("n_pct")).alias("_mean_order_reorder_pct")),
        "products": i("products"),
        "dept_products": _merge(products, ["department", "product_id"]),
        "aisle_products": products,
        "carts": i("carts").filter(F.col("add_to_cart_order") <= M.CART_POSITION_LIMIT),
    }


def _mean(s: str, n: str) -> F.Column:
    return F.col(s).cast("double") / F.col(n)


def _rate(r: str, n: str) -> F.Column:
    """round(avg(flag) * 100, 1) from a sum and a count."""
    return F.bround(_mean(r, n) * F.lit(100.0), 1)


def _rate_sum(r: str, n: str) -> F.Column:
    """round(sum(flag) * 100.0 / count, 1)."""
    return F.bround(F.col(r).cast("double") * F.lit(100.0) / F.col(n), 1)


def series(a: dict[str, DataFrame], keyword: str = R.DEFAULT_KEYWORD) -> dict[str, DataFrame]:
    """Every dashboard series from the first-level aggregates ``a``."""
    k, cells = a["kpis"], a["cells"]
    # weekday and hour marginals of the weekday x hour cells
    by_dow = (cells.groupBy("order_dow_name", "order_dow").agg(F.sum("n").alias("total_orders")))
    by_hour = cells.groupBy("order_hour_of_day").agg(F.sum("n").alias("total_orders"))
    out: dict[str, DataFrame] = {}

    avg_items = F.try_divide(F.col("total_items_ordered").cast("double"), F.col("total_orders"))
    avg_gap = mean_of_parts(F.col("gap_whole"), F.col("gap_units"), F.col("n_gap"))
    out["overview"] = k.select("total_orders", "total_users", "total_items_ordered",
                               F.bround(avg_items, 2).alias("avg_items_per_order"),
                               F.bround(avg_gap, 1).alias("avg_days_between_orders"))
    out["kpi_total_orders"] = k.select("total_orders")
    out["kpi_total_users"] = k.select("total_users")
    out["kpi_avg_items"] = k.select(F.bround(avg_items, 1).alias("avg_items_per_order"))
    out["kpi_avg_gap_days"] = k.select(F.bround(avg_gap, 1).alias("avg_days_between_orders"))

    out["orders_by_dow"] = by_dow.select(F.col("order_dow_name").alias("day_of_week"),
                                         "order_dow", "total_orders") \
                                 .orderBy(*M.asc("order_dow", "day_of_week"))
    out["orders_by_hour"] = by_hour.select(F.col("order_hour_of_day").alias("hour"),
                                           "total_orders").orderBy(*M.asc("hour"))
    out["heatmap_dow_hour"] = cells.select(
        F.col("order_dow_name").alias("day_of_week"), "order_dow",
        F.col("order_hour_of_day").alias("hour"), F.col("n").alias("total_orders")) \
        .orderBy(*M.asc("order_dow", "hour", "day_of_week"))
    out["viz_orders_by_dow"] = M._named(
        by_dow.select("order_dow", "order_dow_name", "total_orders")
              .orderBy(*M.asc("order_dow", "order_dow_name")), "viz_orders_by_dow")
    out["viz_orders_by_hour"] = M._named(
        by_hour.select("order_hour_of_day", "total_orders").orderBy(*M.asc("order_hour_of_day")),
        "viz_orders_by_hour")
    out["viz_heatmap"] = M._named(
        cells.select("order_dow_name", "order_dow", "order_hour_of_day", "n")
             .orderBy(*M.asc("order_dow", "order_hour_of_day", "order_dow_name")), "viz_heatmap")
    p = (cells.withColumn("_hour", M.pivot_hour()).groupBy("order_dow", "order_dow_name")
              .pivot("_hour", [*M.HOURS, -1]).agg(F.sum("n")))
    out["viz_heatmap_pivot"] = p.select(
        "order_dow", F.col("order_dow_name").alias("day"),
        *[F.coalesce(F.col(str(h)), F.lit(0)).cast("long").alias(f"h{h:02d}") for h in M.HOURS],
        F.coalesce(F.col("-1"), F.lit(0)).cast("long").alias("h_other")) \
        .orderBy(*M.asc("order_dow", "day"))

    out["basket_size_dist"] = a["baskets"].select(
        F.col("total_items").alias("items_in_order"), F.col("n").alias("order_count")) \
        .orderBy(*M.asc("items_in_order"))
    out["viz_basket_size"] = M._named(a["baskets"].orderBy(*M.asc("total_items")), "viz_basket_size")
    out["viz_gap_days_hist"] = M._named(
        a["gaps"].orderBy(*M.asc("days_since_prior_order"))
                 .select(F.bround("days_since_prior_order", 0).cast("double"), "n"),
        "viz_gap_days_hist")
    out["eval_set_dist"] = a["eval_sets"].orderBy(*M.asc("eval_set"))

    u = a["users"]
    out["top_users"] = u.select("user_id", "total_orders", "total_items_ordered",
                                "max_order_number", "avg_days_between_orders") \
                        .orderBy(F.desc("total_orders"), *M.asc("user_id")).limit(M.TOP_K)
    out["viz_top_users"] = M._named(
        u.select("user_id", "total_orders", "total_items_ordered", "max_order_number",
                 "avg_days_between_orders", F.bround("_mean_order_reorder_pct", 1))
         .orderBy(F.desc("total_orders"), *M.asc("user_id")).limit(M.TOP_K), "viz_top_users")

    pr = a["products"]
    keys = ["product_name", "department", "aisle"]
    top = pr.orderBy(F.desc("n"), *M.asc(*keys))
    out["top_products"] = top.select(*keys, F.col("n").alias("times_ordered"),
                                     F.col("r").alias("times_reordered"),
                                     _rate_sum("r", "n").alias("reorder_rate_pct")).limit(M.TOP_K)
    out["viz_top_products"] = M._named(
        top.select(*keys, "n", "r", _rate("r", "n")).limit(M.TOP_K), "viz_top_products")
    pd_ = pr.groupBy("product_name", "department").agg(F.sum("n").alias("n"),
                                                       F.sum("r").alias("r"))
    out["viz_top_reorder_rate"] = M._named(
        pd_.filter(F.col("n") >= M.MIN_TIMES_ORDERED)
           .select("product_name", "department", "n", _rate("r", "n").alias("rate"))
           .orderBy(F.desc("rate"), *M.asc("product_name", "department")).limit(M.TOP_K),
        "viz_top_reorder_rate")
    out["insight_top3_products"] = out["top_products"].limit(3)
    hit = F.col("product_name").contains(keyword).cast("int")
    out["insight_keyword_share"] = out["top_products"].agg(
        F.lit(keyword).alias("keyword"), F.sum(hit).cast("long").alias("products_with_keyword"),
        F.count(F.lit(1)).alias("top_n"), F.bround(F.avg(hit) * F.lit(100.0), 1).alias("share_pct"))

    dp = a["dept_products"]
    dept = dp.groupBy("department").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("u"),
                                        F.sum("r").alias("r"))
    out["top_departments"] = dept.select(
        "department", F.col("n").alias("items_ordered"), F.col("u").alias("unique_products"),
        F.col("r").alias("reordered_count"), _rate_sum("r", "n").alias("reorder_rate_pct")) \
        .orderBy(F.desc("items_ordered"), *M.asc("department")).limit(M.TOP_K)
    out["reorder_rate_by_department"] = dept.select(
        "department", F.col("n").alias("total_items"), F.col("r").alias("reordered"),
        _rate_sum("r", "n").alias("reorder_rate_pct")) \
        .orderBy(F.desc("reorder_rate_pct"), *M.asc("department"))
    out["viz_departments"] = M._named(
        dept.select("department", "n", "u", "r", _rate("r", "n").alias("rate"))
            .orderBy(F.desc("n"), *M.asc("department")), "viz_departments")
    out["viz_dept_reorder_rate"] = M._named(
        dept.select("department", "n", "r", _rate("r", "n").alias("rate"))
            .orderBy(F.desc("rate"), *M.asc("department")), "viz_dept_reorder_rate")
    tot = dp.agg(F.sum("n").alias("n"), F.sum("r").alias("r"))
    out["kpi_total_items"] = tot.select(F.coalesce("n", F.lit(0)).alias("total_items_ordered"))
    out["kpi_reorder_rate"] = tot.select(_rate("r", "n").alias("overall_reorder_rate_pct"))

    ap = a["aisle_products"]
    aisles = ap.groupBy("aisle", "department").agg(F.sum("n").alias("items_ordered"),
                                                  F.count(F.lit(1)).alias("unique_products"))
    out["top_aisles"] = aisles.orderBy(F.desc("items_ordered"), *M.asc("aisle", "department")) \
                              .limit(M.TOP_K)
    out["viz_top_aisles"] = M._named(out["top_aisles"], "viz_top_aisles")

    c = a["carts"]
    out["cart_position_reorder"] = c.select(
        F.col("add_to_cart_order").alias("cart_position"), F.col("n").alias("times_ordered"),
        _rate("r", "n").alias("reorder_rate_pct")).orderBy(*M.asc("cart_position"))
    out["viz_cart_position"] = M._named(
        c.select("add_to_cart_order", "n", _rate("r", "n")).orderBy(*M.asc("add_to_cart_order")),
        "viz_cart_position")

    # insights over the bounded cell table (a one-row-per-cell stand-in for orders)
    n, dow, hour = F.col("total_orders"), F.col("order_dow"), F.col("hour")
    d = out["orders_by_dow"]
    out["insight_busiest_day"] = d.agg(
        R._argmax("day_of_week", n, dow).alias("busiest_day"),
        F.max(n).alias("busiest_day_orders"),
        R._argmin("day_of_week", n, dow).alias("quietest_day"),
        F.min(n).alias("quietest_day_orders"))
    h = out["orders_by_hour"]
    out["insight_peak_hours"] = R.peak_hours(h)
    cn = F.col("n")
    day = by_dow.agg(R._argmax("order_dow_name", F.col("total_orders"), dow).alias("promo_day"))
    hr = by_hour.agg(R._argmax("order_hour_of_day", F.col("total_orders"),
                               F.col("order_hour_of_day")).alias("promo_hour"))
    rank = F.struct(cn, -dow, -F.col("order_hour_of_day"))
    cell = cells.agg(F.max_by("order_dow_name", rank).alias("busiest_cell_day"),
                     F.max_by("order_hour_of_day", rank).alias("busiest_cell_hour"),
                     F.max(cn).alias("busiest_cell_orders"))
    out["insight_promo_slot"] = R._one_row(day, hr, cell)
    return out


def direct(orders: DataFrame, items: DataFrame,
           keyword: str = R.DEFAULT_KEYWORD) -> dict[str, DataFrame]:
    """Every series as its own query over the tables (no shared aggregates)."""
    out = {name: fn(orders, items) for name, fn in M.METRICS.items()
           if name in SERIES}
    for name, fn in R.INSIGHTS.items():
        out[name] = (fn(orders, items, keyword=keyword) if name == "insight_keyword_share"
                     else fn(orders, items))
    return out


def incremental(spark: SparkSession, state: str, keyword: str = R.DEFAULT_KEYWORD) -> dict[str, DataFrame]:
    """All dashboard series from the cubes of the batches kept under ``state``."""
    kept = [spark.read.schema(schema).parquet(f"{state}/{name}") for name, schema in _STATE.items()]
    return series(first_level(*kept), keyword)


def refresh(spark: SparkSession, orders: DataFrame, items: DataFrame,
            keyword: str = R.DEFAULT_KEYWORD) -> dict[str, DataFrame]:
    """All dashboard series, whatever the size of the tables, from one scan of each."""
    state = scratch_path(spark, "dashboard")
    add_batch(spark, state, "all", orders, items)
    return incremental(spark, state, keyword)


def as_rows(found: dict[str, DataFrame]) -> DataFrame:
    """All series in one table: ``series`` and ``row``, a row's values by column name."""
    def text(c: str) -> F.Column:
        return F.concat(F.lit(c + "="), F.coalesce(F.col(c).cast("string"), F.lit("")))
    parts = [df.select(F.lit(name).alias("series"), F.concat_ws("|", *[text(c) for c in sorted(df.columns)]).alias("row"))
             for name, df in found.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
