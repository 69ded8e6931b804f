"""The metric library: overview queries, KPI cards and dashboard series.

Every function takes the two warehouse DataFrames and returns a DataFrame; the
same function serves the materialised warehouse, the lazy adapter and pytest.
Column names are snake_case; ``labels.with_labels`` maps dashboard series to
their verbatim labels.

- rounding is half-to-even (``bround``);
- rates use DOUBLE arithmetic, never DECIMAL;
- every ``LIMIT`` is preceded by a total order: the ranking column, then the
  group keys ascending, so ties resolve the same way on every run;
- the per-order reorder percentage skips orders without items (``try_divide``).

Plan shape: each query is one scan with column pruning, a partial + final
hash aggregate (the shuffle carries one row per group per map task, so a hot
group costs nothing extra), and for top-k a ``TakeOrderedAndProject``.
Distinct counts are exact (two-level aggregate on (group, value)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartscope.functions import rate_pct, ratio_pct
from cartscope.functions.exact import exact_mean
from cartscope.schema import CART_POSITION_LIMIT, MIN_TIMES_ORDERED, snake_columns

TOP_K = 10


def _n() -> Column:
    return F.count(F.lit(1))


def asc(*cols: str) -> list[Column]:
    """Ascending sort keys with NULLs last (the source engine's order; Spark's
    default puts them first)."""
    return [F.col(c).asc_nulls_last() for c in cols]


# ---------------------------------------------------------------- overview (Q)

def overview(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Q1: orders, distinct users, items, mean items (2 dp), mean gap (1 dp)."""
    return orders.agg(
        _n().alias("total_orders"),
        F.countDistinct("user_id").alias("total_users"),
        F.sum("total_items").alias("total_items_ordered"),
        F.bround(F.avg("total_items"), 2).alias("avg_items_per_order"),
        F.bround(exact_mean(F.col("days_since_prior_order")), 1).alias("avg_days_between_orders"),
    )


def orders_by_dow(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Q2: orders per weekday, ordered by day index."""
    return (orders.groupBy("order_dow_name", "order_dow").agg(_n().alias("total_orders"))
                  .select(F.col("order_dow_name").alias("day_of_week"), "order_dow",
                          "total_orders")
                  .orderBy(*asc("order_dow", "day_of_week")))


def orders_by_hour(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Q3: orders per hour of day."""
    return (orders.groupBy(F.col("order_hour_of_day").alias("hour"))
                  .agg(_n().alias("total_orders")).orderBy(*asc("hour")))


def basket_size_dist(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Q4: number of orders per basket size."""
    return (orders.groupBy(F.col("total_items").alias("items_in_order"))
                  .agg(_n().alias("order_count")).orderBy(*asc("items_in_order")))


def _product_stats(items: DataFrame, keys: list[str]) -> DataFrame:
    return items.groupBy(*keys).agg(
        _n().alias("times_ordered"),
        F.sum("reordered").alias("times_reordered"),
        F.avg("reordered").alias("_mean_reordered"),
    )


def top_products(orders: DataFrame | None, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """Q5: top products by times ordered, with reorder count and rate."""
    keys = ["product_name", "department", "aisle"]
    return (_product_stats(items, keys)
            .select(*keys, "times_ordered", "times_reordered",
                    rate_pct(F.col("times_reordered"), F.col("times_ordered"))
                    .alias("reorder_rate_pct"))
            .orderBy(F.desc("times_ordered"), *asc(*keys)).limit(k))


def _department_stats(items: DataFrame) -> DataFrame:
    return items.groupBy("department").agg(
        _n().alias("items_ordered"),
        F.countDistinct("product_id").alias("unique_products"),
        F.sum("reordered").alias("reordered_count"),
        F.avg("reordered").alias("_mean_reordered"),
    )


def top_departments(orders: DataFrame | None, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """Q6: top departments by volume, distinct products, reorder rate."""
    return (_department_stats(items)
            .select("department", "items_ordered", "unique_products", "reordered_count",
                    rate_pct(F.col("reordered_count"), F.col("items_ordered"))
                    .alias("reorder_rate_pct"))
            .orderBy(F.desc("items_ordered"), *asc("department")).limit(k))


def _aisle_stats(items: DataFrame) -> DataFrame:
    return items.groupBy("aisle", "department").agg(
        _n().alias("items_ordered"),
        F.countDistinct("product_id").alias("unique_products"),
    )


def top_aisles(orders: DataFrame | None, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """Q7: top aisles by volume."""
    return (_aisle_stats(items)
            .orderBy(F.desc("items_ordered"), *asc("aisle", "department")).limit(k))


def reorder_rate_by_department(orders: DataFrame | None, items: DataFrame) -> DataFrame:
    """Q8: reorder rate per department, sorted by the rounded rate.

    Both aggregates read the ``reordered`` column (one ``agg``), never the alias.
    """
    g = items.groupBy("department").agg(_n().alias("total_items"),
                                        F.sum("reordered").alias("reordered"))
    return (g.select("department", "total_items", "reordered",
                     rate_pct(F.col("reordered"), F.col("total_items")).alias("reorder_rate_pct"))
             .orderBy(F.desc("reorder_rate_pct"), *asc("department")))


def order_reorder_pct() -> Column:
    """Reordered share (%) of one order; NULL for an order without items."""
    return F.try_divide(F.col("total_reordered").cast("double") * F.lit(100.0), F.col("total_items"))


def _user_stats(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_id").agg(
        _n().alias("total_orders"),
        F.sum("total_items").alias("total_items_ordered"),
        F.max("order_number").alias("max_order_number"),
        F.bround(exact_mean(F.col("days_since_prior_order")), 1).alias("avg_days_between_orders"),
        exact_mean(order_reorder_pct()).alias("_mean_order_reorder_pct"),
    )


def top_users(orders: DataFrame, items: DataFrame | None = None, k: int = TOP_K) -> DataFrame:
    """Q9: most active users by order count."""
    return (_user_stats(orders)
            .select("user_id", "total_orders", "total_items_ordered", "max_order_number",
                    "avg_days_between_orders")
            .orderBy(F.desc("total_orders"), *asc("user_id")).limit(k))


def _cart_positions(items: DataFrame) -> DataFrame:
    return (items.filter(F.col("add_to_cart_order") <= CART_POSITION_LIMIT)
                 .groupBy("add_to_cart_order")
                 .agg(_n().alias("times_ordered"),
                      ratio_pct(F.avg("reordered")).alias("reorder_rate_pct")))


def cart_position_reorder(orders: DataFrame | None, items: DataFrame) -> DataFrame:
    """Q10: cart position (first 20) vs reorder rate."""
    return (_cart_positions(items)
            .select(F.col("add_to_cart_order").alias("cart_position"), "times_ordered",
                    "reorder_rate_pct")
            .orderBy(*asc("cart_position")))


def _dow_hour(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_dow_name", "order_dow", "order_hour_of_day").agg(
        _n().alias("n"))


def heatmap_dow_hour(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Q11: weekday x hour order counts, long form."""
    return (_dow_hour(orders)
            .select(F.col("order_dow_name").alias("day_of_week"), "order_dow",
                    F.col("order_hour_of_day").alias("hour"), F.col("n").alias("total_orders"))
            .orderBy(*asc("order_dow", "hour", "day_of_week")))


def eval_set_dist(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Q12: orders and users per evaluation set."""
    return (orders.groupBy("eval_set")
                  .agg(_n().alias("total_orders"), F.countDistinct("user_id").alias("total_users"))
                  .orderBy(*asc("eval_set")))


# ------------------------------------------------------------------ KPI cards

def kpi_total_orders(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    return orders.agg(_n().alias("total_orders"))


def kpi_total_users(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    return orders.agg(F.countDistinct("user_id").alias("total_users"))


def kpi_total_items(orders: DataFrame | None, items: DataFrame) -> DataFrame:
    """Item rows (not ``sum(total_items)``)."""
    return items.agg(_n().alias("total_items_ordered"))


def kpi_avg_items(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    return orders.agg(F.bround(F.avg("total_items"), 1).alias("avg_items_per_order"))


def kpi_avg_gap_days(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    return (orders.filter(F.col("days_since_prior_order").isNotNull())
                  .agg(F.bround(exact_mean(F.col("days_since_prior_order")), 1)
                       .alias("avg_days_between_orders")))


def kpi_reorder_rate(orders: DataFrame | None, items: DataFrame) -> DataFrame:
    return items.agg(ratio_pct(F.avg("reordered")).alias("overall_reorder_rate_pct"))


# ------------------------------------------------------------ dashboard series

def _named(df: DataFrame, query_id: str) -> DataFrame:
    """Rename positional columns to the snake_case form of the query's labels."""
    return df.toDF(*snake_columns(query_id))


def viz_orders_by_dow(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    g = orders.groupBy("order_dow", "order_dow_name").agg(_n().alias("n"))
    return _named(g.select("order_dow", "order_dow_name", "n")
                   .orderBy(*asc("order_dow", "order_dow_name")), "viz_orders_by_dow")


def viz_orders_by_hour(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    g = orders.groupBy("order_hour_of_day").agg(_n().alias("n")).orderBy(*asc("order_hour_of_day"))
    return _named(g, "viz_orders_by_hour")


def viz_heatmap(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    g = (_dow_hour(orders)
         .select("order_dow_name", "order_dow", "order_hour_of_day", "n")
         .orderBy(*asc("order_dow", "order_hour_of_day", "order_dow_name")))
    return _named(g, "viz_heatmap")


HOURS = list(range(24))


def pivot_hour() -> Column:
    """The hour, or -1 for a missing hour or one outside 0-23."""
    hour = F.col("order_hour_of_day").cast("int")
    return F.when(hour.between(0, 23), hour).otherwise(-1)


def viz_heatmap_pivot(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Wide heatmap: one row per weekday, one column per hour (``h00``..``h23``).

    The pivot values are listed, so Spark skips the distinct-values job and
    computes all cells in one aggregate. Other hours are counted in ``h_other``,
    so a row adds up to the orders of its day.
    """
    p = (orders.withColumn("_hour", pivot_hour())
               .groupBy("order_dow", "order_dow_name").pivot("_hour", [*HOURS, -1]).agg(_n()))
    cells = [F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h:02d}") for h in HOURS]
    cells.append(F.coalesce(F.col("-1"), F.lit(0)).alias("h_other"))
    return (p.select("order_dow", F.col("order_dow_name").alias("day"), *cells)
             .orderBy(*asc("order_dow", "day")))


def viz_gap_days_hist(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Gap-day histogram: grouped by the raw value, shown rounded to 0 dp
    (fractional gaps can therefore give repeated labels)."""
    g = (orders.filter(F.col("days_since_prior_order").isNotNull())
               .groupBy("days_since_prior_order").agg(_n().alias("n"))
               .orderBy(*asc("days_since_prior_order")))
    return _named(g.select(F.bround("days_since_prior_order", 0).cast("double"), "n"),
                  "viz_gap_days_hist")


def viz_top_products(orders: DataFrame | None, items: DataFrame, k: int = TOP_K) -> DataFrame:
    keys = ["product_name", "department", "aisle"]
    g = (_product_stats(items, keys)
         .select(*keys, "times_ordered", "times_reordered",
                 ratio_pct(F.col("_mean_reordered")).alias("r"))
         .orderBy(F.desc("times_ordered"), *asc(*keys)).limit(k))
    return _named(g, "viz_top_products")


def viz_top_reorder_rate(orders: DataFrame | None, items: DataFrame,
                         k: int = TOP_K, min_orders: int = MIN_TIMES_ORDERED) -> DataFrame:
    """Products ranked by their *rounded* reorder rate, at least ``min_orders`` orders."""
    keys = ["product_name", "department"]
    g = (items.groupBy(*keys)
              .agg(_n().alias("times_ordered"),
                   ratio_pct(F.avg("reordered")).alias("r"))
              .filter(F.col("times_ordered") >= min_orders)
              .orderBy(F.desc("r"), *asc(*keys)).limit(k))
    return _named(g.select(*keys, "times_ordered", "r"), "viz_top_reorder_rate")


def viz_basket_size(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    g = orders.groupBy("total_items").agg(_n().alias("n")).orderBy(*asc("total_items"))
    return _named(g, "viz_basket_size")


def viz_departments(orders: DataFrame | None, items: DataFrame) -> DataFrame:
    g = (_department_stats(items)
         .select("department", "items_ordered", "unique_products", "reordered_count",
                 ratio_pct(F.col("_mean_reordered")).alias("r"))
         .orderBy(F.desc("items_ordered"), *asc("department")))
    return _named(g, "viz_departments")


def viz_top_aisles(orders: DataFrame | None, items: DataFrame, k: int = TOP_K) -> DataFrame:
    g = _aisle_stats(items).orderBy(F.desc("items_ordered"), *asc("aisle", "department")).limit(k)
    return _named(g, "viz_top_aisles")


def viz_dept_reorder_rate(orders: DataFrame | None, items: DataFrame) -> DataFrame:
    g = (items.groupBy("department")
              .agg(_n().alias("total_items"), F.sum("reordered").alias("reordered"),
                   ratio_pct(F.avg("reordered")).alias("r"))
              .orderBy(F.desc("r"), *asc("department")))
    return _named(g, "viz_dept_reorder_rate")


def viz_top_users(orders: DataFrame, items: DataFrame | None = None, k: int = TOP_K) -> DataFrame:
    """Top users plus the unweighted mean of per-order reorder percentages
    (orders without items are skipped; a user with only empty orders -> NULL)."""
    g = (_user_stats(orders)
         .select("user_id", "total_orders", "total_items_ordered", "max_order_number",
                 "avg_days_between_orders",
                 F.bround(F.col("_mean_order_reorder_pct"), 1).alias("r"))
         .orderBy(F.desc("total_orders"), *asc("user_id")).limit(k))
    return _named(g, "viz_top_users")


def viz_cart_position(orders: DataFrame | None, items: DataFrame) -> DataFrame:
    g = (_cart_positions(items)
         .select("add_to_cart_order", "times_ordered", "reorder_rate_pct")
         .orderBy(*asc("add_to_cart_order")))
    return _named(g, "viz_cart_position")


# Registry: query id -> function(orders, items). Order follows the inventory.
METRICS = {
    "overview": overview,
    "orders_by_dow": orders_by_dow,
    "orders_by_hour": orders_by_hour,
    "basket_size_dist": basket_size_dist,
    "top_products": top_products,
    "top_departments": top_departments,
    "top_aisles": top_aisles,
    "reorder_rate_by_department": reorder_rate_by_department,
    "top_users": top_users,
    "cart_position_reorder": cart_position_reorder,
    "heatmap_dow_hour": heatmap_dow_hour,
    "eval_set_dist": eval_set_dist,
    "kpi_total_orders": kpi_total_orders,
    "kpi_total_users": kpi_total_users,
    "kpi_total_items": kpi_total_items,
    "kpi_avg_items": kpi_avg_items,
    "kpi_avg_gap_days": kpi_avg_gap_days,
    "kpi_reorder_rate": kpi_reorder_rate,
    "viz_orders_by_dow": viz_orders_by_dow,
    "viz_orders_by_hour": viz_orders_by_hour,
    "viz_heatmap": viz_heatmap,
    "viz_heatmap_pivot": viz_heatmap_pivot,
    "viz_gap_days_hist": viz_gap_days_hist,
    "viz_top_products": viz_top_products,
    "viz_top_reorder_rate": viz_top_reorder_rate,
    "viz_basket_size": viz_basket_size,
    "viz_departments": viz_departments,
    "viz_top_aisles": viz_top_aisles,
    "viz_dept_reorder_rate": viz_dept_reorder_rate,
    "viz_top_users": viz_top_users,
    "viz_cart_position": viz_cart_position,
}
