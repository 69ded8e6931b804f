"""Findings the dashboard report states in prose (R1–R5), as queries.

Each is a second aggregation over a small first-level aggregate (7 weekdays,
24 hours, their 168 cells, or a top-10 list), so the extra work is constant.
Branches that share a first-level aggregate share its shuffle (Spark reuses
identical exchanges), and one-row results are combined by a union and a
column-wise ``max`` — never by a join.

Ties: the lower day index / hour wins the "busiest" and "quietest" picks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartscope.plans.metrics import top_products

DEFAULT_KEYWORD = "Organic"   # the report's observation about the top 10
EVENING_FROM = 17             # "after 17:00": hours strictly greater


def _one_row(*parts: DataFrame) -> DataFrame:
    """Merge one-row results with disjoint columns into one row (union + max)."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def _argmax(value: str, score: Column, tiebreak: Column) -> Column:
    return F.max_by(F.col(value), F.struct(score, -tiebreak))


def _argmin(value: str, score: Column, tiebreak: Column) -> Column:
    return F.min_by(F.col(value), F.struct(score, tiebreak))


def insight_busiest_day(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Busiest and quietest weekday with their order counts."""
    d = (orders.groupBy("order_dow", "order_dow_name").agg(F.count(F.lit(1)).alias("total_orders"))
         .withColumnRenamed("order_dow_name", "day_of_week"))
    n, dow = F.col("total_orders"), F.col("order_dow")
    return d.agg(_argmax("day_of_week", n, dow).alias("busiest_day"),
                 F.max(n).alias("busiest_day_orders"),
                 _argmin("day_of_week", n, dow).alias("quietest_day"),
                 F.min(n).alias("quietest_day_orders"))


def peak_hours(h: DataFrame) -> DataFrame:
    """The peak and second hour and the two means, from ``(hour, total_orders)``
    with one row an hour: at most 256 rows, ranked in one aggregate."""
    n, hour = F.col("total_orders"), F.col("hour")
    ranked = F.sort_array(F.collect_list(F.struct(n.alias("n"), (-hour.cast("int")).alias("early"),
                                                  hour.alias("hour"))), asc=False)
    return h.agg(
        ranked.alias("top"),
        F.bround(F.avg(F.when(hour <= EVENING_FROM, n)), 2).alias("avg_orders_per_hour_to_17"),
        F.bround(F.avg(F.when(hour > EVENING_FROM, n)), 2).alias("avg_orders_per_hour_after_17"),
    ).select(F.get("top", F.lit(0))["hour"].alias("peak_hour"), F.get("top", F.lit(0))["n"].alias("peak_hour_orders"),
             F.get("top", F.lit(1))["hour"].alias("second_hour"), F.get("top", F.lit(1))["n"].alias("second_hour_orders"),
             "avg_orders_per_hour_to_17", "avg_orders_per_hour_after_17")


def insight_peak_hours(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """R2: the two peak hours, and the mean orders per (active) hour up to and
    after 17:00. One scan of ``orders``, no join."""
    return peak_hours(orders.groupBy(F.col("order_hour_of_day").alias("hour"))
                      .agg(F.count(F.lit(1)).alias("total_orders")))


def insight_promo_slot(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """The recommended promotion slot — busiest weekday and busiest hour
    (the two marginals), plus the single busiest weekday x hour cell."""
    cells = orders.groupBy("order_dow", "order_dow_name", "order_hour_of_day").agg(
        F.count(F.lit(1)).alias("n"))
    days = cells.groupBy("order_dow", "order_dow_name").agg(F.sum("n").alias("n"))
    hours = cells.groupBy("order_hour_of_day").agg(F.sum("n").alias("n"))
    n = F.col("n")
    day = days.agg(_argmax("order_dow_name", n, F.col("order_dow")).alias("promo_day"))
    hour = hours.agg(_argmax("order_hour_of_day", n, F.col("order_hour_of_day"))
                     .alias("promo_hour"))
    rank = F.struct(n, -F.col("order_dow"), -F.col("order_hour_of_day"))
    cell = cells.agg(F.max_by("order_dow_name", rank).alias("busiest_cell_day"),
                     F.max_by("order_hour_of_day", rank).alias("busiest_cell_hour"),
                     F.max(n).alias("busiest_cell_orders"))
    return _one_row(day, hour, cell)


def insight_top3_products(orders: DataFrame | None, items: DataFrame) -> DataFrame:
    """The three most ordered products."""
    return top_products(None, items, k=3)


def insight_keyword_share(orders: DataFrame | None, items: DataFrame,
                          keyword: str = DEFAULT_KEYWORD, k: int = 10) -> DataFrame:
    """Share (%) of the top-``k`` products whose name contains ``keyword``
    (case-sensitive substring)."""
    top = top_products(None, items, k=k)
    hit = F.col("product_name").contains(keyword).cast("int")
    return top.agg(F.lit(keyword).alias("keyword"),
                   F.sum(hit).cast("long").alias("products_with_keyword"),
                   F.count(F.lit(1)).alias("top_n"),
                   F.bround(F.avg(hit) * F.lit(100.0), 1).alias("share_pct"))


INSIGHTS = {
    "insight_busiest_day": insight_busiest_day,
    "insight_peak_hours": insight_peak_hours,
    "insight_promo_slot": insight_promo_slot,
    "insight_top3_products": insight_top3_products,
    "insight_keyword_share": insight_keyword_share,
}
