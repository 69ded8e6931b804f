"""Table schemas, fixed lookup values and dashboard labels.

The warehouse has no unsigned integers in Spark, so each unsigned column is
widened to the next signed type that holds its range; ``UNSIGNED_BITS`` keeps
the original width so out-of-range values can be routed to rejects.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# --- Fixed values (must equal the source system's) -------------------------
# Day index -> English day name; 0 = Sunday. Any other index is "Unknown".
DOW_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
UNKNOWN_DAY = "Unknown"
# Defaults for missing fields in the lenient flatten.
DEFAULT_EVAL_SET = "prior"
# Cart-position cut-off used by the cart-position metrics.
CART_POSITION_LIMIT = 20
# Minimum times ordered for the reorder-rate ranking.
MIN_TIMES_ORDERED = 3
# --------------------------------------------------------------------------

ORDERS_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("order_number", T.LongType(), False),
    T.StructField("order_dow", T.ShortType(), False),
    T.StructField("order_dow_name", T.StringType(), False),
    T.StructField("order_hour_of_day", T.ShortType(), False),
    T.StructField("days_since_prior_order", T.FloatType(), True),
    T.StructField("eval_set", T.StringType(), False),
    T.StructField("total_items", T.IntegerType(), False),
    T.StructField("total_reordered", T.IntegerType(), False),
])

ORDER_ITEMS_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("aisle_id", T.IntegerType(), False),
    T.StructField("aisle", T.StringType(), False),
    T.StructField("department_id", T.ShortType(), False),
    T.StructField("department", T.StringType(), False),
    T.StructField("add_to_cart_order", T.ShortType(), False),
    T.StructField("reordered", T.ShortType(), False),
])

ORDERS_COLUMNS = [f.name for f in ORDERS_SCHEMA.fields]
ORDER_ITEMS_COLUMNS = [f.name for f in ORDER_ITEMS_SCHEMA.fields]

# Width in bits of each unsigned warehouse column (range check before widening).
UNSIGNED_BITS = {
    "order_id": 32, "user_id": 32, "order_number": 32, "order_dow": 8,
    "order_hour_of_day": 8, "total_items": 16, "total_reordered": 16,
    "product_id": 32, "aisle_id": 16, "department_id": 8,
    "add_to_cart_order": 8, "reordered": 8,
}

# Sort keys of the two warehouse tables (also the bucketing key prefix).
ORDERS_SORT_KEY = ["user_id", "order_id"]
ORDER_ITEMS_SORT_KEY = ["order_id", "product_id"]

# Verbatim dashboard labels per query id (fixed values: the dashboard shows these).
LABELS = {
    "kpi_total_orders": ["Total Orders"],
    "kpi_total_users": ["Total Users"],
    "kpi_total_items": ["Total Items Ordered"],
    "kpi_avg_items": ["Avg Items / Order"],
    "kpi_avg_gap_days": ["Avg Days Between Orders"],
    "kpi_reorder_rate": ["Overall Reorder Rate %"],
    "viz_orders_by_dow": ["DOW (0=Sun)", "Day", "Total Orders"],
    "viz_orders_by_hour": ["Hour (0-23)", "Total Orders"],
    "viz_heatmap": ["Day", "order_dow", "Hour", "Orders"],
    "viz_gap_days_hist": ["Days Since Prior Order", "Order Count"],
    "viz_top_products": ["Product", "Department", "Aisle", "Times Ordered",
                         "Times Reordered", "Reorder Rate %"],
    "viz_top_reorder_rate": ["Product", "Department", "Times Ordered", "Reorder Rate %"],
    "viz_basket_size": ["Items in Order", "Number of Orders"],
    "viz_departments": ["Department", "Items Ordered", "Unique Products",
                        "Reordered Count", "Reorder Rate %"],
    "viz_top_aisles": ["Aisle", "Department", "Items Ordered", "Unique Products"],
    "viz_dept_reorder_rate": ["Department", "Total Items", "Reordered", "Reorder Rate %"],
    "viz_top_users": ["User ID", "Total Orders", "Total Items Ordered", "Max Order Number",
                      "Avg Days Between Orders", "Avg Reorder Rate %"],
    "viz_cart_position": ["Cart Position", "Times at This Position", "Reorder Rate %"],
}


def snake(label: str) -> str:
    """Column name used in DataFrames for a dashboard label.

    ``%`` reads as ``pct`` and ``/`` as ``per``; every other run of
    non-alphanumerics becomes one underscore: ``Avg Items / Order`` ->
    ``avg_items_per_order``, ``DOW (0=Sun)`` -> ``dow_0_sun``.
    """
    s = label.replace("%", " pct ").replace("/", " per ")
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_")
    return s.lower()


def snake_columns(query_id: str) -> list[str]:
    return [snake(x) for x in LABELS[query_id]]
