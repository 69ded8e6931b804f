"""DuckDB oracle SQL for every registered query.

The warehouse tables are derived relationally from the driver's parquet views
(``orders``, ``lineitem``, ``part``) with plain window functions — a different
route from the Spark build — and each metric is the dashboard statement with
the documented deviations: half-to-even rounding (``round_even``), DOUBLE
rates, explicit tie-breakers before every LIMIT, skip-empty-orders division.
"""

from __future__ import annotations

DOW_CASE = ("CASE {d} WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' "
            "WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' "
            "WHEN 6 THEN 'Saturday' ELSE 'Unknown' END")

# Flat tables from the TPC-H-ish views: w_orders, w_items.
WAREHOUSE_CTE = f"""
w_seq AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_date,
         row_number() OVER (PARTITION BY o_custkey
                            ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS rn,
         lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey
                            ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS prev_date
  FROM orders),
w_base AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS user_id,
         CAST(rn AS BIGINT) AS order_number,
         CAST(dayofweek(o_date) AS SMALLINT) AS order_dow,
         {DOW_CASE.format(d='dayofweek(o_date)')} AS order_dow_name,
         CAST(o_orderkey % 24 AS SMALLINT) AS order_hour_of_day,
         CAST(date_diff('day', prev_date, o_date) AS FLOAT) AS days_since_prior_order,
         CASE o_orderstatus WHEN 'F' THEN 'prior' WHEN 'O' THEN 'train' ELSE 'test' END AS eval_set
  FROM w_seq),
w_types AS (
  SELECT p_type, CAST(dense_rank() OVER (ORDER BY p_type) AS SMALLINT) AS department_id
  FROM (SELECT DISTINCT p_type FROM part)),
w_prod AS (
  SELECT CAST(p.p_partkey AS BIGINT) AS product_id, p.p_name AS product_name,
         CAST(regexp_extract(p.p_brand, '#(\\d+)', 1) AS INTEGER) AS aisle_id,
         p.p_brand AS aisle, t.department_id, p.p_type AS department
  FROM part p JOIN w_types t ON p.p_type = t.p_type),
w_it AS (
  SELECT CAST(l.l_orderkey AS BIGINT) AS order_id, o.user_id, o.order_number,
         pr.product_id, pr.product_name, pr.aisle_id, pr.aisle, pr.department_id,
         pr.department, CAST(l.l_linenumber * 4 - 3 AS SMALLINT) AS add_to_cart_order
  FROM lineitem l JOIN w_base o ON l.l_orderkey = o.order_id
  JOIN w_prod pr ON l.l_partkey = pr.product_id),
w_items AS (
  SELECT order_id, user_id, product_id, product_name, aisle_id, aisle, department_id,
         department, add_to_cart_order,
         CAST(CASE WHEN order_number > min(order_number) OVER (PARTITION BY user_id, product_name)
                   THEN 1 ELSE 0 END AS SMALLINT) AS reordered
  FROM w_it),
w_tot AS (
  SELECT order_id, CAST(count(*) AS INTEGER) AS total_items,
         CAST(sum(reordered) AS INTEGER) AS total_reordered
  FROM w_items GROUP BY order_id),
w_orders AS (
  SELECT b.order_id, b.user_id, b.order_number, b.order_dow, b.order_dow_name,
         b.order_hour_of_day, b.days_since_prior_order, b.eval_set,
         COALESCE(t.total_items, 0) AS total_items,
         COALESCE(t.total_reordered, 0) AS total_reordered
  FROM w_base b LEFT JOIN w_tot t ON b.order_id = t.order_id)
"""

R = "round_even"
D = "100.0::DOUBLE"


def _w(select: str) -> str:
    return f"WITH {WAREHOUSE_CTE}\n{select}"


METRIC_SQL = {
    "overview": f"""SELECT count(*) AS total_orders, count(DISTINCT user_id) AS total_users,
        CAST(sum(total_items) AS BIGINT) AS total_items_ordered,
        {R}(avg(total_items), 2) AS avg_items_per_order,
        {R}(avg(days_since_prior_order), 1) AS avg_days_between_orders FROM w_orders""",
    "orders_by_dow": """SELECT order_dow_name AS day_of_week, order_dow, count(*) AS total_orders
        FROM w_orders GROUP BY order_dow_name, order_dow ORDER BY order_dow""",
    "orders_by_hour": """SELECT order_hour_of_day AS hour, count(*) AS total_orders
        FROM w_orders GROUP BY order_hour_of_day ORDER BY hour""",
    "basket_size_dist": """SELECT total_items AS items_in_order, count(*) AS order_count
        FROM w_orders GROUP BY total_items ORDER BY total_items""",
    "top_products": f"""SELECT product_name, department, aisle, count(*) AS times_ordered,
        CAST(sum(reordered) AS BIGINT) AS times_reordered,
        {R}(CAST(sum(reordered) AS DOUBLE) * {D} / count(*), 1) AS reorder_rate_pct
        FROM w_items GROUP BY product_name, department, aisle
        ORDER BY times_ordered DESC, product_name, department, aisle LIMIT 10""",
    "top_departments": f"""SELECT department, count(*) AS items_ordered,
        count(DISTINCT product_id) AS unique_products,
        CAST(sum(reordered) AS BIGINT) AS reordered_count,
        {R}(CAST(sum(reordered) AS DOUBLE) * {D} / count(*), 1) AS reorder_rate_pct
        FROM w_items GROUP BY department ORDER BY items_ordered DESC, department LIMIT 10""",
    "top_aisles": """SELECT aisle, department, count(*) AS items_ordered,
        count(DISTINCT product_id) AS unique_products
        FROM w_items GROUP BY aisle, department
        ORDER BY items_ordered DESC, aisle, department LIMIT 10""",
    "reorder_rate_by_department": f"""SELECT department, count(*) AS total_items,
        CAST(sum(reordered) AS BIGINT) AS reordered,
        {R}(CAST(sum(reordered) AS DOUBLE) * {D} / count(*), 1) AS reorder_rate_pct
        FROM w_items GROUP BY department ORDER BY reorder_rate_pct DESC, department""",
    "top_users": f"""SELECT user_id, count(*) AS total_orders,
        CAST(sum(total_items) AS BIGINT) AS total_items_ordered,
        max(order_number) AS max_order_number,
        {R}(avg(days_since_prior_order), 1) AS avg_days_between_orders
        FROM w_orders GROUP BY user_id ORDER BY total_orders DESC, user_id LIMIT 10""",
    "cart_position_reorder": f"""SELECT add_to_cart_order AS cart_position,
        count(*) AS times_ordered, {R}(avg(reordered) * {D}, 1) AS reorder_rate_pct
        FROM w_items WHERE add_to_cart_order <= 20
        GROUP BY add_to_cart_order ORDER BY cart_position""",
    "heatmap_dow_hour": """SELECT o.order_dow_name AS day_of_week, o.order_dow,
        o.order_hour_of_day AS hour, count(*) AS total_orders
        FROM w_orders o GROUP BY o.order_dow_name, o.order_dow, o.order_hour_of_day
        ORDER BY order_dow, hour""",
    "eval_set_dist": """SELECT eval_set, count(*) AS total_orders,
        count(DISTINCT user_id) AS total_users FROM w_orders GROUP BY eval_set""",
    "kpi_total_orders": "SELECT count(*) AS total_orders FROM w_orders",
    "kpi_total_users": "SELECT count(DISTINCT user_id) AS total_users FROM w_orders",
    "kpi_total_items": "SELECT count(*) AS total_items_ordered FROM w_items",
    "kpi_avg_items": f"SELECT {R}(avg(total_items), 1) AS avg_items_per_order FROM w_orders",
    "kpi_avg_gap_days": f"""SELECT {R}(avg(days_since_prior_order), 1) AS avg_days_between_orders
        FROM w_orders WHERE days_since_prior_order IS NOT NULL""",
    "kpi_reorder_rate": f"""SELECT {R}(avg(reordered) * {D}, 1) AS overall_reorder_rate_pct
        FROM w_items""",
    "viz_orders_by_dow": """SELECT order_dow AS dow_0_sun, order_dow_name AS day,
        count(*) AS total_orders FROM w_orders GROUP BY order_dow, order_dow_name
        ORDER BY order_dow""",
    "viz_orders_by_hour": """SELECT order_hour_of_day AS hour_0_23, count(*) AS total_orders
        FROM w_orders GROUP BY order_hour_of_day ORDER BY order_hour_of_day""",
    "viz_heatmap": """SELECT order_dow_name AS day, order_dow, order_hour_of_day AS hour,
        count(*) AS orders FROM w_orders
        GROUP BY order_dow_name, order_dow, order_hour_of_day
        ORDER BY order_dow, order_hour_of_day""",
    "viz_heatmap_pivot": "SELECT order_dow, order_dow_name AS day, "
        + ", ".join(f"count(*) FILTER (WHERE order_hour_of_day = {h}) AS h{h:02d}"
                    for h in range(24))
        + ", count(*) FILTER (WHERE order_hour_of_day IS NULL OR order_hour_of_day NOT BETWEEN 0 AND 23) AS h_other"
        + " FROM w_orders GROUP BY order_dow, order_dow_name ORDER BY order_dow",
    "viz_gap_days_hist": f"""SELECT CAST({R}(days_since_prior_order, 0) AS DOUBLE)
        AS days_since_prior_order, count(*) AS order_count FROM w_orders
        WHERE days_since_prior_order IS NOT NULL
        GROUP BY days_since_prior_order ORDER BY days_since_prior_order""",
    "viz_top_products": f"""SELECT product_name AS product, department, aisle,
        count(*) AS times_ordered, CAST(sum(reordered) AS BIGINT) AS times_reordered,
        {R}(avg(reordered) * {D}, 1) AS reorder_rate_pct
        FROM w_items GROUP BY product_name, department, aisle
        ORDER BY times_ordered DESC, product_name, department, aisle LIMIT 10""",
    "viz_top_reorder_rate": f"""SELECT product_name AS product, department,
        count(*) AS times_ordered, {R}(avg(reordered) * {D}, 1) AS reorder_rate_pct
        FROM w_items GROUP BY product_name, department HAVING count(*) >= 3
        ORDER BY reorder_rate_pct DESC, product_name, department LIMIT 10""",
    "viz_basket_size": """SELECT total_items AS items_in_order, count(*) AS number_of_orders
        FROM w_orders GROUP BY total_items ORDER BY total_items""",
    "viz_departments": f"""SELECT department, count(*) AS items_ordered,
        count(DISTINCT product_id) AS unique_products,
        CAST(sum(reordered) AS BIGINT) AS reordered_count,
        {R}(avg(reordered) * {D}, 1) AS reorder_rate_pct
        FROM w_items GROUP BY department ORDER BY items_ordered DESC, department""",
    "viz_top_aisles": """SELECT aisle, department, count(*) AS items_ordered,
        count(DISTINCT product_id) AS unique_products FROM w_items
        GROUP BY aisle, department ORDER BY items_ordered DESC, aisle, department LIMIT 10""",
    "viz_dept_reorder_rate": f"""SELECT department, count(*) AS total_items,
        CAST(sum(reordered) AS BIGINT) AS reordered,
        {R}(avg(reordered) * {D}, 1) AS reorder_rate_pct
        FROM w_items GROUP BY department ORDER BY reorder_rate_pct DESC, department""",
    "viz_top_users": f"""SELECT user_id, count(*) AS total_orders,
        CAST(sum(total_items) AS BIGINT) AS total_items_ordered,
        max(order_number) AS max_order_number,
        {R}(avg(days_since_prior_order), 1) AS avg_days_between_orders,
        {R}(avg(CASE WHEN total_items > 0
                     THEN total_reordered * {D} / total_items END), 1) AS avg_reorder_rate_pct
        FROM w_orders GROUP BY user_id ORDER BY total_orders DESC, user_id LIMIT 10""",
    "viz_cart_position": f"""SELECT add_to_cart_order AS cart_position,
        count(*) AS times_at_this_position, {R}(avg(reordered) * {D}, 1) AS reorder_rate_pct
        FROM w_items WHERE add_to_cart_order <= 20
        GROUP BY add_to_cart_order ORDER BY add_to_cart_order""",
}




# ---- ETL round trip: expected flatten outputs of the landed dirty payload ----
# (rules in cartscope/sources/payload_fixture.py; first matching rule wins)
ETL_CTE = f"""
e_orders AS (
  SELECT order_id, user_id, order_number,
         CAST(CASE WHEN order_id % 61 = 0 THEN order_dow + 7 ELSE order_dow END AS SMALLINT)
           AS order_dow,
         {DOW_CASE.format(d='CASE WHEN order_id % 61 = 0 THEN order_dow + 7 ELSE order_dow END')}
           AS order_dow_name,
         order_hour_of_day,
         CASE WHEN order_id % 97 = 0 THEN NULL ELSE days_since_prior_order END
           AS days_since_prior_order,
         CASE WHEN order_id % 79 = 0 THEN 'prior' ELSE eval_set END AS eval_set,
         total_items, total_reordered
  FROM w_orders),
e_items AS (SELECT * FROM w_items),
r_reject AS (
  SELECT order_id,
         CASE WHEN (order_id // 1000) % 5 = 4 THEN 'payload is a list'
              WHEN order_id % 67 = 0 THEN 'order_hour_of_day not an integer'
              ELSE 'days_since_prior_order not a number' END AS reason
  FROM w_orders
  WHERE (order_id // 1000) % 5 = 4 OR order_id % 67 = 0 OR order_id % 97 = 0),
r_orders AS (
  SELECT order_id, user_id, order_number, order_dow, order_dow_name, order_hour_of_day,
         days_since_prior_order, eval_set, total_items,
         CAST(CASE WHEN order_id % 71 = 0 THEN 0 ELSE total_reordered END AS INTEGER)
           AS total_reordered
  FROM e_orders WHERE order_id NOT IN (SELECT order_id FROM r_reject)),
r_items AS (SELECT * FROM e_items WHERE order_id NOT IN (SELECT order_id FROM r_reject)),
e_docs AS (SELECT order_id // 1000 AS doc_id, count(*) AS n FROM w_orders GROUP BY 1)
"""

ORDERS_COLS = ("order_id, user_id, order_number, order_dow, order_dow_name, order_hour_of_day, "
               "days_since_prior_order, eval_set, total_items, total_reordered")
ITEMS_COLS = ("order_id, user_id, product_id, product_name, aisle_id, aisle, department_id, "
              "department, add_to_cart_order, reordered")


ALL_COLS = ("order_id, user_id, order_number, order_dow, order_dow_name, order_hour_of_day, "
            "days_since_prior_order, eval_set, total_items, total_reordered, product_id, product_name, aisle_id, "
            "aisle, department_id, department, add_to_cart_order, reordered")


def _all_cols(table: str, have: str) -> str:
    names = have.split(", ")
    return (f"SELECT '{table}' AS table_name, "
            + ", ".join(c if c in names else f"NULL AS {c}" for c in ALL_COLS.split(", ")))


def _redelivered(changed: str) -> str:
    """Each order in its latest delivery; ``changed`` says which were changed."""
    return f"""SELECT order_id, user_id, order_number, order_dow, order_dow_name,
        CAST(CASE WHEN {changed} THEN (order_hour_of_day + 5) % 24 ELSE order_hour_of_day END AS SMALLINT)
          AS order_hour_of_day, days_since_prior_order, eval_set,
        CAST(coalesce(n, 0) AS INTEGER) AS total_items, CAST(coalesce(r, 0) AS INTEGER) AS total_reordered,
        CAST(coalesce(n, 0) AS BIGINT) AS loaded_items
        FROM e_orders LEFT JOIN (
          SELECT order_id, count(*) AS n, sum(reordered) AS r FROM e_items
          WHERE NOT (({changed}) AND add_to_cart_order > 5) GROUP BY order_id) USING (order_id)"""


def _ledger(*lines: tuple[str, str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{step}' AS step, '{table}' AS table_name, CAST(({e}) AS BIGINT) AS expected, "
        f"CAST(({a}) AS BIGINT) AS actual, ({e}) = ({a}) AS ok" for step, table, e, a in lines)


def _counts(o: str, i: str, col: str = "row_count", k: int = 1) -> str:
    return (f"SELECT 'orders' AS table_name, CAST(count(*) * {k} AS BIGINT) AS {col} FROM {o} "
            f"UNION ALL SELECT 'order_items' AS table_name, CAST(count(*) * {k} AS BIGINT) "
            f"AS {col} FROM {i}")


ETL_SQL = {
    "read_orders_payload": "SELECT order_id, user_id, total_items AS n_products FROM w_orders",
    "payload_summary": """SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS order_count,
        CAST(sum(CASE WHEN doc_id % 5 = 4 OR doc_id % 7 = 3 THEN n ELSE n + doc_id % 3 END)
             AS BIGINT) AS total_orders FROM e_docs""",
    "read_flat_staging": f"SELECT {ITEMS_COLS} FROM e_items",
    "land_raw": """SELECT count(DISTINCT order_id // 1000) AS documents, count(*) AS order_count,
        CAST(sum(total_items) AS BIGINT) AS item_count FROM w_orders""",
    "write_flat_staging": _counts("e_orders", "e_items"),
    "load_append": _counts("e_orders", "e_items", k=2),
    "load_snapshot": f"""{_all_cols("orders", ORDERS_COLS)} FROM e_orders
        UNION ALL {_all_cols("order_items", ITEMS_COLS)} FROM e_items""",
    "load_merge": _redelivered("order_id % 10 = 3 AND (order_id // 1000) % 5 = 0"),
    "ingest_redelivery": _redelivered("order_id % 10 = 3"),
    "lookup_user_orders": f"SELECT {ORDERS_COLS} FROM w_orders WHERE user_id = 7",
    "document_rejects": """SELECT 'lenient' AS mode, 'document' AS stage,
        CASE doc_id % 4 WHEN 1 THEN 'not JSON or beyond the size limit'
             WHEN 2 THEN 'orders is not a list' ELSE 'not an object or list' END AS reason,
        CAST(NULL AS BIGINT) AS order_id FROM e_docs WHERE doc_id % 4 <> 0""",
    "reconcile_ledger": _ledger(
        ("readable", "documents", "SELECT count(*) FROM e_docs", "SELECT count(*) FROM e_docs"),
        ("claimed", "orders", """SELECT sum(CASE WHEN doc_id % 5 = 4 OR doc_id % 7 = 3 THEN n ELSE n + doc_id % 3 END)
         FROM e_docs""", "SELECT sum(n) FROM e_docs"),
        ("staged", "orders", "SELECT sum(n) FROM e_docs", "SELECT count(*) FROM e_orders"),
        ("accepted or rejected", "orders", "SELECT count(*) FROM w_orders", "SELECT count(*) FROM e_orders"),
        ("accepted or rejected", "order_items", "SELECT count(*) FROM w_items", "SELECT count(*) FROM e_items"),
        ("loaded", "orders", "SELECT count(*) FROM e_orders", "SELECT count(*) FROM e_orders"),
        ("unchanged", "orders", "SELECT 0", "SELECT 0"),
        ("loaded", "order_items", "SELECT count(*) FROM e_items", "SELECT count(*) FROM e_items"),
        ("unchanged", "order_items", "SELECT 0", "SELECT 0")),
    "orders_table": f"SELECT {ORDERS_COLS} FROM e_orders",
    "order_items_table": f"SELECT {ITEMS_COLS} FROM e_items",
    "flatten_orders": f"SELECT {ORDERS_COLS} FROM e_orders",
    "flatten_order_items": f"SELECT {ITEMS_COLS} FROM e_items",
    "dow_name": """SELECT order_dow, order_dow_name, count(*) AS orders FROM e_orders
        GROUP BY order_dow, order_dow_name""",
    "total_items": "SELECT order_id, total_items FROM e_orders",
    "total_reordered": "SELECT order_id, total_reordered FROM e_orders",
    "safe_int": "SELECT order_id, order_number, order_dow, order_hour_of_day FROM e_orders",
    "safe_float": "SELECT order_id, days_since_prior_order FROM e_orders",
    "clean_text": """SELECT order_id, product_id, add_to_cart_order, product_name, aisle,
        department FROM e_items""",
    "default_fields": "SELECT order_id, eval_set, total_items FROM e_orders",
    "flatten_orders_raw": f"SELECT {ORDERS_COLS} FROM r_orders",
    "flatten_order_items_raw": f"SELECT {ITEMS_COLS} FROM r_items",
    "flatten_rejects": """SELECT 'raw' AS mode, 'order' AS stage, reason, order_id
        FROM r_reject""",
    "transform_summary": """SELECT (SELECT count(*) FROM e_orders) AS order_count,
        (SELECT count(*) FROM e_items) AS order_item_count""",
    "incremental_ingest": f"SELECT {ORDERS_COLS} FROM e_orders",
    "validate_counts": """SELECT 'orders' AS table_name, count(*) AS expected,
        count(*) AS loaded, true AS ok FROM e_orders
        UNION ALL SELECT 'order_items', count(*), count(*), true FROM e_items""",
    "validate_nonempty": """SELECT 'orders' AS table_name, count(*) AS row_count,
        count(*) > 0 AS ok FROM e_orders
        UNION ALL SELECT 'order_items', count(*), count(*) > 0 FROM e_items""",
    "table_counts": """SELECT 'orders' AS tabel, count(*) AS total FROM w_orders
        UNION ALL SELECT 'order_items' AS tabel, count(*) AS total FROM w_items""",
    "sample_orders": f"SELECT {ORDERS_COLS} FROM w_orders ORDER BY user_id, order_id LIMIT 5",
    "sample_order_items": f"SELECT {ITEMS_COLS} FROM w_items ORDER BY {ITEMS_COLS} LIMIT 5",
}


Q5_TOP = """SELECT product_name, department, aisle, count(*) AS times_ordered,
        CAST(sum(reordered) AS BIGINT) AS times_reordered,
        round_even(CAST(sum(reordered) AS DOUBLE) * 100.0::DOUBLE / count(*), 1) AS reorder_rate_pct
        FROM w_items GROUP BY product_name, department, aisle
        ORDER BY times_ordered DESC, product_name, department, aisle LIMIT {k}"""

INSIGHT_SQL = {
    "insight_busiest_day": """, d AS (SELECT order_dow_name AS day_of_week, order_dow,
          count(*) AS n FROM w_orders GROUP BY 1, 2),
        b AS (SELECT day_of_week, n FROM d ORDER BY n DESC, order_dow LIMIT 1),
        q AS (SELECT day_of_week, n FROM d ORDER BY n, order_dow LIMIT 1)
        SELECT b.day_of_week AS busiest_day, b.n AS busiest_day_orders,
               q.day_of_week AS quietest_day, q.n AS quietest_day_orders FROM b, q""",
    "insight_peak_hours": """, h AS (SELECT order_hour_of_day AS hour, count(*) AS n
          FROM w_orders GROUP BY 1),
        r AS (SELECT hour, n, row_number() OVER (ORDER BY n DESC, hour) AS rk FROM h)
        SELECT (SELECT hour FROM r WHERE rk = 1) AS peak_hour,
               (SELECT n FROM r WHERE rk = 1) AS peak_hour_orders,
               (SELECT hour FROM r WHERE rk = 2) AS second_hour,
               (SELECT n FROM r WHERE rk = 2) AS second_hour_orders,
               (SELECT round_even(avg(n), 2) FROM h WHERE hour <= 17) AS avg_orders_per_hour_to_17,
               (SELECT round_even(avg(n), 2) FROM h WHERE hour > 17) AS avg_orders_per_hour_after_17""",
    "insight_promo_slot": """, c AS (SELECT order_dow, order_dow_name, order_hour_of_day,
          count(*) AS n FROM w_orders GROUP BY 1, 2, 3)
        SELECT (SELECT order_dow_name FROM (SELECT order_dow, order_dow_name, sum(n) AS n FROM c
                 GROUP BY 1, 2) ORDER BY n DESC, order_dow LIMIT 1) AS promo_day,
               (SELECT order_hour_of_day FROM (SELECT order_hour_of_day, sum(n) AS n FROM c
                 GROUP BY 1) ORDER BY n DESC, order_hour_of_day LIMIT 1) AS promo_hour,
               (SELECT order_dow_name FROM c ORDER BY n DESC, order_dow, order_hour_of_day
                 LIMIT 1) AS busiest_cell_day,
               (SELECT order_hour_of_day FROM c ORDER BY n DESC, order_dow, order_hour_of_day
                 LIMIT 1) AS busiest_cell_hour,
               (SELECT max(n) FROM c) AS busiest_cell_orders""",
    "insight_top3_products": "\n" + Q5_TOP.format(k=3),
    "insight_keyword_share": ", t AS (" + Q5_TOP.format(k=10) + """)
        SELECT 'rod' AS keyword,
               CAST(sum(CASE WHEN contains(product_name, 'rod') THEN 1 ELSE 0 END) AS BIGINT)
                 AS products_with_keyword,
               count(*) AS top_n,
               round_even(avg(CASE WHEN contains(product_name, 'rod') THEN 1 ELSE 0 END)
                          * 100.0::DOUBLE, 1) AS share_pct FROM t""",
}


# Columns of each dashboard series, in alphabetical order.
SERIES_COLUMNS = {
    "overview": "avg_days_between_orders avg_items_per_order total_items_ordered total_orders total_users",
    "orders_by_dow": "day_of_week order_dow total_orders",
    "orders_by_hour": "hour total_orders",
    "basket_size_dist": "items_in_order order_count",
    "top_products": "aisle department product_name reorder_rate_pct times_ordered times_reordered",
    "top_departments": "department items_ordered reorder_rate_pct reordered_count unique_products",
    "top_aisles": "aisle department items_ordered unique_products",
    "reorder_rate_by_department": "department reorder_rate_pct reordered total_items",
    "top_users": "avg_days_between_orders max_order_number total_items_ordered total_orders user_id",
    "cart_position_reorder": "cart_position reorder_rate_pct times_ordered",
    "heatmap_dow_hour": "day_of_week hour order_dow total_orders",
    "eval_set_dist": "eval_set total_orders total_users",
    "kpi_total_orders": "total_orders",
    "kpi_total_users": "total_users",
    "kpi_total_items": "total_items_ordered",
    "kpi_avg_items": "avg_items_per_order",
    "kpi_avg_gap_days": "avg_days_between_orders",
    "kpi_reorder_rate": "overall_reorder_rate_pct",
    "viz_orders_by_dow": "day dow_0_sun total_orders",
    "viz_orders_by_hour": "hour_0_23 total_orders",
    "viz_heatmap": "day hour order_dow orders",
    "viz_heatmap_pivot": " ".join(["day", *(f"h{h:02d}" for h in range(24)), "h_other", "order_dow"]),
    "viz_gap_days_hist": "days_since_prior_order order_count",
    "viz_top_products": "aisle department product reorder_rate_pct times_ordered times_reordered",
    "viz_top_reorder_rate": "department product reorder_rate_pct times_ordered",
    "viz_basket_size": "items_in_order number_of_orders",
    "viz_departments": "department items_ordered reorder_rate_pct reordered_count unique_products",
    "viz_top_aisles": "aisle department items_ordered unique_products",
    "viz_dept_reorder_rate": "department reorder_rate_pct reordered total_items",
    "viz_top_users": "avg_days_between_orders avg_reorder_rate_pct max_order_number total_items_ordered"
        " total_orders user_id",
    "viz_cart_position": "cart_position reorder_rate_pct times_at_this_position",
    "insight_busiest_day": "busiest_day busiest_day_orders quietest_day quietest_day_orders",
    "insight_peak_hours": "avg_orders_per_hour_after_17 avg_orders_per_hour_to_17 peak_hour peak_hour_orders"
        " second_hour second_hour_orders",
    "insight_promo_slot": "busiest_cell_day busiest_cell_hour busiest_cell_orders promo_day promo_hour",
    "insight_top3_products": "aisle department product_name reorder_rate_pct times_ordered times_reordered",
    "insight_keyword_share": "keyword products_with_keyword share_pct top_n",
}


def _dashboard() -> str:
    """All series as text rows ``column=value|...``."""
    parts = []
    for name, columns in SERIES_COLUMNS.items():
        sql = METRIC_SQL.get(name)
        sql = sql if sql is not None else f"WITH {INSIGHT_SQL[name].lstrip(', ')}" \
            if INSIGHT_SQL[name].startswith(",") else INSIGHT_SQL[name]
        row = ", ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), '')" for c in columns.split())
        parts.append(f"SELECT '{name}' AS series, concat_ws('|', {row}) AS row FROM ({sql}) AS t")
    return "\nUNION ALL ".join(parts)


def all_sql() -> dict[str, str]:
    out = {k: _w(v) for k, v in METRIC_SQL.items()}
    out.update({k: f"WITH {WAREHOUSE_CTE}, {ETL_CTE}\n{v}" for k, v in ETL_SQL.items()})
    out.update({k: f"WITH {WAREHOUSE_CTE}{v}" for k, v in INSIGHT_SQL.items()})
    out.update(dict.fromkeys(("dashboard_refresh", "dashboard_incremental"), _w(_dashboard())))
    return out
