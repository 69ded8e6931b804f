"""Metric library: ORDER BY on sorted queries, invariants, labels, oracle parity."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def wh(spark):
    from cartscope.sources.warehouse import warehouse_tables
    return warehouse_tables(spark, SF_SMALL)


def _rows(df):
    return [tuple(r) for r in df.collect()]


SORTED = {  # query -> (sort columns, descending flags)
    "orders_by_dow": (["order_dow"], [False]),
    "orders_by_hour": (["hour"], [False]),
    "basket_size_dist": (["items_in_order"], [False]),
    "top_products": (["times_ordered"], [True]),
    "top_departments": (["items_ordered"], [True]),
    "top_aisles": (["items_ordered"], [True]),
    "reorder_rate_by_department": (["reorder_rate_pct"], [True]),
    "top_users": (["total_orders"], [True]),
    "cart_position_reorder": (["cart_position"], [False]),
    "heatmap_dow_hour": (["order_dow", "hour"], [False, False]),
    "viz_orders_by_dow": (["dow_0_sun"], [False]),
    "viz_orders_by_hour": (["hour_0_23"], [False]),
    "viz_heatmap": (["order_dow", "hour"], [False, False]),
    "viz_gap_days_hist": (["days_since_prior_order"], [False]),
    "viz_top_products": (["times_ordered"], [True]),
    "viz_top_reorder_rate": (["reorder_rate_pct"], [True]),
    "viz_basket_size": (["items_in_order"], [False]),
    "viz_departments": (["items_ordered"], [True]),
    "viz_top_aisles": (["items_ordered"], [True]),
    "viz_dept_reorder_rate": (["reorder_rate_pct"], [True]),
    "viz_top_users": (["total_orders"], [True]),
    "viz_cart_position": (["cart_position"], [False]),
}


@pytest.mark.parametrize("name", sorted(SORTED))
def test_result_is_ordered(wh, name):
    from cartscope.plans.metrics import METRICS
    df = METRICS[name](*wh)
    cols, desc = SORTED[name]
    keys = [tuple(r[c] for c in cols) for r in df.collect()]
    assert keys, name
    for a, b in zip(keys, keys[1:]):
        for x, y, d in zip(a, b, desc):
            if x == y:
                continue
            assert (x > y) if d else (x < y), (name, a, b)
            break


def test_invariants(wh):
    from cartscope.plans import metrics as M
    orders, items = wh
    n_orders = orders.count()
    s = orders.agg(F.sum("total_items").alias("ti"), F.sum("total_reordered").alias("tr")).first()
    assert s.ti == items.count()
    assert s.tr == items.agg(F.sum("reordered")).first()[0]
    for fn, col in [(M.orders_by_dow, "total_orders"), (M.orders_by_hour, "total_orders"),
                    (M.basket_size_dist, "order_count"), (M.heatmap_dow_hour, "total_orders"),
                    (M.eval_set_dist, "total_orders")]:
        assert fn(orders).agg(F.sum(col)).first()[0] == n_orders, fn.__name__
    ov = M.overview(orders).first()
    assert ov.total_items_ordered == M.kpi_total_items(None, items).first()[0]


def test_labels_roundtrip(wh):
    from cartscope.plans.labels import with_labels
    from cartscope.plans.metrics import METRICS
    from cartscope.schema import LABELS
    for qid, labels in LABELS.items():
        assert with_labels(METRICS[qid](*wh), qid).columns == labels


def test_snake_names():
    from cartscope.schema import snake
    assert snake("Avg Items / Order") == "avg_items_per_order"
    assert snake("DOW (0=Sun)") == "dow_0_sun"
    assert snake("Reorder Rate %") == "reorder_rate_pct"


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["department", "total_items", "reordered", "reorder_rate_pct"]
    from cartscope import registry
    # the library's own queries all have SQL; the optional ones where SQL can express them
    assert set(registry.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def _duck(sf):
    import duckdb
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _canon(rows):
    # exact values: both sides round half-to-even on the same doubles
    return sorted((tuple(r) for r in rows), key=repr)


def test_oracle_parity_small(spark):
    """Every query of the library equals its DuckDB twin at sf0.001, value for value
    (as a multiset of rows). The optional queries have tests of their own."""
    import __spark_entry__ as E
    from cartscope import registry
    con = _duck(SF_SMALL)
    sql = E.oracle_sql()
    bad = []
    for name, fn in registry.QUERIES.items():
        df = fn(spark, SF_SMALL)
        got = df.collect()
        cur = con.execute(sql[name])
        cols = [d[0] for d in cur.description]
        exp = cur.fetchall()
        if sorted(cols) != sorted(df.columns):
            bad.append((name, "columns"))
            continue
        idx = [cols.index(c) for c in df.columns]
        exp = [tuple(r[i] for i in idx) for r in exp]
        if _canon([tuple(r) for r in got]) != _canon(exp):
            bad.append((name, "values"))
    assert bad == []
