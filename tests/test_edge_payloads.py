"""Hand-made edge payloads E1–E24 (FIXTURES.md §2), both flatten modes."""

import pytest


def order(**kw):
    base = {"order_id": 1, "user_id": 10, "order_number": 1, "order_dow": 0,
            "order_hour_of_day": 9, "days_since_prior_order": None, "eval_set": "prior",
            "products": []}
    base.update(kw)
    return {k: v for k, v in base.items() if v is not MISSING}


MISSING = object()


def product(**kw):
    base = {"product_id": 5, "product_name": "Bananas", "aisle_id": 3, "aisle": "fruit",
            "department_id": 4, "department": "produce", "add_to_cart_order": 1, "reordered": 0}
    base.update(kw)
    return {k: v for k, v in base.items() if v is not MISSING}


def test_e1_envelope_summary(spark, write_docs, flat):
    from cartscope.sources.payload import payload_summary, read_documents
    doc = {"orders": [order(order_id=1), order(order_id=2)], "total_orders": 5}
    orders, _, _ = flat([doc])
    assert sorted(o["order_id"] for o in orders) == [1, 2]
    s = payload_summary(read_documents(spark, write_docs([doc]), multi_line=True),
                        with_timestamp=False).first()
    assert (s.documents, s.order_count, s.total_orders) == (1, 2, 5)


def test_e2_bare_list(spark, write_docs, flat):
    from cartscope.sources.payload import payload_summary, read_documents
    doc = [order(order_id=1), order(order_id=2)]
    orders, _, _ = flat([doc], "lenient")
    assert len(orders) == 2
    s = payload_summary(read_documents(spark, write_docs([doc]), multi_line=True),
                        with_timestamp=False).first()
    assert (s.order_count, s.total_orders) == (2, 2)
    orders, _, rejects = flat([doc], "raw")
    assert orders == [] and {r["reason"] for r in rejects} == {"payload is a list"}


@pytest.mark.parametrize("mode", ["lenient", "raw"])
def test_e3_envelope_without_orders(flat, mode):
    orders, items, rejects = flat([{"total_orders": 3}], mode)
    assert orders == [] and items == [] and rejects == []


@pytest.mark.parametrize("mode", ["lenient", "raw"])
def test_e4_e5_empty_or_absent_products(flat, mode):
    docs = [{"orders": [order(order_id=1, products=[]), order(order_id=2, products=MISSING)]}]
    orders, items, _ = flat(docs, mode)
    assert sorted((o["order_id"], o["total_items"]) for o in orders) == [(1, 0), (2, 0)]
    assert items == []


def test_e6_null_products(flat):
    doc = {"orders": [order(products=None)]}
    for mode in ("lenient", "raw"):
        orders, items, rejects = flat([doc], mode)
        assert orders == [] and items == []
        assert rejects[0]["reason"] == "products null or not a list"


@pytest.mark.parametrize("mode", ["lenient", "raw"])
def test_e7_quoted_order_id(flat, mode):
    orders, _, _ = flat([{"orders": [order(order_id="2")]}], mode)
    assert orders[0]["order_id"] == 2


def test_e8_missing_order_id(flat):
    doc = {"orders": [order(order_id=MISSING)]}
    orders, _, _ = flat([doc], "lenient")
    assert orders[0]["order_id"] == 0
    orders, _, rejects = flat([doc], "raw")
    assert orders == [] and rejects[0]["reason"] == "order_id missing"


def test_e9_null_dow(spark, flat):
    from cartscope.operators.normalize import fill_load_defaults
    doc = {"orders": [order(order_dow=None)]}
    orders, _, _ = flat([doc], "lenient")
    assert (orders[0]["order_dow"], orders[0]["order_dow_name"]) == (0, "Sunday")
    orders, _, _ = flat([doc], "raw")
    assert (orders[0]["order_dow"], orders[0]["order_dow_name"]) == (None, "Unknown")
    from cartscope.sources.payload import STAGING_SCHEMAS
    loaded = fill_load_defaults(spark.createDataFrame(orders, STAGING_SCHEMAS["orders"]),
                                "orders").first()
    assert (loaded.order_dow, loaded.order_dow_name) == (0, "Unknown")


@pytest.mark.parametrize("mode", ["lenient", "raw"])
def test_e10_unknown_dow(flat, mode):
    orders, _, _ = flat([{"orders": [order(order_dow=9)]}], mode)
    assert (orders[0]["order_dow"], orders[0]["order_dow_name"]) == (9, "Unknown")


def test_e11_non_integer_order_number(flat):
    docs = [{"orders": [order(order_id=1, order_number=1.7), order(order_id=2, order_number="1.7"),
                        order(order_id=3, order_number=True)]}]
    orders, _, _ = flat(docs, "lenient")
    assert sorted((o["order_id"], o["order_number"]) for o in orders) == [(1, 1), (2, 0), (3, 1)]
    orders, _, rejects = flat(docs, "raw")
    assert orders == []
    assert {r["reason"] for r in rejects} == {"order_number not an integer"}


def test_e12_gap_coercion(flat):
    text = ('{"orders": [{"order_id": 1, "days_since_prior_order": null},'
            ' {"order_id": 2, "days_since_prior_order": "abc"},'
            ' {"order_id": 3, "days_since_prior_order": "7.5"},'
            ' {"order_id": 4, "days_since_prior_order": NaN}]}')
    orders, _, _ = flat(None, "lenient", raw_text=[text])
    got = {o["order_id"]: o["days_since_prior_order"] for o in orders}
    assert got == {1: None, 2: None, 3: 7.5, 4: None}
    orders, _, rejects = flat(None, "raw", raw_text=[text])
    got = {o["order_id"]: o["days_since_prior_order"] for o in orders}
    assert got == {1: None, 3: 7.5, 4: None}
    assert [(r["order_id"], r["reason"]) for r in rejects] == [
        (2, "days_since_prior_order not a number")]


def test_e13_eval_set_default(flat):
    docs = [{"orders": [order(order_id=1, eval_set=MISSING), order(order_id=2, eval_set=None)]}]
    orders, _, _ = flat(docs, "lenient")
    assert {o["order_id"]: o["eval_set"] for o in orders} == {1: "prior", 2: "prior"}
    orders, _, _ = flat(docs, "raw")
    assert {o["order_id"]: o["eval_set"] for o in orders} == {1: "prior", 2: None}


@pytest.mark.parametrize("mode", ["lenient", "raw"])
def test_e14_strip_text(flat, mode):
    doc = {"orders": [order(products=[product(product_name="\t A \n", aisle="　b ")])]}
    _, items, _ = flat([doc], mode)
    assert (items[0]["product_name"], items[0]["aisle"]) == ("A", "b")


def test_e15_null_product_name(flat):
    doc = {"orders": [order(products=[product(product_name=None)])]}
    _, items, _ = flat([doc], "lenient")
    assert items[0]["product_name"] == ""
    _, items, rejects = flat([doc], "raw")
    assert items == [] and rejects[0]["stage"] == "item"
    assert rejects[0]["reason"] == "product_name null or not text"


def test_e16_quoted_reordered(flat):
    doc = {"orders": [order(products=[product(reordered="1"), product(product_id=6, reordered=1)])]}
    orders, items, _ = flat([doc], "lenient")
    assert orders[0]["total_reordered"] == 2 and {i["reordered"] for i in items} == {1}
    orders, items, _ = flat([doc], "raw")
    assert orders[0]["total_reordered"] == 1 and {i["reordered"] for i in items} == {1}


@pytest.mark.parametrize("mode", ["lenient", "raw"])
def test_e17_reordered_two(flat, mode):
    orders, items, _ = flat([{"orders": [order(products=[product(reordered=2)])]}], mode)
    assert orders[0]["total_reordered"] == 0 and items[0]["reordered"] == 2


def test_e18_user_with_only_empty_orders(spark):
    from cartscope.plans.metrics import viz_top_users
    from cartscope.schema import ORDERS_SCHEMA
    rows = [(1, 7, 1, 0, "Sunday", 9, None, "prior", 0, 0),
            (2, 7, 2, 1, "Monday", 9, 3.0, "prior", 0, 0)]
    o = spark.createDataFrame(rows, ORDERS_SCHEMA)
    r = viz_top_users(o).first()
    assert r.user_id == 7 and r.avg_reorder_rate_pct is None


@pytest.mark.parametrize("mode", ["lenient", "raw"])
def test_e19_unsigned_range(flat, mode):
    doc = {"orders": [order(products=[product(department_id=300),
                                      product(product_id=7, department_id=-1),
                                      product(product_id=8)])]}
    _, items, rejects = flat([doc], mode)
    assert [i["product_id"] for i in items] == [8]
    assert {r["reason"] for r in rejects} == {"department_id out of range"}


def test_e20_load_twice(spark, scratch, flat):
    from cartscope.operators.normalize import flatten
    from cartscope.sinks.tables import load
    from cartscope.sources.payload import read_orders_payload
    from cartscope.operators import validate as V
    import json, os, uuid
    d = os.path.join(scratch, uuid.uuid4().hex)
    os.makedirs(d)
    with open(os.path.join(d, "p.json"), "w") as f:
        json.dump({"orders": [order(order_id=1, products=[product()]), order(order_id=2)]}, f)
    fl = flatten(read_orders_payload(spark, d, multi_line=True, mode="lenient"), "lenient")
    snap, app = os.path.join(scratch, uuid.uuid4().hex), os.path.join(scratch, uuid.uuid4().hex)
    for _ in range(2):
        load(fl.orders, fl.items, snap, mode="overwrite")
        load(fl.orders, fl.items, app, mode="append")
    assert spark.read.parquet(f"{snap}/orders").count() == 2
    assert spark.read.parquet(f"{app}/orders").count() == 4
    expected = V.count_table(spark, [("orders", fl.orders), ("order_items", fl.items)])
    loaded = V.count_table(spark, [(t, spark.read.parquet(f"{app}/{t}"))
                                   for t in ("orders", "order_items")])
    assert all(r.ok for r in V.validate_counts(expected, loaded).collect())


def _items(spark, rows):
    from cartscope.schema import ORDER_ITEMS_SCHEMA
    return spark.createDataFrame(rows, ORDER_ITEMS_SCHEMA)


def test_e21_tie_heavy_reorder_rates(spark):
    from cartscope.plans.metrics import viz_top_reorder_rate
    rows = []
    for p, name in enumerate(["d", "b", "a", "c"]):
        for k in range(3):
            rows.append((k, 1, p, name, 1, "x", 1, "dept", 1, 1))
    got = [r.product for r in viz_top_reorder_rate(None, _items(spark, rows)).collect()]
    assert got == ["a", "b", "c", "d"]


def test_e22_half_even_rate(spark):
    from cartscope.plans.metrics import viz_dept_reorder_rate
    rows = [(i, 1, i, "p", 1, "x", 1, "dept", 1, 1 if i == 0 else 0) for i in range(16)]
    assert viz_dept_reorder_rate(None, _items(spark, rows)).first().reorder_rate_pct == 6.2


def test_e23_fractional_gaps_repeat_labels(spark):
    from cartscope.plans.metrics import viz_gap_days_hist
    from cartscope.schema import ORDERS_SCHEMA
    rows = [(1, 1, 1, 0, "Sunday", 9, 7.2, "prior", 0, 0),
            (2, 1, 2, 0, "Sunday", 9, 6.9, "prior", 0, 0)]
    got = [tuple(r) for r in viz_gap_days_hist(spark.createDataFrame(rows, ORDERS_SCHEMA)).collect()]
    assert got == [(7.0, 1), (7.0, 1)]


def test_e24_empty_tables(spark):
    from cartscope.operators import validate as V
    from cartscope.plans.metrics import overview
    from cartscope.schema import ORDER_ITEMS_SCHEMA, ORDERS_SCHEMA
    o = spark.createDataFrame([], ORDERS_SCHEMA)
    i = spark.createDataFrame([], ORDER_ITEMS_SCHEMA)
    r = overview(o).first()
    assert r.total_orders == 0 and r.avg_items_per_order is None
    counts = V.count_table(spark, [("orders", o), ("order_items", i)])
    assert not any(x.ok for x in V.validate_nonempty(counts).collect())
    assert all(x.ok for x in V.validate_counts(counts, counts).collect())


def test_non_object_order_rejected(flat):
    orders, _, rejects = flat([{"orders": [5, order(order_id=3)]}], "lenient")
    assert [o["order_id"] for o in orders] == [3]
    assert rejects[0]["reason"] == "order not an object"


@pytest.mark.parametrize("mode", ["lenient", "raw"])
def test_non_object_product_rejected(flat, mode):
    docs = [{"orders": [order(order_id=1, products=[7, product()]), order(order_id=2)]}]
    orders, items, rejects = flat(docs, mode)
    assert [o["order_id"] for o in orders] == [2] and items == []
    assert [(r["stage"], r["order_id"], r["reason"]) for r in rejects] == [
        ("order", 1, "product not an object")]
