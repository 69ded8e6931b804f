"""The payload landing: dealt once, written compressed, nothing lost on odd rows."""

import json
import re

from cartscope import session
from cartscope.schema import ORDER_ITEMS_SCHEMA, ORDERS_SCHEMA
from cartscope.session import scratch_path
from cartscope.sources import payload_fixture as fixture
from pyspark.sql import types as T


def _nullable(schema):
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _order(oid, number=1, days=None, eval_set="prior"):
    return (oid, 7, number, 2, "Tuesday", 5, days, eval_set, 1, 0)


def _item(oid, name="pen", reordered=0):
    return (oid, 7, 11, name, 3, "Brand#3", 2, "LARGE", 1, reordered)


def _tables(spark, orders, items):
    return (spark.createDataFrame(orders, _nullable(ORDERS_SCHEMA)),
            spark.createDataFrame(items, _nullable(ORDER_ITEMS_SCHEMA)))


def _nested(spark, orders, items):
    rows = fixture.nested_orders(*_tables(spark, orders, items)).collect()
    return sorted((json.loads(r["order_json"]) for r in rows), key=lambda o: (o["order_id"] is None, o["order_id"],
                                                                             o["order_number"] or 0))


def test_documents_are_dealt_once(spark):
    docs = fixture.payload_documents(*_tables(spark, [_order(1)], [_item(1)]))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert "parse_json" not in plan and "Join" not in plan


def test_landing_is_compressed_and_keeps_every_document(spark):
    path = scratch_path(spark, "landing-test")
    fixture.land(fixture.payload_documents(*_tables(spark, [_order(1), _order(2001)], [_item(1)])), path)
    files = {r["f"] for r in spark.read.text(path).selectExpr("_metadata.file_name AS f").collect()}
    assert files and all(f.endswith(".gz") for f in files)
    assert spark.read.text(path).count() == 2


def test_rows_sharing_an_order_id_are_orders_each_with_all_items(spark):
    got = _nested(spark, [_order(4, 1), _order(4, 2)], [_item(4, "pen"), _item(4, "cup")])
    assert [o["order_number"] for o in got] == [1, 2]
    assert all(sorted(p["product_name"] for p in o["products"]) == ["cup", "pen"] for o in got)


def test_null_ids_and_items_without_an_order(spark):
    got = _nested(spark, [_order(None), _order(3), _order(6)], [_item(None), _item(99)])
    assert [o["order_id"] for o in got] == [3, 6, None]
    assert "products" not in got[0] and got[1]["products"] == [] and got[2]["products"] == []


def test_dirty_values_and_nulls_stay_in_the_text(spark):
    got = {o["order_id"]: o for o in _nested(
        spark, [_order(73, days=4.0), _order(89), _order(67), _order(61), _order(79), _order(97, days=2.0),
                _order(83), _order(71), _order(1, days=None, eval_set='a"b')],
        [_item(83), _item(71, 'x "y"\n', 1), _item(1, None)])}
    assert got[73]["days_since_prior_order"] == "4.0" and got[97]["days_since_prior_order"] == "abc"
    assert got[89]["order_number"] == "1" and got[67]["order_hour_of_day"] == 5.5 and got[61]["order_dow"] == 9
    assert "eval_set" not in got[79] and got[1]["eval_set"] == 'a"b'
    assert got[83]["products"][0]["product_name"] == "\t pen \n"
    assert got[71]["products"][0]["reordered"] == "1" and got[71]["products"][0]["product_name"] == 'x "y"\n'
    assert got[1]["products"][0]["product_name"] is None and got[1]["days_since_prior_order"] is None
    assert list(got[1]["products"][0]) == ["product_id", "product_name", "aisle_id", "aisle", "department_id",
                                           "department", "add_to_cart_order", "reordered"]


def test_documents_are_dealt_into_tasks_that_fit_memory(spark, monkeypatch):
    mb = 1 << 20
    monkeypatch.setattr(fixture, "ensure_warehouse", lambda *_: "any")
    monkeypatch.setattr(session, "input_bytes", lambda *_: 700 * mb)
    parts = fixture.deal_count(spark, "any")
    # 50 bytes of memory a compressed byte, in tasks of at most 200 MB
    assert 700 * mb / parts * 50 <= 200 * mb
    tables = _tables(spark, [_order(1), _order(2001)], [_item(1), _item(2001)])
    docs = fixture.payload_documents(*tables, parts=parts)
    docs.collect()
    assert f"hashpartitioning(doc_id, {parts})" in re.sub(
        r"#\d+L?", "", docs._jdf.queryExecution().executedPlan().toString())
    assert sorted(r["value"] for r in docs.collect()) == sorted(
        r["value"] for r in fixture.payload_documents(*tables).collect())


def test_a_sorted_file_leaves_memory_for_the_other_tasks(spark, monkeypatch):
    gb = 1 << 30
    monkeypatch.setattr(session, "input_bytes", lambda *_: 3 * gb)
    assert 3 * gb / session.file_count(spark, ["any"]) * 36 <= 0.4 * gb
