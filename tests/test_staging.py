"""Staging without copies of documents, and merges that write the tables once a delivery."""

import json

import pytest
from pyspark.sql import functions as F

from cartscope.functions import clean_field, clean_text
from cartscope.operators.normalize import flatten
from cartscope.plans import loads
from cartscope.plans.staging import stage_landing
from cartscope.schema import ORDER_ITEMS_SCHEMA, ORDERS_SCHEMA
from cartscope.session import scratch_path
from cartscope.sinks import versions
from cartscope.sources import payload as P
from cartscope.sources import payload_fixture as fixture
from cartscope.streaming import start_merge_ingest


def _item(p, **other):
    return {"product_id": p, "product_name": "pen", "aisle_id": 3, "aisle": "a", "department_id": 2,
            "department": "d", "add_to_cart_order": 1, "reordered": p % 2, **other}


def _order(oid, hour=5, products=2, **other):
    return {"order_id": oid, "user_id": 7, "order_number": 1, "order_dow": 2, "order_hour_of_day": hour,
            "days_since_prior_order": None, "eval_set": "prior", "products": [_item(p) for p in range(products)],
            **other}


def _without(order, key):
    return {k: v for k, v in order.items() if k != key}


ODD = [
    {"orders": [_order(1), _order(2, products=0), _without(_order(3), "products")], "total_orders": 4},
    {"orders": [_order(4), {**_order(5), "products": None},
                {**_order(6), "products": "x"}, {**_order(7), "products": [_item(1), 5]}, 9, None, [1]]},
    [_order(8), _order(-1), _without(_order(10), "order_id")],
    {"orders": [{**_order(11), "products": [_item(1), _item(70000, aisle_id=70000), _item(2, product_name=" \t　x ")]},
                {**_order(12), "order_number": "12", "order_hour_of_day": 1.7, "user_id": "1.7"}]},
    {"orders": "none"}, {"orders": None}, {"total_orders": 2}, "text", 5, None, [], _order(13),
]


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("mode", ["lenient", "raw"])
def test_staged_outputs_equal_the_flatten(spark, write_docs, mode):
    path = write_docs(ODD)
    staged = stage_landing(spark, path, mode, multi_line=True)
    flat = flatten(P.read_orders_payload(spark, path, multi_line=True, mode=mode), mode)
    assert _sorted(staged.orders()) == _sorted(flat.orders)
    assert _sorted(staged.items()) == _sorted(flat.items)
    columns = ["mode", "stage", "reason", "record"]
    of_orders = staged.rejects().filter("stage != 'document'").select(*columns)
    assert _sorted(of_orders) == _sorted(flat.rejects.select(*columns)) and of_orders.count() > 4
    assert staged.rejects().filter("stage = 'document'").count() == 5
    seen = staged.seen
    assert seen["items_found"] == seen["items_accepted"] + seen["items_rejected"]
    assert seen["parsed"] == seen["written"] != 0


def test_documents_are_probed_without_copies(spark):
    text = str(P.document_problem(F.col("doc")))
    assert "array<variant>" not in text and "map<string,variant>" not in text


def test_lenient_items_are_not_built_item_by_item(spark, write_docs):
    staged = stage_landing(spark, write_docs([{"orders": [_order(1)]}]), multi_line=True)
    assert "reason" not in staged.rows.schema["items"].dataType.elementType.names
    assert "lambda" not in staged.items()._jdf.queryExecution().optimizedPlan().toString()


def test_clean_field_equals_clean_text(spark):
    texts = ["", " ", "a", " a", "a ", "a b", "\t a\n", "\u0085x", "x　", "é", "aé", "\x1fa", "!", "~",
             "\x7f", "\u0080", "a ", " ", "\U0001f600", "\x1c", "a\x1c b ", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", clean_field("t").alias("f"), clean_text("t")
                                                                         .alias("c")).collect()
    assert [r["f"] for r in got] == [r["c"] for r in got]
    assert {r["f"] for r in got if r["t"]} == {t.strip() for t in texts if t}


def test_texts_of_items_are_made_before_they_are_collected(spark):
    docs = fixture.payload_documents(spark.createDataFrame([], ORDERS_SCHEMA), spark.createDataFrame([], ORDER_ITEMS_SCHEMA))
    assert "lambda" not in docs._jdf.queryExecution().analyzed().toString()


def _tables(spark, dest):
    orders = versions.read_table(spark, dest, "orders").select("order_id", "order_hour_of_day").collect()
    return sorted(map(tuple, orders)), versions.read_table(spark, dest, "order_items").count()


def test_a_delivery_without_repeated_ids_is_not_brought_together(spark, write_docs, monkeypatch):
    calls, found = [], loads.latest_deliveries
    monkeypatch.setattr(loads, "latest_deliveries", lambda s: calls.append(1) or found(s))
    dest = scratch_path(spark, "staging-test")
    for docs, grouped in (([{"orders": [_order(1), _order(2)]}], 0), ([{"orders": [_order(2, 9, 1), _order(3)]}], 0),
                          ([{"orders": [_order(3, 8), _order(1), _order(3, 10, 1)]}], 1)):
        done = loads.merge_version(spark, stage_landing(spark, write_docs(docs), multi_line=True), dest)
        assert len(calls) == grouped and all(r["ok"] for r in done.ledger.collect())
    assert _tables(spark, dest) == ([(1, 5), (2, 9), (3, 10)], 2 + 1 + 1)


def test_a_delivery_of_many_files_is_one_version(spark, write_docs):
    landing = write_docs([], raw_text=[json.dumps({"orders": [_order(i, products=1)]}) for i in range(1, 1003)])
    dest = scratch_path(spark, "staging-test")
    start_merge_ingest(spark, landing, dest, checkpoint=scratch_path(spark, "staging-test")).awaitTermination()
    assert versions.latest(spark, dest).number == 1
    assert len(_tables(spark, dest)[0]) == _tables(spark, dest)[1] == 1002
