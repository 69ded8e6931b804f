"""Sizes of what is written between the steps: sorts in memory, files compressed, one pass."""

import os

from cartscope import session
from cartscope.operators.normalize import flatten
from cartscope.plans import loads
from cartscope.plans.staging import read_deliveries, stage_landing
from cartscope.session import scratch_path
from cartscope.sinks import files as sink_files
from cartscope.sinks import versions
from cartscope.sources import payload as P
from cartscope.sources.warehouse import write_sorted


def _order(oid, hour=5, products=2):
    return {"order_id": oid, "user_id": 7, "order_number": 1, "order_dow": 2, "order_hour_of_day": hour,
            "days_since_prior_order": None, "eval_set": "prior",
            "products": [{"product_id": p, "product_name": "pen", "aisle_id": 3, "aisle": "a", "department_id": 2,
                          "department": "d", "add_to_cart_order": p, "reordered": p % 2} for p in range(products)]}


def _names(path, suffix):
    return [f for _, _, fs in os.walk(path) for f in fs if f.startswith("part-") and f.endswith(suffix)]


def test_a_sorted_file_fits_a_task_whatever_the_input(spark, monkeypatch):
    gb = 1 << 30
    monkeypatch.setattr(session, "input_bytes", lambda *_: 3 * gb)
    # 36 bytes or fewer of memory a compressed byte, in tasks of at most 1.2 GB
    assert 3 * gb / session.file_count(spark, ["any"]) * 36 <= 1.2 * gb


def test_sorted_tables_and_staged_rows_are_written_as_zstd(spark, write_docs):
    path = scratch_path(spark, "sizes")
    write_sorted(spark.range(100), path, ["id"], 4)
    assert _names(path, ".zstd.parquet") and not _names(path, ".snappy.parquet")
    staged = stage_landing(spark, write_docs([{"orders": [_order(1)]}]), multi_line=True)
    assert _names(staged.path, ".zstd.parquet") and not _names(staged.path, ".snappy.parquet")


def test_flat_staging_is_compressed_and_reads_back_whole(spark, write_docs):
    flat = flatten(P.read_orders_payload(spark, write_docs([{"orders": [_order(1), _order(2, products=0)]}]),
                                         multi_line=True, mode="lenient"))
    paths = sink_files.write_flat_staging(flat.orders, flat.items, scratch_path(spark, "sizes"))
    for table, want in (("orders", flat.orders), ("order_items", flat.items)):
        assert _names(paths[table], ".json.gz") and not _names(paths[table], ".json")
        got = P.read_flat_staging(spark, paths[table], table)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_counts_of_odd_documents(spark, write_docs):
    docs = [{"orders": [_order(1), 5, _order(2)], "total_orders": 9}, [_order(3)], {"orders": []}, {"orders": "x"},
            {"total_orders": 2}, _order(4), []]
    seen = stage_landing(spark, write_docs(docs), multi_line=True).seen
    whole = read_deliveries(spark, write_docs(docs), multi_line=True)
    plain = P.payload_summary(whole, with_timestamp=False).first()
    assert (seen["documents"], seen["found"], seen["claimed"]) == (
        plain["documents"], plain["order_count"], plain["total_orders"])
    assert (seen["unreadable"], seen["orders_accepted"], seen["orders_rejected"]) == (1, 4, 1)
    assert (seen["items_found"], seen["items_accepted"], seen["items_rejected"]) == (8, 8, 0)


def test_a_merge_joins_what_it_keeps_with_the_delivery_once(spark, write_docs, monkeypatch):
    dest = scratch_path(spark, "sizes")
    loads.load_version(spark, write_docs([{"orders": [_order(i) for i in range(1, 6)]}]), dest, multi_line=True)
    delivery = stage_landing(spark, write_docs([{"orders": [_order(3, hour=9, products=1)]}]), multi_line=True)
    actions = []
    write = loads.write_sorted
    monkeypatch.setattr(loads, "write_sorted", lambda df, *a, **k: (actions.append(
        df._jdf.queryExecution().optimizedPlan().toString()), write(df, *a, **k))[1])
    done = loads.merge_version(spark, delivery, dest)
    assert len(actions) == 2 and not any("Join" in plan for plan in actions)
    orders = versions.read_table(spark, dest, "orders", done.version)
    items = versions.read_table(spark, dest, "order_items", done.version)
    assert sorted((r["order_id"], r["order_hour_of_day"]) for r in orders.collect()) == [
        (1, 5), (2, 5), (3, 9), (4, 5), (5, 5)]
    assert items.count() == 9 and items.filter("order_id = 3").count() == 1
    assert all(r["ok"] for r in done.ledger.collect())
