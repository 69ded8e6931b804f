"""What can't be read is rejected or fails the run; nothing is lost in silence."""

import json
import os
import subprocess
import sys
import textwrap

import pytest

from cartscope.operators.normalize import flatten
from cartscope.plans.metrics import viz_heatmap_pivot
from cartscope.plans.runner import run_etl
from cartscope.sinks.files import land_raw
from cartscope.sources.payload import document_rejects, read_documents, read_orders_payload


def _order(i, **more):
    return {"order_id": i, "user_id": 7, "order_number": 1, "order_dow": 1, "order_hour_of_day": 9,
            "eval_set": "prior", "products": [], **more}


def _lines(scratch, name, lines):
    d = os.path.join(scratch, name)
    os.makedirs(d)
    with open(os.path.join(d, "part.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return d


BAD = ['{"orders": [{"order_id": 1', "not json", '{"orders": {"a": 1}}',
       '{"orders": "zzz", "total_orders": 50}', "42"]


def test_bad_documents_are_rejects(spark, scratch):
    path = _lines(scratch, "bad-docs", BAD + [json.dumps({"orders": [_order(1)]}), json.dumps([_order(2)])])
    rejects = document_rejects(read_documents(spark, path)).collect()
    assert len(rejects) == len(BAD) and {r["stage"] for r in rejects} == {"document"}
    assert sorted(r["reason"] for r in rejects) == sorted(
        2 * ["not JSON or beyond the size limit"] + 2 * ["orders is not a list"] + ["not an object or list"])


def test_run_fails_before_loading_unless_told_to_go_on(spark, scratch):
    path = _lines(scratch, "bad-run", BAD + [json.dumps({"orders": [_order(1)]})])
    target = os.path.join(scratch, "bad-warehouse")
    with pytest.raises(ValueError, match="5 unreadable documents"):
        run_etl(spark, path, target)
    assert not os.path.exists(os.path.join(target, "orders"))
    got = run_etl(spark, path, target, fail_on_bad_documents=False)
    assert spark.read.parquet(f"{target}/orders").count() == 1
    assert spark.read.parquet(got.rejects).count() == 5
    assert got.summary.first()["unreadable_documents"] == 5


def test_one_order_per_line(spark, scratch):
    path = _lines(scratch, "single", [json.dumps(_order(i)) for i in range(5)])
    flat = flatten(read_orders_payload(spark, path, mode="lenient"))
    assert sorted(r["order_id"] for r in flat.orders.collect()) == list(range(5))


def test_append_keeps_earlier_rejects(spark, scratch):
    target = os.path.join(scratch, "append-rejects")
    for k in (1, 2):
        path = _lines(scratch, f"append-{k}", [json.dumps({"orders": [_order(k), _order(9, products=None)]})])
        got = run_etl(spark, path, target, load_mode="append")
    assert spark.read.parquet(got.rejects).count() == 2


def test_whole_files_land_unchanged(spark, scratch):
    d = os.path.join(scratch, "pretty")
    os.makedirs(d)
    bodies = [json.dumps({"orders": [_order(i)]}, indent=2).replace("\n", "\r\n").encode() for i in range(24)]
    for i, b in enumerate(bodies):
        with open(os.path.join(d, f"{i}.json"), "wb") as f:
            f.write(b)
    dest = land_raw(spark, d, os.path.join(scratch, "pretty-landed"), whole_files=True)
    assert sorted(bytes(r["content"]) for r in spark.read.parquet(dest).collect()) == sorted(bodies)
    docs = read_documents(spark, dest, landed=True)
    assert docs.count() == 24 and document_rejects(docs).count() == 0


def test_pivot_counts_other_hours(spark):
    orders = spark.createDataFrame([(1, "Mon", 3), (1, "Mon", 30), (1, "Mon", None)],
                                   "order_dow int, order_dow_name string, order_hour_of_day int")
    row = viz_heatmap_pivot(orders).first()
    assert row["h03"] == 1 and row["h_other"] == 2


def test_restarted_stream_does_not_load_twice(scratch):
    landing, target, work = (os.path.join(scratch, x) for x in ("s-in", "s-out", "s-work"))
    os.makedirs(landing)
    code = textwrap.dedent("""
        import sys
        from cartscope.session import get_spark
        from cartscope.streaming.ingest import start_ingest
        s = get_spark("local[2]", shuffle_partitions=2, extra={"spark.checkpoint.dir": sys.argv[3]})
        start_ingest(s, sys.argv[1], sys.argv[2]).awaitTermination()
        print("IDS", sorted(r[0] for r in s.read.parquet(sys.argv[2] + "/orders").select("order_id").collect()))
    """)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for k, seed in ((1, "1"), (2, "2")):
        with open(os.path.join(landing, f"{k}.json"), "w") as f:
            f.write(json.dumps({"orders": [_order(k)]}) + "\n")
        out = subprocess.run([sys.executable, "-c", code, landing, target, work], capture_output=True, text=True,
                             timeout=300, env={**os.environ, "PYTHONPATH": root, "PYTHONHASHSEED": seed})
    assert "IDS [1, 2]" in out.stdout, out.stderr[-2000:]
