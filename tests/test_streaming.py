"""Incremental ingest processes each landed file exactly once."""

import json
import os
import uuid


def _write(d, name, docs):
    with open(os.path.join(d, name), "w") as f:
        for doc in docs:
            f.write(json.dumps(doc) + "\n")


def _order(i, n_products=1):
    return {"order_id": i, "user_id": i % 3, "order_number": 1, "order_dow": i % 7,
            "order_hour_of_day": 9, "products": [
                {"product_id": 100 + k, "product_name": f"p{k}", "reordered": k % 2}
                for k in range(n_products)]}


def test_available_now_is_incremental(spark, scratch):
    from cartscope.streaming import start_ingest
    land = os.path.join(scratch, uuid.uuid4().hex)
    wh = os.path.join(scratch, uuid.uuid4().hex)
    ckpt = os.path.join(scratch, uuid.uuid4().hex)
    os.makedirs(land)
    _write(land, "a.jsonl", [{"orders": [_order(1, 2), _order(2)]}])
    _write(land, "b.jsonl", [[_order(3)]])
    with open(os.path.join(land, "b.jsonl"), "a") as f:
        f.write("not json at all\n")
    start_ingest(spark, land, wh, checkpoint=ckpt).awaitTermination()
    assert spark.read.parquet(f"{wh}/orders").count() == 3
    assert spark.read.parquet(f"{wh}/order_items").count() == 4

    # rerun without new files: nothing is added
    start_ingest(spark, land, wh, checkpoint=ckpt).awaitTermination()
    assert spark.read.parquet(f"{wh}/orders").count() == 3

    # a newly landed file is picked up alone
    _write(land, "c.jsonl", [{"orders": [_order(4, 3)]}])
    start_ingest(spark, land, wh, checkpoint=ckpt).awaitTermination()
    orders = spark.read.parquet(f"{wh}/orders")
    assert sorted(r.order_id for r in orders.collect()) == [1, 2, 3, 4]
    assert spark.read.parquet(f"{wh}/order_items").count() == 7
    rej = spark.read.parquet(f"{wh}/_rejects").collect()
    assert [(r.stage, r.reason) for r in rej] == [("document", "not JSON or beyond the size limit")]
