import json
import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cartscope.session import get_spark
    s = get_spark("local[4]", app="cartscope-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def scratch():
    """A fresh folder for this test run (never cleared)."""
    return tempfile.mkdtemp(prefix="cartscope-pytest-")


@pytest.fixture()
def write_docs(scratch):
    """Write payload documents (Python objects) one per file; return the folder."""
    def _write(docs, raw_text=None):
        d = os.path.join(scratch, uuid.uuid4().hex)
        os.makedirs(d)
        texts = raw_text if raw_text is not None else [json.dumps(x, indent=2) for x in docs]
        for i, t in enumerate(texts):
            with open(os.path.join(d, f"doc{i:03d}.json"), "w", encoding="utf-8") as f:
                f.write(t)
        return d
    return _write


@pytest.fixture()
def flat(spark, write_docs):
    """Flatten documents in one mode -> (orders rows, items rows, rejects rows)."""
    from cartscope.operators.normalize import flatten
    from cartscope.sources.payload import read_orders_payload

    def _flat(docs, mode="lenient", raw_text=None):
        path = write_docs(docs, raw_text)
        f = flatten(read_orders_payload(spark, path, multi_line=True, mode=mode), mode)
        return ([r.asDict() for r in f.orders.collect()],
                [r.asDict() for r in f.items.collect()],
                [r.asDict() for r in f.rejects.collect()])
    return _flat
