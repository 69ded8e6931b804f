"""Batches between Spark and Python in the pipeline: bounded in bytes, not by rows alone."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartscope.llm.common import BATCH_BYTES

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
ROWS = 3000
WORDS = "the old bridge near our village was built from grey stone by three brothers "


@pytest.fixture
def tables(spark, tmp_path):
    """A session of its own, 6 MB of documents in one partition, and a benchmark."""
    own = spark.newSession()
    item = "seven quick ravens crossed the frozen river before dawn while twelve lanterns burned"
    own.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = own.range(ROWS, numPartitions=1).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit(WORDS * 27), F.col("id"), F.when(F.col("id") == 7, F.lit(f" {item}")).otherwise("")).alias("text"))
    return own, docs, str(tmp_path)


def _sent(docs):
    """Rows and bytes of each batch that Python gets."""
    def sizes(batches):  # nested: the workers can't import this file
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(batch)], pa.int64()), pa.array([batch.nbytes], pa.int64())], names=["n", "b"])
    return [(r["n"], r["b"]) for r in docs.mapInArrow(sizes, "n long, b long").collect()]


@pytest.mark.parametrize("name", ["language_id", "near_dedup", "decontamination", "packing"])
def test_a_stage_bounds_its_batches(tables, name, monkeypatch):
    own, docs, folder = tables
    seen = []
    for module, call in (("language_id", "keep_identified"), ("near_dedup", "keep_one"),
                         ("decontaminate", "clean_documents"), ("packing", "pack")):
        monkeypatch.setattr(getattr(corpus_pipeline, module), call, lambda d, *a, **k: seen.append(_sent(d)) or d)
    dict(corpus_pipeline.STAGES)[name](own, docs, folder)
    sent, = seen
    assert sum(n for n, _ in sent) == ROWS
    # one row may go beyond the bound
    assert max(b for _, b in sent) < BATCH_BYTES + 4000


def test_rows_do_not_depend_on_the_batches(tables):
    own, docs, folder = tables
    step = dict(corpus_pipeline.STAGES)["decontamination"]
    got = [r["doc_id"] for r in step(own, docs, folder).select("doc_id").collect()]
    assert sorted(got) == [k for k in range(ROWS) if k != 7]


def test_a_size_given_to_the_session_stays(tables):
    own, docs, folder = tables
    own.conf.set(KEY, "5m")
    dict(corpus_pipeline.STAGES)["decontamination"](own, docs, folder)
    assert own.conf.get(KEY) == "5m"
