"""Substring deduplication over fixed-length word windows.

Method: a Rabin-Karp hash of every window of ``size`` words; windows are
grouped by hash across the corpus to find the smallest document each starts
in; every later document removes the words its repeated windows cover, merged
into maximal intervals.

How it is spread. Documents are dealt into groups of some megabytes by a hash
of their id, text and partition. A group sends each *distinct* window hash once, with its smallest
document: a passage that a third of all documents share costs a group one
entry, not one per document. Hash buckets find the smallest document of the
corpus and answer a group only for hashes that an earlier document of another
group has; repeats inside a group are settled there. The number of groups and
of buckets follows the input size, so what one task holds does not grow.

A window is identified by its bucket and 56 bits of its hash: for N windows
about N^2 / (buckets * 2^57) false repeats are expected (0.003 for 10^8).

Defined results: a null or empty text has no words; a text shorter than a
window keeps all words; rows with one doc_id are equal in rank and do not
remove each other's words; a row with a null doc_id neither removes nor loses
words; windows are judged on the input; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartscope.llm.common import (as_binary, groups_for, id_and_text, read_documents,
                                  ship_package, split_words, text_bytes, text_chunks, window_hashes)

WINDOW = 13
GROUP_BYTES = 8 << 20
#: Text bytes whose windows share a hash bucket (about 2 million windows).
BUCKET_BYTES = 12 << 20
_PAYLOAD = (1 << 56) - 1

RESULT = "doc_id long, text string, n_words long, removed array<struct<start:int,stop:int>>"


def _pack(values: np.ndarray) -> bytes:
    """The low seven bytes of each value."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 7, 8), dtype=np.uint8)
    out[:, :7] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 7)
    return out.reshape(-1).view("<u8")


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    # by other bits than the payload's order: a second mixing of the hash
    spread = (hashes * np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)
    return ((spread * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _windows(table: pa.Table, size: int):
    """Chunks of a group: (first row, words, window hashes, first words, row of each window)."""
    for i, j, data, off in text_chunks(table.column("text")):
        words = split_words(data, off, fold_case=False)
        hashes, at = window_hashes(words, size)
        rows = np.searchsorted(words.doc, at, side="right") - 1 + i
        yield i, words, hashes, at, rows


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    col = table.column("doc_id")
    return (col.fill_null(0).to_numpy().astype(np.int64),
            ~np.asarray(pc.is_null(col).to_numpy(zero_copy_only=False), dtype=bool))


def _least(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and the smallest document of each."""
    order = np.argsort(hashes, kind="stable")
    h, d = hashes[order], docs[order]
    head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
    return h[head], np.minimum.reduceat(d, head) if len(head) else d[:0]


def _group_least(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    ids, known = _ids(table)
    hs, ds = [], []
    for _, _, hashes, _, rows in _windows(table, size):
        keep = known[rows]
        h, d = _least(hashes[keep], ids[rows[keep]])
        hs.append(h)
        ds.append(d)
    if not hs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return _least(np.concatenate(hs), np.concatenate(ds))


def _sender(size: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        h, d = _group_least(table, size)
        b = _bucket(h, buckets)
        order = np.lexsort((d, b))
        h, d, b = h[order], d[order], b[order]
        cuts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else []
        ends = [*cuts[1:], len(b)] if len(b) else []
        out = {"bucket": [], "docs": [], "counts": [], "hashes": []}
        for s, e in zip(cuts, ends):
            docs, counts = np.unique(d[s:e], return_counts=True)
            out["bucket"].append(int(b[s]))
            out["docs"].append(np.diff(docs, prepend=docs.dtype.type(0)).astype("<i8").tobytes())
            out["counts"].append(counts.astype("<u4").tobytes())
            out["hashes"].append(_pack(h[s:e]))
        gid = table.column("gid")[0].as_py()
        return pa.table({"bucket": pa.array(out["bucket"], pa.int64()),
                         "gid": pa.array([gid] * len(out["bucket"]), pa.int64()),
                         "docs": as_binary(out["docs"]), "counts": as_binary(out["counts"]),
                         "hashes": as_binary(out["hashes"])})
    return send


def _answer(table: pa.Table) -> pa.Table:
    """For one bucket: the hashes each group must remove everywhere, because a
    document of another group with a smaller id has them."""
    hs, ds, gs = [], [], []
    for gid, docs, counts, raw in zip(*(table.column(c).to_pylist()
                                        for c in ("gid", "docs", "counts", "hashes"))):
        hs.append(_unpack(raw))
        ds.append(np.repeat(np.cumsum(np.frombuffer(docs, "<i8")), np.frombuffer(counts, "<u4")))
        gs.append(np.full(len(hs[-1]), gid, dtype=np.int64))
    h, d, g = np.concatenate(hs), np.concatenate(ds), np.concatenate(gs)
    order = np.argsort(h, kind="stable")
    h, d, g = h[order], d[order], g[order]
    head = np.concatenate([[True], h[1:] != h[:-1]])
    cuts = np.flatnonzero(head)
    least = np.minimum.reduceat(d, cuts)[np.cumsum(head) - 1]
    later = d > least
    h, g = h[later], g[later]
    order = np.argsort(g, kind="stable")
    h, g = h[order], g[order]
    gids, first = np.unique(g, return_index=True)
    ends = [*first[1:], len(g)]
    bucket = table.column("bucket")[0].as_py()
    return pa.table({"gid": pa.array(gids.astype(np.int64)),
                     "bucket": pa.array([bucket] * len(gids), pa.int64()),
                     "hashes": as_binary([_pack(h[s:e]) for s, e in zip(first, ends)])})


def _merge(at: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal intervals covered by windows starting at the sorted words ``at``."""
    breaks = np.flatnonzero(np.diff(at) > size)
    starts = at[np.concatenate([[0], breaks + 1])]
    stops = at[np.concatenate([breaks, [len(at) - 1]])] + size
    return list(zip(starts.tolist(), stops.tolist()))


def _remover(size: int, buckets: int):
    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, known = _ids(left)
        foreign = [(_unpack(raw), b) for b, raw in zip(right.column("bucket").to_pylist(),
                                                       right.column("hashes").to_pylist())]
        h_far = np.concatenate([x for x, _ in foreign]) if foreign else np.zeros(0, np.uint64)
        b_far = (np.concatenate([np.full(len(x), b, np.int64) for x, b in foreign])
                 if foreign else np.zeros(0, np.int64))
        h_near, d_near = _group_least(left, size)
        # every window here is one of h_near: mark those answered from elsewhere
        order = np.lexsort((h_near & np.uint64(_PAYLOAD), _bucket(h_near, buckets)))
        far = np.zeros(len(h_near), dtype=bool)
        key_b = _bucket(h_near, buckets)[order]
        key_h = (h_near & np.uint64(_PAYLOAD))[order]
        for b in np.unique(b_far):
            lo, hi = np.searchsorted(key_b, b), np.searchsorted(key_b, b, side="right")
            want = np.sort(h_far[b_far == b])
            pos = np.searchsorted(want, key_h[lo:hi])
            pos[pos == len(want)] = 0
            far[order[lo:hi]] = want[pos] == key_h[lo:hi]
        out = {"doc_id": [], "text": [], "n_words": [], "removed": []}
        for i, words, hashes, at, rows in _windows(left, size):
            k = np.searchsorted(h_near, hashes)
            k[k == len(h_near)] = 0
            gone = (known[rows] & (far[k] | (ids[rows] > d_near[k])) if len(h_near)
                    else np.zeros(len(rows), bool))
            at, rows = at[gone], rows[gone]
            blob = words.data.tobytes()
            cuts = np.searchsorted(rows, np.arange(i, i + words.n_docs() + 1))
            for r in range(words.n_docs()):
                w0, w1 = int(words.doc[r]), int(words.doc[r + 1])
                mine = at[cuts[r]:cuts[r + 1]] - w0
                spans = _merge(mine, size) if len(mine) else []
                kept = np.ones(w1 - w0, dtype=bool)
                for s, e in spans:
                    kept[s:e] = False
                k_at = np.flatnonzero(kept) + w0
                out["doc_id"].append(int(ids[i + r]) if known[i + r] else None)
                out["text"].append(b" ".join([blob[s:e] for s, e in zip(
                    words.starts[k_at].tolist(), words.ends[k_at].tolist())]).decode("utf-8"))
                out["n_words"].append(w1 - w0)
                out["removed"].append([{"start": s, "stop": e} for s, e in spans])
        return pa.table({
            "doc_id": pa.array(out["doc_id"], pa.int64()), "text": pa.array(out["text"], pa.string()),
            "n_words": pa.array(out["n_words"], pa.int64()),
            "removed": pa.array(out["removed"], pa.list_(pa.struct(
                [("start", pa.int32()), ("stop", pa.int32())])))})
    return remove


def remove_repeats(docs: DataFrame, size: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", group_bytes: int = GROUP_BYTES,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: ``doc_id``, ``text`` (kept words joined by one
    space), ``n_words``, ``removed`` (maximal word intervals, end exclusive)."""
    ship_package(docs.sparkSession)
    base = id_and_text(docs, id_col, text_col)
    total = text_bytes(base)
    groups, buckets = groups_for(total, group_bytes), groups_for(total, bucket_bytes)
    # not by the id alone: a third of the rows may share one, or have none
    dealt = base.withColumn("gid", F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(groups)))
    sent = dealt.groupBy("gid").applyInArrow(
        _sender(size, buckets), "bucket long, gid long, docs binary, counts binary, hashes binary")
    answers = sent.groupBy("bucket").applyInArrow(_answer, "gid long, bucket long, hashes binary")
    return (dealt.groupBy("gid").cogroup(answers.groupBy("gid"))
            .applyInArrow(_remover(size, buckets), RESULT))


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_documents(spark, sf_dir))
    removed = F.aggregate("removed", F.lit(0).cast("long"),
                          lambda a, s: a + (s["stop"] - s["start"]).cast("long"))
    return out.select("doc_id", "n_words", removed.alias("n_removed"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, len(w) AS n FROM docs),
windows AS (
  SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS win, n
  FROM words),
least AS (
  SELECT *, min(doc_id) OVER (PARTITION BY win) AS first_doc FROM windows WHERE i + 12 <= n),
hit AS (SELECT doc_id, i FROM least WHERE doc_id > first_doc),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hit, range(13) AS r(k)),
kept AS (
  SELECT words.doc_id, words.i, words.word, gone.i IS NOT NULL AS removed
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i),
per AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT removed), '') AS kept
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN per USING (doc_id)
"""
