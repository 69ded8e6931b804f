"""Alignment of the tokens of two tokenizers by the bytes they cover.

Method. Each text is encoded by a byte-level vocabulary A (of space + text) and
a piece vocabulary B (which adds the space). Offsets where tokens of both end
cut them into groups; every A token of a group is linked with every B token of
it, and a pair of ids counts the documents that hold it linked.

Identity-map fast path: an array gives for each A id the B id with the same
bytes. Groups of exactly one A and that B token, most of all groups, are
counted in a vector as long as A's vocabulary. Only pairs of other groups enter
the pair shuffle. An identity pair that also comes up inside an irregular group
goes to the vector too, so a document counts once.

How it is spread. Tasks tokenize once and write one row for some megabytes of
text (a part): per document the counts, the digest of its groups and the list of
its distinct pairs as places in the part's own pair list. A part sends each of
its distinct irregular pairs once, with the number of its documents, to a hash
bucket; the bucket answers the totals. A pair that all documents hold is one
entry a part. The part's row then meets its answers and sums them up; neither
texts nor tokens are shuffled or tokenized again. What reaches the driver are
vectors as long as A's vocabulary (identity totals, highest total of an A id).
The number of buckets follows the input.

Defined results: null and empty texts, and texts whose joined token bytes are not
space + text (a text with U+2581, say), have no tokens: zeros and an empty digest;
text that spells a special token is plain text; equal rows are documents each,
a null id is a document like any other; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartscope.llm.common import (groups_for, id_and_text, mix, read_documents, ship_package, stage,
                                  text_bytes)
from cartscope.llm.packing import encoder

VOCABULARY_A = "byte_bpe_50k.tiktoken"
VOCABULARY_B = "piece_bpe_32k.model"
#: Text bytes whose documents make one part.
PART_BYTES = 4 << 20
#: Text bytes whose pairs share a hash bucket.
BUCKET_BYTES = 48 << 20
#: Links of one group listed one by one; larger groups list distinct ids.
GROUP_LINKS = 1 << 16

PARTS = ("gid long, doc_ids array<long>, n_a binary, n_b binary, n_groups binary, n_links binary, "
         "digests array<string>, same binary, pairs binary, ident binary, "
         "sends array<struct<bucket:int,pairs:binary,counts:binary>>")
ANSWERS = "gid long, bucket int, totals binary, ids binary"
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


# ------------------------------------------------------------ arrays as bytes

def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueeze(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8").astype(np.int64)


def _deltas(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Ascending runs as differences; a run starts at each of ``heads``."""
    out = np.diff(values, prepend=values[:1])
    out[heads] = values[heads]
    return out


def _undelta(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    sums = np.cumsum(values)
    runs = np.diff(np.append(heads, len(values)))
    return sums - np.repeat(sums[heads] - values[heads], runs)


# --------------------------------------------------------------- vocabularies

@dataclass
class Vocabularies:
    a: object
    b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    len_a: np.ndarray
    len_b: np.ndarray
    #: B id with the bytes of each A id, or -1
    same: np.ndarray


_LOADED: dict[tuple[str, str], Vocabularies] = {}


def piece_bytes(sp) -> list[bytes]:
    out = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i)
                   else b"" if sp.is_control(i)
                   else piece.replace("▁", " ").encode("utf-8"))
    return out


def vocabularies(name_a: str = VOCABULARY_A, name_b: str = VOCABULARY_B) -> Vocabularies:
    """Both tokenizers, loaded once per Python worker."""
    if (name_a, name_b) not in _LOADED:
        import public_tokenizers
        import sentencepiece
        a = encoder(name_a)
        path = name_b if "/" in name_b else public_tokenizers.path(name_b)
        b = sentencepiece.SentencePieceProcessor(model_file=path)
        bytes_a = [a.decode_single_token_bytes(i) for i in range(a.n_vocab)]
        bytes_b = piece_bytes(b)
        of_bytes: dict[bytes, int] = {}
        # a piece rather than a byte token where both have the bytes
        for i in sorted(range(len(bytes_b)), key=lambda k: (b.is_byte(k), k)):
            of_bytes.setdefault(bytes_b[i], i)
        _LOADED[name_a, name_b] = Vocabularies(
            a, b, bytes_a, bytes_b, np.array([len(x) for x in bytes_a], np.int64),
            np.array([len(x) for x in bytes_b], np.int64),
            np.array([of_bytes.get(x, -1) for x in bytes_a], np.int64))
    return _LOADED[name_a, name_b]


# ---------------------------------------------------------------- one part

@dataclass
class Tokens:
    """Token ids of several documents one after another; document ``i`` has the
    ranges ``doc_a[i]:doc_a[i + 1]`` and ``doc_b[i]:doc_b[i + 1]``."""
    a: np.ndarray
    b: np.ndarray
    doc_a: np.ndarray
    doc_b: np.ndarray


def _edges(lists: list[list[int]]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)


def _flat(lists: list[list[int]], total: int) -> np.ndarray:
    return np.fromiter((i for x in lists for i in x), dtype=np.int64, count=total)


def tokenize(texts: list[str | None], v: Vocabularies) -> Tokens:
    texts = [t or "" for t in texts]
    ids_a = [v.a.encode_ordinary(" " + t) if t else [] for t in texts]
    ids_b = v.b.encode(texts, num_threads=1) if texts else []
    for i, t in enumerate(texts):
        whole = (" " + t).encode("utf-8")
        if not t or (b"".join([v.bytes_a[k] for k in ids_a[i]]) != whole
                     or b"".join([v.bytes_b[k] for k in ids_b[i]]) != whole):
            ids_a[i], ids_b[i] = [], []
    doc_a, doc_b = _edges(ids_a), _edges(ids_b)
    return Tokens(_flat(ids_a, int(doc_a[-1])), _flat(ids_b, int(doc_b[-1])), doc_a, doc_b)


@dataclass
class Groups:
    """Group ``g`` has A tokens ``a[g]:a[g + 1]`` and B tokens ``b[g]:b[g + 1]``;
    document ``i`` has groups ``doc[i]:doc[i + 1]``."""
    a: np.ndarray
    b: np.ndarray
    doc: np.ndarray


def cut_groups(t: Tokens, len_a: np.ndarray, len_b: np.ndarray) -> Groups:
    end_a, end_b = np.cumsum(len_a[t.a]), np.cumsum(len_b[t.b])
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    first = np.zeros(1, np.int64)
    a = np.concatenate([first, np.searchsorted(end_a, common) + 1])
    b = np.concatenate([first, np.searchsorted(end_b, common) + 1])
    return Groups(a, b, np.searchsorted(a, t.doc_a))


def group_texts(t: Tokens, g: Groups) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each document, built for all tokens at once."""
    n_a, n_b = len(t.a), len(t.b)
    of_a = np.repeat(np.arange(len(g.a) - 1), np.diff(g.a))
    of_b = np.repeat(np.arange(len(g.b) - 1), np.diff(g.b))
    place_a, place_b = np.arange(n_a) + g.b[of_a], np.arange(n_b) + g.a[of_b + 1]
    ids = np.empty(n_a + n_b, np.int64)
    ids[place_a], ids[place_b] = t.a, t.b
    after = np.full(n_a + n_b, ord(","), np.uint8)
    after[place_a[g.a[1:] - 1]] = ord("|")
    after[place_b[g.b[1:] - 1]] = ord(";")
    width = max(5, len(str(int(ids.max())))) if len(ids) else 5
    digits = np.zeros((len(ids), width + 1), np.uint8)
    length = np.ones(len(ids), np.int64)
    for power in range(1, width):
        length += ids >= 10 ** power
    for k in range(width):  # k-th digit from the left
        has = length > k
        digits[has, k] = ord("0") + (ids[has] // 10 ** (length[has] - 1 - k)) % 10
    digits[np.arange(len(ids)), length] = after
    flat = digits[np.arange(width + 1) <= length[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(length + 1)])
    cuts = ends[t.doc_a + t.doc_b]
    return [flat[s:max(s, e - 1)] for s, e in zip(cuts.tolist(), cuts[1:].tolist())]


def _products(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a large group and how often they are linked."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    return np.repeat(ua, len(ub)), np.tile(ub, len(ua)), np.outer(ca, cb).reshape(-1)


def links(t: Tokens, g: Groups, same: np.ndarray):
    """Distinct links of each document with their number: those of the identity
    map as ``(doc, a, times)``, all others as ``(doc, a, b, times)``."""
    n_a, n_b = np.diff(g.a), np.diff(g.b)
    doc = np.repeat(np.arange(len(g.doc) - 1), np.diff(g.doc))
    single = (n_a == 1) & (n_b == 1)
    one_a, one_b = t.a[g.a[:-1][single]], t.b[g.b[:-1][single]]
    plain = same[one_a] == one_b
    id_doc, id_a = [doc[single][plain]], [one_a[plain]]
    id_n = [np.ones(len(id_a[0]), np.int64)]
    rest = ~single
    rest[np.flatnonzero(single)[~plain]] = True
    large = np.flatnonzero(rest & (n_a * n_b > GROUP_LINKS))
    rest[large] = False
    at = np.flatnonzero(rest)
    size = n_a[at] * n_b[at]
    k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    wide = np.repeat(n_b[at], size)
    docs = [np.repeat(doc[at], size)]
    as_ = [t.a[np.repeat(g.a[at], size) + k // wide]]
    bs = [t.b[np.repeat(g.b[at], size) + k % wide]]
    ns = [np.ones(len(k), np.int64)]
    for i in large:
        a, b, n = _products(t.a[g.a[i]:g.a[i + 1]], t.b[g.b[i]:g.b[i + 1]])
        docs.append(np.full(len(a), doc[i]))
        as_.append(a)
        bs.append(b)
        ns.append(n)
    d, a, b, n = map(np.concatenate, (docs, as_, bs, ns))
    known = same[a] == b
    id_doc.append(d[known])
    id_a.append(a[known])
    id_n.append(n[known])
    d, a, b, n = d[~known], a[~known], b[~known], n[~known]
    size_a, size_b = int(len(same)), 1 << 20

    def merge(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key)
        key, times = key[order], times[order]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
        return key[head], np.add.reduceat(times, head) if len(head) else times
    i_key, i_n = merge(np.concatenate(id_doc) * size_a + np.concatenate(id_a), np.concatenate(id_n))
    p_key, p_n = merge((d * size_a + a) * size_b + b, n)
    pair = p_key % (size_a * size_b)
    return ((i_key // size_a, i_key % size_a, i_n),
            (p_key // (size_a * size_b), pair // size_b, pair % size_b, p_n))


def _bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    spread = mix(pairs.astype(np.uint64)) >> np.uint64(32)
    return ((spread * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sums in whole numbers."""
    sums = np.concatenate([[0], np.cumsum(values)])
    edges = np.searchsorted(doc, np.arange(n + 1))
    return sums[edges[1:]] - sums[edges[:-1]]


def _part_row(gid: int, ids: pa.Array, texts: list[str | None], v: Vocabularies, buckets: int) -> dict:
    t = tokenize(texts, v)
    g = cut_groups(t, v.len_a, v.len_b)
    n = len(texts)
    (i_doc, i_a, i_n), (p_doc, p_a, p_b, p_n) = links(t, g, v.same)
    pair = p_a * len(v.bytes_b) + p_b
    listed, where, docs = np.unique(pair, return_inverse=True, return_counts=True)
    bucket = _bucket(listed, buckets)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    listed, docs, bucket = listed[order], docs[order], bucket[order]
    where = place[where]
    by_place = np.lexsort((where, p_doc))
    where, p_n = where[by_place], p_n[by_place]
    p_count = np.bincount(p_doc, minlength=n)
    i_count = np.bincount(i_doc, minlength=n)

    def heads(counts: np.ndarray) -> np.ndarray:
        return (np.cumsum(counts) - counts)[counts > 0]
    sends = []
    for k in np.unique(bucket):
        lo, hi = np.searchsorted(bucket, [k, k + 1])
        sends.append({"bucket": int(k), "pairs": _squeeze(np.diff(listed[lo:hi], prepend=0)),
                      "counts": _squeeze(docs[lo:hi])})
    seen, held = np.unique(i_a, return_counts=True)
    links_of = np.diff(g.a) * np.diff(g.b)
    doc_of_group = np.repeat(np.arange(n), np.diff(g.doc))
    digests = [hashlib.sha256(x).hexdigest() if x else "" for x in group_texts(t, g)]
    pack = lambda *arrays: _squeeze(np.concatenate(arrays))
    return {"gid": gid, "doc_ids": ids.to_pylist(), "n_a": _squeeze(np.diff(t.doc_a)),
            "n_b": _squeeze(np.diff(t.doc_b)), "n_groups": _squeeze(np.diff(g.doc)),
            "n_links": _squeeze(_per_doc(links_of, doc_of_group, n)), "digests": digests,
            "same": pack(i_count, _deltas(i_a, heads(i_count)), i_n),
            "pairs": pack(p_count, _deltas(where, heads(p_count)), p_n),
            "ident": pack(seen, held), "sends": sends}


_PART_SCHEMA = pa.schema([
    ("gid", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    *((c, pa.binary()) for c in ("n_a", "n_b", "n_groups", "n_links")),
    ("digests", pa.list_(pa.string())), *((c, pa.binary()) for c in ("same", "pairs", "ident")),
    ("sends", pa.list_(pa.struct([("bucket", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary())])))])


def _parts(name_a: str, name_b: str, buckets: int, part_bytes: int):
    def run(batches):
        v = vocabularies(name_a, name_b)
        gid = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def flush():
            row = _part_row(gid, pa.concat_arrays(ids), texts, v, buckets)
            return pa.RecordBatch.from_pylist([row], schema=_PART_SCHEMA)
        for batch in batches:
            id_column, text_column = batch.column("doc_id"), batch.column("text")
            first = 0
            for i in range(batch.num_rows):
                text = text_column[i].as_py()
                texts.append(text)
                size += len(text or "") + 16
                if size >= part_bytes:
                    ids.append(id_column.slice(first, i + 1 - first))
                    yield flush()
                    gid, ids, texts, size, first = gid + 1, [], [], 0, i + 1
            if first < batch.num_rows:
                ids.append(id_column.slice(first))
        if texts:
            yield flush()
    return run


# ------------------------------------------------------------------- totals

def _answer(size_b: int):
    def run(table: pa.Table) -> pa.Table:
        """Totals of one bucket: for each part in the order it sent its pairs,
        and the highest of each A id (as the row of part -1)."""
        gids = table.column("gid").to_pylist()
        pairs = [np.cumsum(_unsqueeze(x)) for x in table.column("pairs").to_pylist()]
        counts = np.concatenate([_unsqueeze(x) for x in table.column("counts").to_pylist()])
        distinct, where = np.unique(np.concatenate(pairs), return_inverse=True)
        order = np.argsort(where, kind="stable")
        edges = np.searchsorted(where[order], np.arange(len(distinct)))
        totals = np.add.reduceat(counts[order], edges)
        a = distinct // size_b
        heads = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        cuts = np.cumsum([len(x) for x in pairs])[:-1]
        bucket = table.column("bucket")[0].as_py()
        return pa.table({
            "gid": pa.array([*gids, -1], pa.int64()),
            "bucket": pa.array([bucket] * (len(gids) + 1), pa.int32()),
            "totals": pa.array([*(_squeeze(x) for x in np.split(totals[where], cuts)),
                                _squeeze(np.maximum.reduceat(totals, heads))], pa.binary()),
            "ids": pa.array([*[None] * len(gids), _squeeze(a[heads])], pa.binary())})
    return run


def _vector(reduce, keys: str, size: int):
    """A vocabulary-length vector of each task, from its rows' packed entries."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                if keys == "ident":
                    ids, values = np.split(_unsqueeze(row["ident"]), 2)
                else:
                    ids, values = _unsqueeze(row["ids"]), _unsqueeze(row["totals"])
                reduce.at(total, ids, values)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])
    return run


def _collect_vector(df: DataFrame, size: int) -> np.ndarray:
    """Rows ``(id, n)`` of distinct ids under ``size``, the length of A's vocabulary."""
    out = np.zeros(size, np.int64)
    for row in df.toLocalIterator():
        out[row["id"]] = row["n"]
    return out


_RESULT_SCHEMA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in (
    "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])


def _finish(identity: np.ndarray, highest: np.ndarray, size_b: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _RESULT_SCHEMA.empty_table()
        row = left.to_pylist()[0]
        n = len(row["doc_ids"])
        answers = dict(zip(right.column("bucket").to_pylist(), right.column("totals").to_pylist()))
        sends = sorted(row["sends"], key=lambda s: s["bucket"])
        empty = np.zeros(0, np.int64)
        listed = np.concatenate([empty, *(np.cumsum(_unsqueeze(s["pairs"])) for s in sends)])
        totals = np.concatenate([empty, *(_unsqueeze(answers[s["bucket"]]) for s in sends)])
        best_listed = totals == highest[listed // size_b]
        best = np.zeros(n, np.int64)
        sums = np.zeros(n, np.int64)
        for name, count, is_best in (("same", identity, identity == highest), ("pairs", totals, best_listed)):
            packed = _unsqueeze(row[name])
            of_doc, packed = packed[:n], packed[n:]
            where, times = np.split(packed, 2)
            where = _undelta(where, (np.cumsum(of_doc) - of_doc)[of_doc > 0])
            doc = np.repeat(np.arange(n), of_doc)
            best += _per_doc(times * is_best[where], doc, n)
            sums += _per_doc(times * count[where], doc, n)
        return pa.Table.from_arrays(
            [pa.array(row["doc_ids"], pa.int64()),
             *(pa.array(_unsqueeze(row[c])) for c in ("n_a", "n_b", "n_groups", "n_links")),
             pa.array(best), pa.array(sums), pa.array(row["digests"], pa.string())], schema=_RESULT_SCHEMA)
    return run


def align(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
          id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document, see ``RESULT``. The vocabularies are names of public
    tokenizers or paths (ranks of a byte-level one, a sentencepiece model)."""
    ship_package(docs.sparkSession)
    base = id_and_text(docs, id_col, text_col)
    v = vocabularies(vocabulary_a, vocabulary_b)
    size_a, size_b = len(v.bytes_a), len(v.bytes_b)
    buckets = groups_for(text_bytes(base), bucket_bytes)
    parts = stage(base.mapInArrow(_parts(vocabulary_a, vocabulary_b, buckets, part_bytes), PARTS), "alignment")
    sent = parts.select("gid", F.explode("sends").alias("s")).select("gid", "s.*")
    answers = stage(sent.groupBy("bucket").applyInArrow(_answer(size_b), ANSWERS), "alignment-totals")
    identity = _collect_vector(
        parts.select("ident").mapInArrow(_vector(np.add, "ident", size_a), "id long, n long")
        .groupBy("id").agg(F.sum("n").alias("n")), size_a)
    highest = np.maximum(identity, _collect_vector(
        answers.filter("gid < 0").select("ids", "totals")
        .mapInArrow(_vector(np.maximum, "tops", size_a), "id long, n long")
        .groupBy("id").agg(F.max("n").alias("n")), size_a))
    rows = parts.drop("ident").groupBy("gid").cogroup(
        answers.filter("gid >= 0").select("gid", "bucket", "totals").groupBy("gid"))
    return rows.applyInArrow(_finish(identity, highest, size_b), RESULT)


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    return align(read_documents(spark, sf_dir))
