"""Filter audit, suffix deduplication and token alignment against plain versions."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from cartscope.llm import filter_audit, suffix_dedup, token_alignment

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()),
    # names the operators use themselves
    ("part", T.StringType()), ("gid", T.StringType()), ("n", T.StringType()), ("failed", T.StringType()),
    ("digest", T.StringType()), ("bucket", T.StringType()))])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "a", "b", "c", "d", "e", "f") for i, t, lang in rows], SCHEMA)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    shared, line = prose(rng, 120), prose(rng, 45)
    out = [(i, prose(rng, 260), "en") for i in range(12)]
    out += [(20, None, "en"), (21, "", None), (22, "", ""), (23, " \n\t", "de"), (24, "ONE word", "de"),
            (25, out[0][1], "de"), (26, out[0][1], "en"), (26, out[0][1], "en"), (27, out[0][1], "en"),
            (28, prose(rng, 60) + shared + prose(rng, 60), "en"), (29, prose(rng, 5) + shared, None),
            (30, shared + " #", "en"), (None, "no id", "en"), (None, out[1][1], "en"), (None, out[1][1], "en"),
            (31, "ab " * 4000, "en"), (32, "x" * 1500, "en"), (33, "x" * 700 + "y", "en"),
            (34, "Ünï cödé 😀 " * 60, "fr"), (35, "a <|endoftext|> b <s> <0x41> ▁", "en"),
            (36, "a <|endoftext|> b <s> <0x41> \x00 \r\n" + "漢字かな", "en")]
    # one passage in many different surroundings
    out += [(100 + i, prose(rng, 30) + line + prose(rng, 30), "en") for i in range(25)]
    return out


# ------------------------------------------------------------------ filter audit

def plain_audit(rows, labels):
    fails = []
    for k, (i, text, lang) in enumerate(rows):
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(w) < 200:
            f.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            f.add("C")
        if re.search("[#$%&*|]", t):
            f.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows):
            f.add("E")
        good = any(d == i and q == 1 for d, q, _ in labels if i is not None)
        toxic = any(d == i and x == 1 for d, _, x in labels if i is not None)
        fails.append((lang or "", f, good, toxic))
    out, shap = {}, Counter()
    for part in {x[0] for x in fails}:
        docs = [x for x in fails if x[0] == part]
        for order in permutations("ABCDE"):
            alive = docs
            for step, c in enumerate(order, 1):
                gone = [d for d in alive if c in d[1]]
                before, alive = alive, [d for d in alive if c not in d[1]]
                shap[part, c] += len(gone)
                failing = sum(c in d[1] for d in docs)
                out[part, "".join(order), step] = (
                    len(alive), len(gone), failing - len(gone), sum(d[1] == {c} for d in docs),
                    sum(d[2] for d in gone), sum(d[3] for d in gone))
    return {k: (*v, shap[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_plain_version(spark, rows):
    labels = [(0, 1, 0), (0, 0, 1), (25, 1, 0), (26, 1, 1), (24, None, 1), (None, 1, 1), (31, 1, None), (999, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:]
           for r in filter_audit.audit(frame(spark, rows), table).collect()}
    assert got == plain_audit(rows, labels)


def test_audit_equals_sql(spark, rows):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(filter_audit.ORACLE_SQL)
    names = [d[0] for d in cur.description]
    want = sorted(cur.fetchall(), key=repr)
    df = filter_audit.op11_filter_audit(spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == want


def test_positional_popcount_counts_repeats():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 1000):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        counts = rng.integers(1, 5000, n)
        want = [int(((words >> np.uint32(b)) & 1).astype(np.int64) @ counts) for b in range(32)]
        assert filter_audit.positional_popcount(words, counts).tolist() == want


# ----------------------------------------------------------------- suffix dedup

def plain_suffixes(texts, length):
    blobs = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in blobs for i in range(len(b) - length + 1))
    out = []
    for b in blobs:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(bytes(x for x, g in zip(b, gone) if not g))
    return out


@pytest.mark.parametrize("length,hot", [(400, 4096), (400, 3), (64, 4096), (64, 4)])
def test_suffix_dedup_equals_plain_version(spark, rows, length, hot):
    docs = frame(spark, rows).repartition(3)
    got = suffix_dedup.remove_repeats(docs, length, group_bytes=6000, bucket_bytes=9000, hot=hot).collect()
    texts = [t for _, t, _ in rows]
    want = Counter((i, len((t or "").encode()), k) for (i, t, _), k in zip(rows, plain_suffixes(texts, length)))
    assert Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got) == want
    for r in got:
        assert r.n_bytes - len(r.kept) == sum(s.stop - s.start for s in r.removed)
        assert all(a.stop < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_front_code_round_trip_and_merge():
    rng = random.Random(5)
    words = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    runs = [sorted(words[k::7]) for k in range(7)] + [[]]
    coded = [suffix_dedup.front_code(r, 30) for r in runs]
    decoded = [suffix_dedup.front_decode(c + b"tail") for c in coded]
    assert [d[0] for d in decoded] == runs and [d[2] for d in decoded] == [len(c) for c in coded]
    order, shared = suffix_dedup.merge_runs([(d[0], d[1]) for d in decoded])
    merged = [runs[r][k] for r, k in order]
    assert merged == sorted(words)
    for a, b, h in zip(merged, merged[1:], shared[1:]):
        assert a[:h] == b[:h] and (h == min(len(a), len(b)) or a[h] != b[h])
    assert suffix_dedup.merge_runs([]) == ([], [])


def test_merge_looks_at_no_known_prefix(monkeypatch):
    """Equal prefixes of 200 bytes are passed over at most once a level of the tree."""
    looked = []
    plain = suffix_dedup._extend

    def counted(a, b, known):
        h = plain(a, b, known)
        looked.append(h - known + 1)
        return h
    monkeypatch.setattr(suffix_dedup, "_extend", counted)
    runs = []
    for r in range(8):
        strings = [b"p" * 200 + f"{k * 8 + r:04d}".encode() for k in range(100)]
        runs.append(suffix_dedup.front_decode(suffix_dedup.front_code(strings, 204))[:2])
    order, _ = suffix_dedup.merge_runs(runs)
    assert [k * 8 + r for r, k in order] == list(range(800))
    assert sum(looked) < 7 * 205 + 800 * 3 * 6


# --------------------------------------------------------------- token alignment

def plain_alignment(texts):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    chars = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in chars}
    byte.update({chr(256 + n): c for n, c in enumerate(x for x in range(256) if x not in chars)})
    of_a = {i: bytes(byte[c] for c in s) for s, i in a.get_vocab().items() if i != 50256}

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
    found, held = [], Counter()
    for t in texts:
        found.append(None)
        if not t:
            continue
        ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        if any(b"".join(x) != (" " + t).encode() for x in (map(of_a.get, ids_a), map(of_b, ids_b))):
            continue
        groups, ga, gb, end_a, end_b = [], [], [], 0, 0
        left_a, left_b = list(ids_a), list(ids_b)
        while left_a or left_b:
            if left_a and end_a <= end_b:
                ga.append(left_a.pop(0))
                end_a += len(of_a[ga[-1]])
            else:
                gb.append(left_b.pop(0))
                end_b += len(of_b(gb[-1]))
            if end_a == end_b:
                groups.append((ga, gb))
                ga, gb = [], []
        links = Counter((x, y) for p, q in groups for x in p for y in q)
        held.update(links.keys())
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        found[-1] = (len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(text.encode()).hexdigest())
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (*f[:3], f[3].total(), sum(n for k, n in f[3].items() if held[k] == best[k[0]]),
             sum(n * held[k] for k, n in f[3].items()), f[4]) for f in found]


@pytest.mark.parametrize("limit", [1 << 16, 1])
def test_alignment_equals_plain_version(spark, rows, limit, monkeypatch):
    # groups over the limit list distinct ids instead of all links
    monkeypatch.setattr(token_alignment, "GROUP_LINKS", limit)
    v = token_alignment.vocabularies()
    texts = [t for _, t, _ in rows]
    t = token_alignment.tokenize(texts, v)
    g = token_alignment.cut_groups(t, v.len_a, v.len_b)
    (i_doc, _, i_n), (p_doc, _, _, p_n) = token_alignment.links(t, g, v.same)
    want = plain_alignment(texts)
    counted = Counter()
    for d, n in zip([*i_doc.tolist(), *p_doc.tolist()], [*i_n.tolist(), *p_n.tolist()]):
        counted[d] += n
    assert [counted[k] for k in range(len(texts))] == [w[3] for w in want]
    if limit > 1:
        got = token_alignment.align(frame(spark, rows).repartition(3), part_bytes=5000, bucket_bytes=8000).collect()
        assert Counter(map(tuple, got)) == Counter((i, *w) for (i, _, _), w in zip(rows, want))
        assert Counter(w[0] for w in want)[0] >= 4  # null, empty and U+2581 texts


def test_identity_map_names_equal_bytes():
    v = token_alignment.vocabularies()
    known = np.flatnonzero(v.same >= 0)
    assert len(known) > 10_000
    assert all(v.bytes_a[k] == v.bytes_b[v.same[k]] for k in known.tolist())


def test_empty_tables(spark):
    empty = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, labels).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert token_alignment.align(empty).count() == 0
    nulls = frame(spark, [(None, None, None)] * 3)
    first = filter_audit.audit(nulls, labels).filter("step = 1").collect()
    assert len(first) == 120 and {r.part for r in first} == {""}
    assert all((r.kept, r.removed) == ((0, 3) if r.filter_order[0] == "A" else (3, 0)) for r in first)
    assert {bytes(r.kept) for r in suffix_dedup.remove_repeats(nulls).collect()} == {b""}
    assert [r.n_links for r in token_alignment.align(nulls).collect()] == [0, 0, 0]
