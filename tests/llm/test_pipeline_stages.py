"""Stages of the corpus pipeline: what they reject and what they must keep."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cartscope.llm import decontaminate, language_id, near_dedup, packing

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string, typical string, row string, tid string, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "a", "b", "c", "d", "e") for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def labelled():
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    return [(r["doc_id"], r["text"], r["lang"]) for r in table if r["text"] and r["lang"]]


def test_texts_of_no_known_language_are_rejected(spark, labelled):
    rng = random.Random(1)
    noise = ["".join(rng.choice("qwertyuiopasdfghjklzxcvbnm   ") for _ in range(900)) for _ in range(5)]
    russian = ("Утром над рекой стоял густой туман, и рыбаки молча ждали, когда поднимется солнце. " * 8)
    chinese = "清晨的河面上笼罩着浓雾，渔夫们静静地等待太阳升起。" * 15
    foreign = [(900001, russian, None), (900002, chinese, None), (900003, "12 34 !!", None), (900004, None, None),
               (900005, "", "en")]
    rows = labelled + foreign + [(900010 + k, t, None) for k, t in enumerate(noise)]
    kept = {r.doc_id for r in language_id.keep_identified(frame(spark, rows)).collect()}
    assert not kept & {i for i, _, _ in rows if i > 900000}
    clean = {i for i, _, _ in labelled}
    assert len(clean - kept) <= len(clean) // 200


def test_copies_of_a_text_do_not_fill_the_sample(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = [" ".join(word() for _ in range(30)) for _ in range(600)]
    other = [" ".join(word() for _ in range(30)).upper() for _ in range(50)]
    for copied in texts[:8]:  # some of them are drawn
        rows = ([(t, "en") for t in texts] + [(copied, "en")] * 600 + [(t, "de") for t in other] + [("x", None)])
        sample = language_id.draw_sample(spark.createDataFrame(rows, "text string, lang string"), 100)
        n = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
        assert set(n) == {"en", "de"} and 20 <= n["en"] <= 100 and n["de"] == 50
    assert language_id.draw_sample(spark.createDataFrame([("1", "en")], "text string, lang string")) is None


def test_language_edge_cases(spark):
    rows = [(1, None, "en"), (1, "", "en"), (None, "abc " * 50000, "en"), (2, "def def", "de"), (2, "def def", "de")]
    model = language_id.train(frame(spark, rows), F.lit(True))
    got = language_id.identify(frame(spark, rows), model).collect()
    assert sorted(r.lang_pred for r in got) == ["de", "de", "en", "und", "und"]
    one = language_id.train(frame(spark, [(1, "only one", "en")]), F.lit(True))
    assert [r.lang_pred for r in language_id.identify(frame(spark, rows[2:3]), one).collect()] == ["en"]
    assert language_id.keep_identified(frame(spark, [])).count() == 0
    assert [r.doc_id for r in language_id.keep_identified(frame(spark, [(1, "ab", None), (2, "1", None)])).collect()] == [1]


def test_one_row_of_each_group_and_no_text_lost(spark):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("abcdefghijk") for _ in range(5)) for _ in range(n))
    seven = [(4, text(40), "en") for _ in range(6)] + [(5, text(40), "en")]  # different texts of two ids
    assert near_dedup.keep_one(frame(spark, seven)).count() == 7
    base = text(100)
    group = [(10, base, "en"), (9, base, "en"), (9, base, "en"), (None, base, "en"), (8, base + " tail", "en"),
             (None, text(30), "en"), (None, None, "en"), (None, None, "en"), (7, "", None), (6, " \t", None),
             (11, "word " * 40000, "en"), (12, "word " * 40000, "en")]
    kept = near_dedup.keep_one(frame(spark, group))
    assert kept.columns == frame(spark, []).columns
    got = sorted(((r.doc_id, (r.text or "")[:20]) for r in kept.collect()), key=repr)
    assert got == sorted([(8, base[:20]), (None, group[5][1][:20]), (None, ""), (None, ""), (7, ""), (6, " \t"),
                          (11, ("word " * 5)[:20])], key=repr)
    assert near_dedup.keep_one(frame(spark, [])).count() == 0


# --------------------------------------------------------------- decontamination

def _edited(rng, words, lo, hi):
    out, n = list(words), len(words)
    e = int(decontaminate.RATE * n)
    for p in sorted(rng.sample(range(int(lo * n), int(hi * n)), min(e, int(hi * n) - int(lo * n))), reverse=True):
        new = f"zq{rng.randrange(10 ** 6)}"
        kind = rng.randrange(3)
        if kind == 0:
            out[p] = new
        elif kind == 1:
            del out[p]
        else:
            out.insert(p, new)
    return out


@pytest.mark.parametrize("lo,hi", [(0, 1), (0, 0.4), (0.6, 1)])
def test_items_with_crowded_edits_are_found(lo, hi):
    """On the real items, edits at the limit; every miss is checked to be one."""
    rng = random.Random(7)
    table = pq.read_table("/root/testdata/sf0.01/benchmark.parquet").to_pylist()
    items = [(r["item_id"], r["text"]) for r in table]
    vocabulary, classes = decontaminate.build_classes(items)
    words = dict(zip((i for i, _ in items), (vocabulary.ids(w) for w in decontaminate._item_words([t for _, t in items]))))
    texts, want = [], []
    for i, t in items:
        plain = t.split()
        if len(plain) >= 5:
            texts.append("some lead in " + " ".join(_edited(rng, plain, lo, hi)) + " and out")
            want.append(i)
    found = {(r[0], r[1]) for r in decontaminate._hits(pa.array(texts), vocabulary, classes, decontaminate.RATE)}
    exact = 0
    for k, i in enumerate(want):
        h = vocabulary.ids(decontaminate._item_words([texts[k]])[0])
        limit = int(decontaminate.RATE * len(words[i]))
        near = any(decontaminate.window_distance(words[i], h[s:], limit) for s in range(len(h)))
        exact += near
        assert near or (k, i) not in found
    assert exact and sum((k, i) in found for k, i in enumerate(want)) >= 0.9 * exact


def test_part_filter_keeps_every_window_within_its_edits():
    """Windows the exhaustive search accepts are never dropped before the walk."""
    rng = random.Random(9)
    draw = lambda n: [rng.choice("abcdef") + rng.choice("xyz") for _ in range(n)]
    items = [(k, " ".join(draw(n))) for k, n in enumerate([3, 5, 6, 9, 12, 14, 25, 40])]
    vocabulary, classes = decontaminate.build_classes(items, rounds=4)
    texts = [" ".join(draw(5) + _edited(rng, t.split(), 0, 1) + draw(6)) for _, t in items for _ in range(4)]
    for text in texts:
        h = vocabulary.ids(decontaminate._item_words([text])[0])
        places = decontaminate._part_places(h, vocabulary, decontaminate._part_table(classes))
        start, stop = np.zeros(len(h), np.int64), np.full(len(h), len(h))
        for c in classes:
            first, last = decontaminate._beside_parts(places, start, stop, c)
            for item in c.words:
                for s in range(len(h)):
                    got = decontaminate.window_distance(item, h[s:], int(decontaminate.RATE * len(item)))
                    if got and got[1] > 0:
                        assert first[s] and last[s + got[1] - 1]


def test_packed_ids_come_out(spark):
    docs = frame(spark, [(1, "some words here", "en"), (2, None, "en")])
    assert {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist()[-1] for r in packing.pack(docs, with_ids=True).collect()
            } == {1: 0, 2: 0}


def test_ids_are_those_of_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y \n", "", "<|endoftext", "Größe 😀"):
        assert packing.token_ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids + [0]


def test_packed_ids_fill_the_sequences(spark):
    rng = random.Random(3)
    docs = [(k, "".join(rng.choice("abc de\n") for _ in range(rng.choice([0, 5, 200, 9000]))), "en") for k in range(40)]
    docs += [(3, docs[3][1], "en"), (None, "no id", "en")]
    got = packing.pack(frame(spark, docs), with_ids=True).collect()
    whole = {}
    for r in sorted(got, key=lambda r: r.start):
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length
        whole.setdefault((r.doc_id, r.doc_tokens), []).append(ids)
    for i, t, _ in docs:
        want = packing.token_ids(t)
        assert np.array_equal(np.unique(np.concatenate(whole[i, len(want)])), np.unique(want))
