"""Rows that share one id, or have none, make up most of a table."""

import random
import re
from collections import Counter

from cartscope.llm import substring_dedup

SCHEMA = "doc_id long, text string, gid string"  # a name the operator uses itself


def test_substring_dedup_when_most_rows_share_an_id(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    texts = [" ".join(rng.choices(vocabulary, k=25)) + " " + passage + " " + " ".join(rng.choices(vocabulary, k=9))
             for _ in range(90)]
    rows = [(None, t) for t in texts[:30]] + [(None, texts[0])] * 30   # no id: neither remove nor lose words
    rows += [(5, t) for t in texts[30:60]] + [(5, texts[30])] * 30     # one id: equal in rank
    rows += [(k, t) for k, t in enumerate(texts[60:], 10)] + [(99, None), (98, "")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(7)
    got = substring_dedup.remove_repeats(df, group_bytes=2000, bucket_bytes=3000).collect()

    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - 12) if i is not None else ():
            key = tuple(w[k:k + 13])
            first[key] = min(first.get(key, i), i)
    want = Counter()
    for i, w in split:
        gone = set()
        for k in range(len(w) - 12) if i is not None else ():
            if first[tuple(w[k:k + 13])] < i:
                gone |= set(range(k, k + 13))
        want[i, " ".join(x for k, x in enumerate(w) if k not in gone), len(w)] += 1
    assert Counter((r["doc_id"], r["text"], r["n_words"]) for r in got) == want
    assert all(len(r["removed"]) for r in got if r["doc_id"] is not None and 10 <= r["doc_id"] < 98)
