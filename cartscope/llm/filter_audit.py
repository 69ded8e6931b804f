"""Audit of how filters interact, from truth-table survival words.

Method: five filters fail a document or not, so it survives some of the 32
subsets of filters: bit ``S`` of its survival word is set if no filter of ``S``
fails it. Counting each bit over all words (a positional popcount) gives the
survivors of every subset at once. The counts are taken by carry-save adders:
three words of weight ``w`` become one sum word of weight ``w`` and one carry
word of weight ``2 w``, bitwise for all 32 positions, until at most two words of
each weight are left. Survivors per part and label then answer every order of
the filters: what a step keeps or removes is a difference of two subsets.

Filters (words are maximal runs ``[^\\x20\\x09-\\x0D]+``): A under 200 words;
B distinct words under half of all; C capital letters A-Z over 3 % of the code
points; D holds one of ``#$%&*|``; E identical to the text of a smaller id.

How it is spread. One pass over the texts leaves a narrow row a document (id,
part, digest, fail bits of A to D); no text is shuffled. Equal rows (same text,
id and part) become one with a count before any exchange, and enter the adders
at the weights of the count's binary digits. The least id of a text is a
partial ``min`` by digest, joined back on (digest, id): a text that a third of
all documents share is one row a task, and no group of a text is ever listed.
Adders run inside the tasks; a batch sends one row per part and label.

Texts are equal if their 128-bit xxh3 digests and lengths are. Distinct words
are told apart by 64-bit hashes, per document.

Defined results: a null text is an empty one and empty texts are identical to
each other; rows of one id don't make each other fail E, a null id neither
fails E nor makes others fail; a null part is the empty string; a document has
a label if any row of ``labels`` with its id says so; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartscope.llm.common import (read_documents, read_table, ship_package, split_words, text_chunks)

FILTERS = "ABCDE"
MIN_WORDS = 200
SUBSETS = 1 << len(FILTERS)
_DUPLICATE = 1 << FILTERS.index("E")
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[ord(c) for c in "#$%&*|"]] = True

#: Survival word of each set of failed filters.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)],
                 dtype=np.uint32)

_DIGESTS = "doc_id long, part string, digest binary, failed int"
_COUNTS = "part string, good boolean, toxic boolean, survivors array<long>"
REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


# ------------------------------------------------------------------- the texts

def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[off[1:]] - sums[off[:-1]]


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct words of each document."""
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=n)


def fail_bits(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Filters A to D of the texts ``data[off[i]:off[i + 1]]``."""
    words = split_words(data, off, fold_case=False)
    n = len(off) - 1
    n_words = np.diff(words.doc)
    distinct = _distinct(words.hashes, words.doc_of_word(), n)
    capitals = _per_text((data >= 65) & (data <= 90), off)
    points = _per_text((data & 0xC0) != 0x80, off)
    marks = _per_text(_MARKS[data], off)
    return ((n_words < MIN_WORDS) | ((100 * distinct < 50 * n_words) << 1)
            | ((100 * capitals > 3 * points) << 2) | ((marks > 0) << 3)).astype(np.int32)


def _digest(batches):
    for batch in batches:
        for i, j, data, off in text_chunks(batch.column("text")):
            blob = data.tobytes()
            ends = off.tolist()
            digests = [xxhash.xxh3_128_digest(blob[s:e]) + (e - s).to_bytes(8, "little")
                       for s, e in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), batch.column("part").slice(i, j - i),
                 pa.array(digests, pa.binary()), pa.array(fail_bits(data, off))],
                names=["doc_id", "part", "digest", "failed"])


# ------------------------------------------------------------------ the adders

def positional_popcount(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many of the words, each taken ``counts`` times, have each bit set."""
    levels = [words[(counts >> k) & 1 == 1] for k in range(int(counts.max()).bit_length() if len(counts) else 0)]
    total = np.zeros(SUBSETS, dtype=np.int64)
    k = 0
    while k < len(levels):
        x, carries = levels[k], []
        while len(x) >= 3:
            m = len(x) // 3
            a, b, c = x[:m], x[m:2 * m], x[2 * m:3 * m]
            half = a ^ b
            carries.append((a & b) | (half & c))
            x = np.concatenate([half ^ c, x[3 * m:]])
        if carries:
            if k + 1 == len(levels):
                levels.append(words[:0])
            levels[k + 1] = np.concatenate([levels[k + 1], *carries])
        for word in x:
            total += ((int(word) >> np.arange(SUBSETS)) & 1) << k
        k += 1
    return total


def _survivors(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column("part").dictionary_encode()
        part = names.indices.to_numpy()
        label = (batch.column("good").to_numpy(zero_copy_only=False).astype(np.int64) * 2
                 + batch.column("toxic").to_numpy(zero_copy_only=False))
        words = WORDS[batch.column("failed").to_numpy()]
        counts = batch.column("n").to_numpy()
        key = part * np.int64(4) + label
        order = np.argsort(key, kind="stable")
        cells, first = np.unique(key[order], return_index=True)
        out = [positional_popcount(words[rows], counts[rows]) for rows in np.split(order, first[1:])]
        yield pa.RecordBatch.from_arrays(
            [names.dictionary.take(pa.array(cells // 4)), pa.array(cells % 4 >= 2), pa.array(cells % 2 == 1),
             pa.array([x.tolist() for x in out], pa.list_(pa.int64()))],
            names=["part", "good", "toxic", "survivors"])


# ------------------------------------------------------------------ the report

def _order_rows(part: str, alive: np.ndarray, good: np.ndarray, toxic: np.ndarray):
    n = len(FILTERS)
    everything = SUBSETS - 1
    shapley = []
    for f in range(n):
        without = [s for s in range(SUBSETS) if not s >> f & 1]
        shapley.append(sum(factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())
                           * int(alive[s] - alive[s | 1 << f]) for s in without))
    for order in permutations(range(n)):
        before = 0
        name = "".join(FILTERS[f] for f in order)
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed = int(alive[before] - alive[after])
            yield (part, name, step, int(alive[after]), removed,
                   int(alive[0] - alive[1 << f]) - removed,
                   int(alive[everything & ~(1 << f)] - alive[everything]),
                   int(good[before] - good[after]), int(toxic[before] - toxic[after]), shapley[f])
            before = after


def _report(batches):
    schema = pa.schema([(c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]])
                        for c in REPORT.split(", ")])
    for batch in batches:
        for row in batch.to_pylist():
            sums = [np.zeros(SUBSETS, dtype=np.int64) for _ in range(3)]
            for cell in row["cells"]:
                for total, column in zip(sums, ("alive", "good", "toxic")):
                    total[cell["subset"]] = cell[column]
            columns = zip(*_order_rows(row["part"], *sums))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def survival(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """One row per part and subset of filters: documents that survive it, all of
    them (``alive``) and those labelled good or toxic."""
    ship_package(docs.sparkSession)
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                       docs["text"].cast("string").alias("text"))
    judged = base.mapInArrow(_digest, _DIGESTS)
    rows = judged.groupBy("digest", "doc_id", "part", "failed").agg(F.count(F.lit(1)).alias("n"))
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    rows = rows.join(least.hint("merge"), ["digest", "doc_id"], "left")
    fails = F.col("failed") + F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), _DUPLICATE).otherwise(0)
    # documents alike in all that counts, before the labels meet them
    rows = rows.groupBy("doc_id", "part", fails.cast("int").alias("failed")).agg(F.sum("n").alias("n"))

    def said(name: str, value: int) -> Column:
        return F.coalesce(F.max(F.col(name) == value), F.lit(False))
    marks = labels.groupBy(labels["doc_id"].cast("long").alias("doc_id")).agg(
        said("quality", 1).alias("good"), said("toxic", 1).alias("toxic"))
    rows = rows.join(marks.hint("merge"), "doc_id", "left").select(
        "part", "failed", "n", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    counts = rows.mapInArrow(_survivors, _COUNTS)
    return (counts.select("part", "good", "toxic", F.posexplode("survivors").alias("subset", "n"))
            .groupBy("part", "subset").agg(
                F.sum("n").alias("alive"),
                F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")))


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step, see ``REPORT``."""
    cells = (survival(docs, labels, part_col).groupBy("part")
             .agg(F.collect_list(F.struct("subset", "alive", "good", "toxic")).alias("cells")))
    return cells.mapInArrow(_report, REPORT)


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(read_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(marks.toxic, false) AS toxic,
         (len(w) < 200) AS fa, (100 * len(list_distinct(w)) < 50 * len(w)) AS fb,
         (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t)) AS fc,
         regexp_matches(t, '[#$%&*|]') AS fd,
         coalesce(base.doc_id > min(base.doc_id) OVER (PARTITION BY t), false) AS fe
  FROM base LEFT JOIN marks ON base.doc_id = marks.doc_id),
cells AS (
  SELECT part, good, toxic, count(*) AS n,
         fa::INT + fb::INT * 2 + fc::INT * 4 + fd::INT * 8 + fe::INT * 16 AS failed
  FROM judged GROUP BY ALL),
subsets AS (SELECT unnest(range(32)) AS s),
alive AS (
  SELECT part, s, sum(CASE WHEN failed & s = 0 THEN n ELSE 0 END) AS n,
         sum(CASE WHEN failed & s = 0 AND good THEN n ELSE 0 END) AS good,
         sum(CASE WHEN failed & s = 0 AND toxic THEN n ELSE 0 END) AS toxic
  FROM cells CROSS JOIN subsets GROUP BY part, s),
letters(c, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
grown(o, s) AS (
  SELECT '', 0
  UNION ALL SELECT o || c, s | b FROM grown JOIN letters ON s & b = 0),
orders AS (SELECT o FROM grown WHERE length(o) = 5),
steps AS (
  SELECT orders.o AS filter_order, length(g.o) + 1 AS step, g.s AS before, l.b AS bit
  FROM orders JOIN grown g ON length(g.o) < 5 AND g.o = left(orders.o, length(g.o))
       JOIN letters l ON l.c = substr(orders.o, length(g.o) + 1, 1)),
value AS (
  SELECT a.part, l.b AS bit, sum((a.n - z.n) * CASE bit_count(a.s) WHEN 0 THEN 24 WHEN 1 THEN 6
                                              WHEN 2 THEN 4 WHEN 3 THEN 6 ELSE 24 END) AS shapley
  FROM alive a JOIN letters l ON a.s & l.b = 0 JOIN alive z ON z.part = a.part AND z.s = a.s | l.b
  GROUP BY a.part, l.b)
SELECT p.part, st.filter_order, st.step::INT AS step, q.n::BIGINT AS kept, (p.n - q.n)::BIGINT AS removed,
       (al.n - one.n - (p.n - q.n))::BIGINT AS redundant, (rest.n - none.n)::BIGINT AS unique_fails,
       (p.good - q.good)::BIGINT AS good_lost, (p.toxic - q.toxic)::BIGINT AS toxic_lost,
       value.shapley::BIGINT AS shapley
FROM steps st
JOIN alive p ON p.s = st.before
JOIN alive q ON q.part = p.part AND q.s = st.before | st.bit
JOIN alive al ON al.part = p.part AND al.s = 0
JOIN alive one ON one.part = p.part AND one.s = st.bit
JOIN alive rest ON rest.part = p.part AND rest.s = 31 - st.bit
JOIN alive none ON none.part = p.part AND none.s = 31
JOIN value ON value.part = p.part AND value.bit = st.bit
"""
