"""Near-duplicate groups by MinHash, banding and verified links.

Method: ``PERMS`` universal hash minima of the document's distinct word
shingles; the minima are cut into bands and documents that agree on a band
share a bucket; candidate pairs of a bucket are confirmed on their full shingle
sets (``100 * |A and B| >= percent * |A or B|``); groups are the connected
components of the confirmed links (alternating large-star and small-star).

No group is expanded into all its pairs, and no link that could change a group
is skipped:

1. Documents with the same set form one class, found by a grouped ``min`` with
   partial aggregation; a class takes part once, however many copies it has.
2. Star rounds: each bucket picks one member, other members of the bucket that
   are not yet in its component are checked against it, components are updated.
   The first round picks the same member wherever it can, later rounds another
   one in each bucket, so a document left over by the first meets many.
3. Last rounds: in buckets that still hold several components, all pairs of
   members of *different* components are compared, in blocks of ``BLOCK``
   members (the bucket's largest component only with the others), each pair in the first bucket it shares, first on their signatures
   and, if the estimate is not far below the threshold, on the full sets. The
   nearest ``TOP`` members of other components come first and components are
   updated; then what is still apart is compared with everything, and a block
   gives only the links that connect, at most one less than its members.

A pair at the threshold misses all bands with probability 5e-8
(``(1 - 0.8^4)^32``), and its signature estimate falls under the cut of the
last round with about 3e-5 (four standard deviations).

Defined results: a document without words, or a null text, has an empty set
and is linked with nothing; fewer words than a shingle make one shingle of all
words; rows sharing a doc_id are one node; a null doc_id gets a null component
and is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartscope.llm.common import (Words, as_binary, id_and_text, mix, read_documents, ship_package,
                                  split_words, stage, text_chunks, window_hashes)
from cartscope.llm.components import components

PERMS, BANDS = 128, 32
ROWS = PERMS // BANDS
SHINGLE, PERCENT = 5, 80
STAR_ROUNDS = 2
BLOCK = 256
#: Partners of a member in other components that are checked before all are.
TOP = 3
ESTIMATE_SLACK = 0.14

_rng = np.random.default_rng(77)
_A = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2)


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    hashes, at = window_hashes(words, size)
    cuts = np.searchsorted(at, words.doc)
    out = []
    for r in range(words.n_docs()):
        a, b = words.doc[r], words.doc[r + 1]
        if 0 < b - a < size:
            whole = words.hashes[a:b]
            acc = np.uint64(b - a)
            for h in whole:
                acc = np.uint64((int(acc) * 0x9E3779B97F4A7C15 + int(h)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(np.array([acc], dtype=np.uint64)))
        else:
            out.append(np.unique(hashes[cuts[r]:cuts[r + 1]]))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """``PERMS`` minima of ``(a * x + b) mod 2^64``, upper halves."""
    best = np.full(PERMS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 1024):
        part = shingles[i:i + 1024]
        np.minimum(best, (_A[:, None] * part[None, :] + _B[:, None]).min(axis=1), out=best)
    return (best >> np.uint64(32)).astype("<u4")


def _per_document(batches, size: int):
    for batch in batches:
        for i, j, data, off in text_chunks(batch.column(batch.schema.get_field_index("text"))):
            sets = shingle_sets(split_words(data, off, fold_case=True), size)
            ids = batch.column(batch.schema.get_field_index("doc_id")).slice(i, j - i)
            yield ids, sets


def _signer(size: int):
    def sign(batches):
        for ids, sets in _per_document(batches, size):
            some = [s if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(s) for s in sets], pa.int64()),
                as_binary([None if s is None else xxhash.xxh3_128_digest(s.tobytes()) for s in some]),
                as_binary([None if s is None else signature(s).tobytes() for s in some]),
            ], names=["doc_id", "n_shingles", "set_key", "sig"])
    return sign


def _setter(size: int):
    def sets_of(batches):
        for ids, sets in _per_document(batches, size):
            yield pa.RecordBatch.from_arrays(
                [ids, as_binary([s.tobytes() for s in sets])], names=["class_id", "shingles"])
    return sets_of


def _verifier(percent: int):
    def verify(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            left, right = batch.column(2), batch.column(3)
            ok, last, last_set = np.zeros(len(batch), dtype=bool), None, None
            for k in range(len(batch)):
                raw = left[k].as_buffer()
                if last != a[k].as_py():
                    last, last_set = a[k].as_py(), np.frombuffer(raw, "<u8")
                other = np.frombuffer(right[k].as_buffer(), "<u8")
                pos = np.searchsorted(last_set, other)
                pos[pos == len(last_set)] = 0
                both = int((last_set[pos] == other).sum())
                ok[k] = 100 * both >= percent * (len(last_set) + len(other) - both)
            yield pa.RecordBatch.from_arrays([a, b, pa.array(ok)], names=["a", "b", "ok"])
    return verify


def _similar(table: pa.Table, percent: int):
    """Yield ``(i, rows j, estimates)``: pairs of the block in different components
    that may reach the threshold, each in the first bucket it shares."""
    least = percent / 100 - ESTIMATE_SLACK
    side = np.asarray(table.column("side"))
    label, n = np.asarray(table.column("label")), np.asarray(table.column("n_shingles"))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u4").reshape(len(side), PERMS)
    band = table.column("band")[0].as_py()
    rights = np.flatnonzero((side & 2) > 0)
    for i in np.flatnonzero((side & 1) > 0):
        j = rights[label[rights] != label[i]]
        j = j[(100 * n[j] >= percent * n[i]) & (100 * n[i] >= percent * n[j])]
        if len(j):
            same = sig[j] == sig[i]
            near = same.mean(axis=1)
            ok = (near >= least) & (same.reshape(len(j), BANDS, ROWS).all(axis=2).argmax(axis=1) == band)
            if ok.any():
                yield i, j[ok], near[ok]


def _nearest(percent: int):
    """The ``TOP`` nearest partners of each member of a block."""
    def pairs(table: pa.Table) -> pa.Table:
        ids = np.asarray(table.column("class_id"))
        a, b = [], []
        for i, j, near in _similar(table, percent):
            j = j[np.argsort(-near, kind="stable")[:TOP]]
            a += np.minimum(ids[j], ids[i]).tolist()
            b += np.maximum(ids[j], ids[i]).tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return pairs


def _active(percent: int):
    """The members of a block that have a partner at all."""
    def active(table: pa.Table) -> pa.Table:
        used = np.zeros(len(table), dtype=bool)
        for i, j, _ in _similar(table, percent):
            used[i] = True
            used[j] = True
        return table.filter(pa.array(used))
    return active


def _exact_links(percent: int):
    """Confirmed links of a block on the full sets. A pair that links found
    before in the block already connect needs no check."""
    def links(table: pa.Table) -> pa.Table:
        ids = np.asarray(table.column("class_id"))
        sets = [np.frombuffer(x.as_buffer(), "<u8") for x in table.column("shingles")]
        group = np.unique(np.asarray(table.column("label")), return_inverse=True)[1]
        u, v = [], []
        for i, js, near in _similar(table, percent):
            for j in js[np.argsort(-near, kind="stable")]:
                if group[i] == group[j]:
                    continue
                pos = np.searchsorted(sets[i], sets[j])
                pos[pos == len(sets[i])] = 0
                both = int((sets[i][pos] == sets[j]).sum())
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    u.append(int(ids[i]))
                    v.append(int(ids[j]))
                    group[group == group[j]] = group[i]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return links


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among ``pairs(a, b)``, on the full sets."""
    left = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb")
    checked = both.mapInArrow(_verifier(percent), "a long, b long, ok boolean")
    return checked.filter("ok").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _relabel(members: DataFrame, links: DataFrame) -> DataFrame:
    labels = components(links).withColumnRenamed("node", "class_id")
    return members.join(labels, "class_id", "left").withColumn(
        "label", F.coalesce("label", "class_id"))


def _mixed(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with their bucket's size
    ``n`` and its largest component ``main``, by one join. A bucket of two is left
    out: the first star round has compared its only pair."""
    spread = (members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"),
                                     F.count(F.lit(1)).alias("labels"))
              .filter("labels > 1 AND n > 2").drop("labels"))
    return members.join(spread, "bucket")


def _blocks(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of mixed buckets, dealt into cells of two blocks.

    A bucket's largest component is apart: its members need to meet only the
    others, so a large group with a few outsiders is written about once. Cells
    ``(bi, bj)`` pair two blocks of the others, cells ``(-1 - block, bj)`` a
    block of the largest component with one of the others; a bucket that fits
    a block is one cell. Every pair of members of different components is in
    exactly one cell of the bucket."""
    sized = _mixed(members).select(
        "bucket", "band", "class_id", "label", (F.col("n") <= BLOCK).alias("small"),
        (F.col("label") == F.col("main.label")).alias("in_main"),
        F.ceil(F.col("main.n") / F.lit(BLOCK)).cast("int").alias("main_blocks"),
        F.ceil((F.col("n") - F.col("main.n")) / F.lit(BLOCK)).cast("int").alias("blocks"))
    in_main = F.col("in_main")

    def cells(blocks: str, cell) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), lambda b: F.struct(
            *[c.cast("int").alias(n) for c, n in zip(cell(b), ("bi", "bj", "side"))]))

    own = F.col("own")
    among = cells("blocks", lambda b: (F.least(own, b), F.greatest(own, b),
                                       F.when(own == b, 3).when(own < b, 1).otherwise(2)))
    to_main = cells("main_blocks", lambda b: (-1 - b, own, F.lit(1)))
    of_main = cells("blocks", lambda b: (-1 - own, b, F.lit(2)))
    whole = cells("blocks", lambda b: (b, b, F.lit(3)))  # of a small bucket: its one block
    rest = (sized.join(classes.select("class_id", "n_shingles", "sig"), "class_id")
            .withColumn("own", F.pmod(F.xxhash64("class_id"), F.when(in_main, F.col("main_blocks"))
                                      .otherwise(F.col("blocks"))).cast("int"))
            .withColumn("cell", F.explode(
                F.when(F.col("small"), whole).when(in_main, of_main).otherwise(F.concat(among, to_main)))))
    return rest.select("bucket", "band", "cell.bi", "cell.bj", "cell.side", "class_id", "label", "n_shingles", "sig")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the
    smallest doc_id of its group), ``kept`` (whether that is itself)."""
    ship_package(docs.sparkSession)
    base = id_and_text(docs, id_col, text_col)
    signed = stage(base.mapInArrow(_signer(shingle),
                                   "doc_id long, n_shingles long, set_key binary, sig binary"), "signed")
    usable = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stage(usable.groupBy("set_key").agg(
        F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig")), "classes")
    # rows of one doc_id with different texts are one node
    same_id = usable.join(classes.select("set_key", "class_id"), "set_key").filter("doc_id <> class_id")
    twice = usable.groupBy("doc_id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi")) \
        .filter("lo <> hi").select("doc_id")
    known_links = same_id.join(twice, "doc_id").select(F.col("doc_id").alias("u"), F.col("class_id").alias("v"))

    banded = classes.select("class_id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring("sig", b * (4 * ROWS) + 1, F.lit(4 * ROWS))))).alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")) \
        .filter("lo <> hi").select("bucket")
    buckets = stage(banded.join(shared, "bucket").distinct(), "buckets")
    wanted = buckets.select("class_id").distinct()
    sets = stage(base.join(wanted.withColumnRenamed("class_id", "doc_id"), "doc_id", "left_semi")
                 .mapInArrow(_setter(shingle), "class_id long, shingles binary")
                 # of rows sharing a doc_id, the set the class stands for
                 .join(classes.select("class_id", "set_key"), "class_id")
                 .select("class_id", "shingles").dropDuplicates(["class_id"]), "sets")

    links = stage(known_links, "links")
    tested = None
    members = buckets.withColumn("label", F.col("class_id"))
    for t in range(STAR_ROUNDS):
        # read twice: for the centres and for the pairs
        mixed = members if t == 0 else stage(_mixed(members), "mixed")
        luck = F.xxhash64("class_id") if t == 0 else F.xxhash64(F.lit(t), "bucket", "class_id")
        centre = mixed.groupBy("bucket").agg(F.min(F.struct(
            luck.alias("r"), F.col("class_id").alias("c"), F.col("label").alias("cl"))).alias("m"))
        pairs = (mixed.join(centre, "bucket").filter("label <> m.cl")
                 .select(F.least("class_id", F.col("m.c")).alias("a"),
                         F.greatest("class_id", F.col("m.c")).alias("b")).distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = stage(links.unionByName(_confirm(pairs, sets, percent)), "links")
        members = stage(_relabel(buckets, links), "members")

    block = ("bucket", "bi", "bj")
    near = _blocks(members, classes).groupBy(*block).applyInArrow(_nearest(percent), "a long, b long")
    pairs = stage(near.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
    links = stage(links.unionByName(_confirm(pairs, sets, percent)), "links")
    members = stage(_relabel(buckets, links), "members")
    rest = _blocks(members, classes)
    active = rest.groupBy(*block).applyInArrow(_active(percent), rest.schema)
    found = (active.join(sets, "class_id").groupBy(*block)
             .applyInArrow(_exact_links(percent), "u long, v long"))
    links = stage(links.unionByName(found), "links")

    labels = components(links)
    per_class = (classes.select("set_key", F.col("class_id").alias("node")).join(labels, "node", "left")
                 .select("set_key", F.coalesce("label", "node").alias("component_id")))
    found = (signed.join(per_class, "set_key", "left")
             .join(labels.select(F.col("node").alias("doc_id"), F.col("label").alias("own_label")),
                   "doc_id", "left"))
    component = F.least(F.coalesce("component_id", "doc_id"), F.coalesce("own_label", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one document of each group of near duplicates: the
    row with its smallest id (a null id is the greatest; then the text's hash decides).

    Texts, not ids, are grouped: rows that share an id but not a text are documents
    each. Of rows with one text one is kept, unless the text has no word: such rows
    are like nothing and all stay. Texts are told apart by 64-bit hashes (N of them are
    confused N^2 / 2^65 times)."""
    given = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = docs.select(given, docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"),
                       F.xxhash64(docs[text_col].cast("string")).alias("tid"))
    # rows of one text and id need no more than one line
    ids = rows.select("id", "tid").distinct()
    groups = (near_duplicates(rows.select("tid", "text"), shingle, percent, "tid", "text")
              .filter("n_shingles > 0").select(F.col("doc_id").alias("tid"), "component_id").distinct())
    # the best (id, text) of a component; of one text, only its best id can win
    best = (ids.groupBy("tid").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tid")).alias("b"))
            .join(groups, "tid").groupBy("component_id").agg(F.min("b").alias("b")))
    chosen = best.select(F.col("b.tid").alias("tid"), F.col("b.id").alias("id"))
    has_words = F.col("text").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    same_id = rows["id"].eqNullSafe(chosen["id"])
    kept = (rows.filter(has_words).join(chosen, (rows["tid"] == chosen["tid"]) & same_id, "left_semi")
            .dropDuplicates(["tid"]))
    return kept.unionByName(rows.filter(~has_words)).select("row.*")


def op3_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_documents(spark, sf_dir), shingle=4)


ORACLE_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3]) END)) AS s
  FROM docs),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (na + nb - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, root) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.root AS component_id, s.doc_id = m.root AS kept
FROM sets s JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) m ON m.node = s.doc_id
"""
