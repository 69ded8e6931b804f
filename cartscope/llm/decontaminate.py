"""Benchmark decontamination under edit distance, by CGK embedding and LSH.

Method. Benchmark items and documents are sequences of words (runs of letters,
digits and non-ASCII bytes, lower-cased by ASCII). A document is contaminated
by an item if some window of it is within ``floor(rate * n)`` word insertions,
deletions and substitutions of the item's ``n`` words.

The CGK random walk reads a sequence one word a step and stays on the word or
moves on, as a random bit of (step, word) says; it turns edit distance into
Hamming distance between the words it reads. Bit-sampling LSH keys a sequence
by what the walk reads at ``SAMPLES`` random steps; ``ROUNDS`` independent
walks with their own steps are tried. Windows start at every word of every
document; the steps sampled for an item lie within its own length, so the key
of a window does not depend on where the window ends, and items are grouped by
length in powers of two. A window whose key meets an item's is a candidate and
is verified by exact banded edit distance.

The key is evaluated step by step: a window whose first samples already differ
from those of every item is dropped at once. Before the walk, two conditions that
the edit distance implies drop windows and lose nothing. Of an item cut into one
part more than its edits, some part is left as it is, moved by at most the edits; so
only starts beside a part's words are walked. And a window must hold as many
benchmark words, and rarer ones, as some item within its edits leaves.

Walks run in both directions: half of the rounds read a window from its first word
on, half from its last word back, as edits before a sample spoil it wherever they
crowd.

Recall: an exact copy meets its item in the first round. With the default
rounds and samples, items with exactly ``floor(rate * n)`` random edits are met
with probability 0.95 or more at every length (the tests plant that many edits
in items of 9 to 300 words, spread over the item or crowded into its first or
last 40 %, and ask for 0.9).

Scale. Documents are read once, without a shuffle, and no document's work
depends on another's. Items travel with the tasks in blocks of at most
``BLOCK_BYTES`` of benchmark text; a larger benchmark takes more passes.

Defined results: null or empty texts and items without words match nothing;
items equal in words are reported each; repeated document rows are reported
each; a null doc_id is reported as null; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartscope.llm.common import (NOT_ALNUM, groups_for, id_and_text, read_documents, read_table,
                                  ship_package, split_words, text_bytes, text_chunks, text_column, text_of)

RATE = 0.2
ROUNDS, SAMPLES = 64, 4
#: Steps of three rounds in four at most: edits before a sample spoil it, so keys of
#: the first words meet more often; every fourth round reads over the shortest item.
NEAR = 48
BLOCK_BYTES = 32 << 20
#: Bytes of text searched at once; some dozen numbers are held for each of its words.
HIT_BYTES = 2 << 20
# read beyond the end of a text, and for a word that no item has
_END, _OTHER = 0x5851F42D4C957F2D, 0x14057B7EF767814F


@dataclass
class ItemClass:
    """Items of similar length with their walks and keys."""
    shortest: int
    ids: list[int]
    words: list[np.ndarray]  # vocabulary ids
    steps: np.ndarray  # rounds x samples, sorted
    salts: np.ndarray  # rounds x steps, odd multipliers for the walk's bits
    reads: np.ndarray  # rounds x samples x items: the words read
    parts: dict[int, tuple]  # per part length: sorted hashes, and where items start and end beside them
    back: "ItemClass | None" = None  # the same for items read backwards


class Vocabulary:
    """Benchmark words as small ids; the last two ids are any other word and
    the end of a text. ``codes`` feed the walk's random bits."""

    def __init__(self, items: list[np.ndarray]):
        self.hashes = np.unique(np.concatenate(items)) if items else np.zeros(0, np.uint64)
        self.other, self.end = len(self.hashes), len(self.hashes) + 1
        self.codes = np.concatenate([self.hashes, np.array([_OTHER, _END], dtype=np.uint64)])
        held = np.bincount(np.concatenate([np.searchsorted(self.hashes, np.unique(w)) for w in items]),
                           minlength=len(self.codes)) if items else np.zeros(2)
        # words of few items; any split would be right, this one makes the filter sharp
        self.rare = (held > 0) & (held <= max(2, len(items) // 20))

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.hashes, hashes)
        place[place == len(self.hashes)] = 0
        return np.where(self.hashes[place] == hashes, place, self.other).astype(np.int32)


def _item_words(texts: list[str]) -> list[np.ndarray]:
    raw = [t.encode("utf-8") for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    words = split_words(np.frombuffer(b"".join(raw), dtype=np.uint8), off, True, NOT_ALNUM)
    return [words.hashes[a:b] for a, b in zip(words.doc[:-1], words.doc[1:])]


def _walk(words: np.ndarray, start: np.ndarray, stop: np.ndarray, steps, salts: np.ndarray, codes: np.ndarray):
    """Yield what walks from ``start`` read at each of the sorted ``steps``; a step's
    salt and a word's code give the random bit. The receiver may send back a mask
    of the walks to go on with."""
    pos, step, end = start.copy(), 0, len(codes) - 1

    def read():
        return np.where(pos < stop, words[np.minimum(pos, len(words) - 1)], end)

    for s in steps:
        while step < s:
            pos = pos + ((codes[read()] * salts[step]) >> np.uint64(63)).astype(np.int64)
            step += 1
        keep = yield read()
        if keep is not None:
            pos, stop = pos[keep], stop[keep]


def _run_hashes(codes: np.ndarray, sizes) -> dict[int, np.ndarray]:
    """Hashes of each ``size`` words in a row, for all ``sizes``."""
    out, acc = {}, codes
    for k in range(1, max(sizes, default=0) + 1):
        if k > 1:
            acc = acc[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[k - 1:]
        if k in sizes:
            out[k] = acc
        if not len(acc):
            break
    return out


def _item_parts(items: list[np.ndarray], codes: np.ndarray, rate: float) -> dict[int, tuple]:
    """Each item's parts, one more than its edits, by length: sorted hashes, then the
    least and greatest distance from a part's first word to an item's first word, and
    to its last word. For a hash that several parts have, the widest ranges."""
    found: dict[int, list[tuple]] = {}
    for words in items:
        n, e = len(words), int(rate * len(words))
        cuts = np.linspace(0, n, e + 2).astype(int)
        for o, stop in zip(cuts.tolist(), cuts[1:].tolist()):
            h = _run_hashes(codes[words[o:stop]], {stop - o})[stop - o][0]
            found.setdefault(stop - o, []).append((h, -o - e, -o + e, n - 1 - o - e, n - 1 - o + e))
    out = {}
    for size, rows in found.items():
        h, *ranges = (np.array(c) for c in zip(*rows))
        order = np.argsort(h, kind="stable")
        head = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0]))
        wide = [f.reduceat(r[order], head) for f, r in zip((np.minimum, np.maximum) * 2, ranges)]
        out[size] = h[order][head], *wide
    return out


_TABLE_BITS = 20


def _part_table(classes: list[ItemClass]) -> dict[int, np.ndarray]:
    """Leading bits of the part hashes of all classes, by length."""
    out: dict[int, np.ndarray] = {}
    for c in classes:
        for size, (hashes, *_) in c.parts.items():
            bits = out.setdefault(size, np.zeros(1 << _TABLE_BITS, dtype=bool))
            bits[hashes >> np.uint64(64 - _TABLE_BITS)] = True
    return out


def _part_places(ids: np.ndarray, vocabulary: Vocabulary, table: dict[int, np.ndarray]) -> dict[int, tuple]:
    """Words at which a part may begin, with their hashes, by length."""
    out = {}
    for size, h in _run_hashes(vocabulary.codes[ids], table).items():
        q = np.flatnonzero(table[size][h >> np.uint64(64 - _TABLE_BITS)])
        out[size] = q, h[q]
    return out


def _beside_parts(places: dict[int, tuple], doc_start: np.ndarray, doc_stop: np.ndarray,
                  cls: ItemClass) -> tuple[np.ndarray, np.ndarray]:
    """Which words may be the first, and which the last, of a window with some part of
    an item at its place, give or take the edits."""
    n = len(doc_start)
    change = np.zeros((2, n + 1), np.int32)
    for size, (hashes, *ranges) in cls.parts.items():
        q, h = places.get(size, (np.zeros(0, np.int64), np.zeros(0, np.uint64)))
        place = np.searchsorted(hashes, h)
        place[place == len(hashes)] = 0
        same = hashes[place] == h
        q, place = q[same], place[same]
        for side in (0, 1):
            lo = np.maximum(q + ranges[2 * side][place], doc_start[q])
            hi = np.minimum(q + ranges[2 * side + 1][place], doc_stop[q] - 1)
            some = lo <= hi
            np.add.at(change[side], lo[some], 1)
            np.add.at(change[side], hi[some] + 1, -1)
    first, last = np.cumsum(change[:, :-1], axis=1) > 0
    return first, last


def _item_class(members: list[tuple[int, np.ndarray]], vocabulary: Vocabulary, rounds: int, samples: int,
                rate: float, rng) -> ItemClass:
    shortest = min(len(w) for _, w in members)
    horizon = 2 * shortest  # a walk reads two steps a word on average
    take = min(samples, horizon)
    # one step in each of equal stretches, the first stretch a short one: most
    # windows are dropped by their first read
    edges = [np.concatenate([[0], np.linspace(min(6, reach - take + 1), reach, take)]).astype(int)
             for reach in (min(horizon, NEAR), horizon)]
    steps = np.stack([rng.integers(edges[r % 4 == 3][:-1], edges[r % 4 == 3][1:]) for r in range(rounds)])
    salts = rng.integers(0, 1 << 63, (rounds, horizon), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flat = np.concatenate([w for _, w in members])
    stop = np.cumsum([len(w) for _, w in members])
    start = stop - np.array([len(w) for _, w in members])
    reads = np.stack([np.stack(list(_walk(flat, start, stop, steps[r], salts[r], vocabulary.codes)))
                      for r in range(rounds)])
    words = [w for _, w in members]
    return ItemClass(shortest, [i for i, _ in members], words, steps, salts, reads,
                     _item_parts(words, vocabulary.codes, rate))


def build_classes(items: list[tuple[int, str]], rounds: int = ROUNDS, samples: int = SAMPLES,
                  seed: int = 11, rate: float = RATE) -> tuple[Vocabulary, list[ItemClass]]:
    by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
    hashed = _item_words([t for _, t in items])
    vocabulary = Vocabulary(hashed)
    for (item_id, _), words in zip(items, map(vocabulary.ids, hashed)):
        if len(words):
            by_size.setdefault(int(len(words)).bit_length(), []).append((item_id, words))
    out = []
    for size, members in sorted(by_size.items()):
        cls = _item_class(members, vocabulary, rounds, samples, rate, np.random.default_rng([seed, size]))
        cls.back = _item_class([(i, w[::-1].copy()) for i, w in members], vocabulary, rounds, samples, rate,
                               np.random.default_rng([seed, size, 1]))
        out.append(cls)
    return vocabulary, out


def _running(flags: np.ndarray, reach: int) -> np.ndarray:
    total = np.zeros(len(flags) + 1 + reach, dtype=np.int32)
    np.cumsum(flags, out=total[1:len(flags) + 1])
    total[len(flags) + 1:] = total[len(flags)]
    return total


def _alive(ids: np.ndarray, vocabulary: Vocabulary, cls: ItemClass, rate: float) -> np.ndarray:
    """Window starts with as many benchmark words, and as many of the benchmark's
    rarer words, as some item within its edits must leave. Words beyond the end
    of the document count too; that only keeps more."""
    need = {}
    for w in cls.words:
        need[len(w)] = min(need.get(len(w), len(w)), int(vocabulary.rare[w].sum()))
    longest = max(need)
    reach = longest + int(rate * longest)
    known = _running(ids != vocabulary.other, reach)
    rare = _running(vocabulary.rare[ids], reach)
    at = len(ids)
    ok = np.zeros(at, dtype=bool)
    for n, r in need.items():
        e = int(rate * n)
        ok |= ((rare[n + e:n + e + at] - rare[:at]) >= r - e) & ((known[n + e:n + e + at] - known[:at]) >= n - e)
    return ok


def _meetings(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, cls: ItemClass,
              vocabulary: Vocabulary) -> set[tuple[int, int]]:
    """(start, item index) pairs whose keys meet in some round."""
    found: set[tuple[int, int]] = set()
    samples = cls.steps.shape[1]
    for r in range(len(cls.steps)):
        walk = _walk(words, starts, stops, cls.steps[r], cls.salts[r], vocabulary.codes)
        at, read = starts, next(walk)
        first = np.zeros(len(vocabulary.codes), dtype=bool)
        first[cls.reads[r, 0]] = True
        keep = first[read]
        at, mine, want = at[keep], read[keep].astype(np.uint64), cls.reads[r, 0].astype(np.uint64)
        for s in range(1, samples):
            if not len(at):
                break
            read = walk.send(keep)
            want, mine = _fold(want, cls.reads[r, s]), _fold(mine, read)
            keep = np.isin(mine, want)
            at, mine = at[keep], mine[keep]
        if len(at):
            order = np.argsort(want, kind="stable")
            lo = np.searchsorted(want[order], mine, side="left")
            hi = np.searchsorted(want[order], mine, side="right")
            for a, x, y in zip(at.tolist(), lo.tolist(), hi.tolist()):
                found.update((a, int(i)) for i in order[x:y])
    return found


def _fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)


def window_distance(item: np.ndarray, text: np.ndarray, limit: int) -> tuple[int, int] | None:
    """Least edit distance of ``item`` to a prefix of ``text``, and the
    shortest such prefix, if within ``limit``."""
    m = min(len(text), len(item) + limit)
    row = np.arange(m + 1)
    shift = np.arange(m + 1)
    for i, w in enumerate(item):
        swap = row[:-1] + (text[:m] != w)
        new = np.empty(m + 1, dtype=np.int64)
        new[0] = i + 1
        new[1:] = np.minimum(swap, row[1:] + 1)
        row = np.minimum.accumulate(new - shift) + shift  # insertions
        if row.min() > limit:
            return None
    best = int(row.min())
    return (best, int(row.argmin())) if best <= limit else None


def _candidates(h: np.ndarray, places: dict[int, tuple], doc_start: np.ndarray, doc_stop: np.ndarray,
                cls: ItemClass, vocabulary: Vocabulary, rate: float) -> set[tuple[int, int]]:
    """(start, item index) of windows that meet an item read forwards, or backwards
    from their last word."""
    first, last = _beside_parts(places, doc_start, doc_stop, cls)
    found: set[tuple[int, int]] = set()
    if first.any():
        starts = np.flatnonzero(first & _alive(h, vocabulary, cls, rate))
        found = _meetings(h, starts, doc_stop[starts], cls, vocabulary)
    if last.any():
        n = len(h)
        turned = np.ascontiguousarray(h[::-1])
        ends = np.flatnonzero(last[::-1] & _alive(turned, vocabulary, cls.back, rate))
        for end, k in _meetings(turned, ends, n - doc_start[n - 1 - ends], cls.back, vocabulary):
            item = cls.back.words[k]
            got = window_distance(item, turned[end:n - doc_start[n - 1 - end]], int(rate * len(item)))
            if got is not None and got[1] > 0:
                found.add((int(n - end - got[1]), k))
    return found


def _hits(texts: pa.Array, vocabulary: Vocabulary, classes: list[ItemClass], rate: float):
    """Yield ``(row, item_id, distance, start, stop, item_words)``: the nearest
    window of each contaminated row and item."""
    table = _part_table(classes)
    for i, _, data, off in text_chunks(texts, HIT_BYTES):
        words = split_words(data, off, True, NOT_ALNUM)
        if not len(words.hashes):
            continue
        h = vocabulary.ids(words.hashes)
        places = _part_places(h, vocabulary, table)
        doc = words.doc_of_word()
        doc_start, doc_stop = words.doc[doc], words.doc[doc + 1]
        best: dict[tuple[int, int], tuple] = {}
        for c in classes:
            for start, k in _candidates(h, places, doc_start, doc_stop, c, vocabulary, rate):
                item = c.words[k]
                got = window_distance(item, h[start:doc_stop[start]], int(rate * len(item)))
                if got is not None and got[1] > 0:
                    d = int(doc[start])
                    first = int(start - words.doc[d])
                    hit = (got[0], first, first + got[1], len(item))
                    best[d, c.ids[k]] = min(best.get((d, c.ids[k]), hit), hit)
        for (d, item_id), hit in sorted(best.items()):
            yield (i + d, item_id, *hit)


def _finder(vocabulary: Vocabulary, classes: list[ItemClass], rate: float):
    def find(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            rows = list(_hits(batch.column(batch.schema.get_field_index("text")), vocabulary, classes, rate))
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(cols[0], pa.int64())), *(pa.array(cols[k], pa.int64()) for k in (1, 3, 4, 2, 5))],
                names=["doc_id", "item_id", "start", "stop", "distance", "item_words"])
    return find


def _cleaner(vocabulary: Vocabulary, classes: list[ItemClass], rate: float, text_col: str):
    def clean(batches):
        for batch in batches:
            good = np.ones(len(batch), dtype=bool)
            for hit in _hits(text_of(batch, text_col), vocabulary, classes, rate):
                good[hit[0]] = False
            yield batch.filter(pa.array(good))
    return clean


def _blocks(benchmark: DataFrame, block_bytes: int, rounds: int, rate: float):
    """The benchmark's items with their walks, in blocks of bounded text."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    blocks = groups_for(text_bytes(items), block_bytes)
    for b in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        vocabulary, classes = build_classes(
            [(r["item_id"], r["text"]) for r in block.orderBy("item_id", "text").collect()], rounds, rate=rate)
        if classes:
            yield vocabulary, classes


def find_contamination(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id",
                       text_col: str = "text", block_bytes: int = BLOCK_BYTES, rounds: int = ROUNDS) -> DataFrame:
    """One row per contaminated document and item: ``doc_id, item_id``, the
    nearest window ``start, stop`` (words, end exclusive), ``distance`` and
    ``item_words``. The earliest of equally near windows is given."""
    spark = docs.sparkSession
    ship_package(spark)
    base = id_and_text(docs, id_col, text_col)
    schema = "doc_id long, item_id long, start long, stop long, distance long, item_words long"
    out = None
    for vocabulary, classes in _blocks(benchmark, block_bytes, rounds, rate):
        part = base.mapInArrow(_finder(vocabulary, classes, rate), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` without the contaminated rows, all columns; no shuffle."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *text_column(docs, text_col))
    for vocabulary, classes in _blocks(benchmark, block_bytes, rounds, rate):
        rows = rows.mapInArrow(_cleaner(vocabulary, classes, rate, text_col), rows.schema)
    return rows.select("row.*")


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_contamination(read_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
