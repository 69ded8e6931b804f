"""Packing documents into fixed-size token sequences by cutting-stock patterns.

Method. Every document becomes ``tokens + [separator]``. It is cut into whole
sequences of ``capacity`` tokens and one remainder; whole sequences have no
padding. The remainders are a cutting-stock problem on their *length
histogram*, lengths rounded up to ``step`` tokens: a linear program over
patterns (multisets of lengths that fit one sequence) solved by column
generation, where an unbounded knapsack dynamic program prices new patterns
from the dual values. The solution is rounded down; what is left is rounded by
bounded knapsacks that fill one sequence after another from the remaining
counts. Patterns are then dealt to documents by their rank within their length
class; rounding up costs less than ``step`` tokens of padding a piece.

Scale. The program sees at most ``capacity / step`` length classes with
counts, whatever the number of documents, so it runs on the driver on bounded
data; its work does not grow with the corpus. Ranks come from windows over
(class, salt) with the number of salts following the input, plus offsets per
(class, salt): a length that a third of all documents have is split over all
salts. The deal from rank to sequence is a table of the classes times the
patterns that hold them, at most some ten thousand entries.

Token ids are those of the tokenizer file ``byte_bpe_50k.json``; the tasks
compute them with the same vocabulary as ranks (``byte_bpe_50k.tiktoken``),
which is several times faster and tested to give the same ids. The text of the
special token is its id, as that tokenizer gives it.

Defined results: a null or empty text is the separator alone; equal rows are
packed each; a null doc_id is packed like any other; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartscope.llm.common import groups_for, id_and_text, read_documents, ship_package, stage

CAPACITY = 1024
#: Width of a length class.
STEP = 4
SEPARATOR = 0
VOCABULARY = "byte_bpe_50k.tiktoken"
# The tokenizer file's special token.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
#: Documents ranked by one task.
DOCS_PER_SALT = 50_000

_ENCODERS: dict[str, object] = {}


def encoder(vocabulary: str = VOCABULARY):
    """The public tokenizer's encoding, loaded once per Python worker. A bare
    file name is one of the public tokenizers, anything else a path."""
    if vocabulary not in _ENCODERS:
        import public_tokenizers
        import tiktoken
        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[vocabulary] = tiktoken.Encoding(
            "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[vocabulary]


def token_ids(text: str, separator: int = SEPARATOR, vocabulary: str = VOCABULARY) -> np.ndarray:
    first, *rest = text.split(SPECIAL) if SPECIAL in text else (text,)
    ids = encoder(vocabulary).encode_ordinary(first)
    for part in rest:
        ids.append(SPECIAL_ID)
        ids.extend(encoder(vocabulary).encode_ordinary(part))
    ids.append(separator)
    return np.array(ids, dtype="<u4")


# ---------------------------------------------------------------- the program

@dataclass
class Pattern:
    """``times`` sequences, each with the lengths ``items`` (length, copies)."""
    items: list[tuple[int, int]]
    times: int


def _price(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern, as copies per length."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    for c in range(int(lengths[0]), capacity + 1):
        fit = np.searchsorted(lengths, c, side="right")
        gain = values[:fit] + best[c - lengths[:fit]]
        k = int(gain.argmax())
        if gain[k] > best[c - 1] + 1e-12:
            best[c], pick[c] = gain[k], k
        else:
            best[c] = best[c - 1]
    copies = np.zeros(len(lengths), dtype=np.int64)
    c = capacity
    while c > 0:
        if pick[c] < 0 or best[c] == best[c - 1]:
            c -= 1
        else:
            copies[pick[c]] += 1
            c -= int(lengths[pick[c]])
    return float(best[capacity]), copies


def _pivot(inverse: np.ndarray, column: np.ndarray, row: int) -> None:
    """The inverse after basis column ``row`` is replaced; ``column`` is the
    new one in terms of the old basis."""
    scaled = inverse[row] / column[row]
    inverse -= column[:, None] * scaled[None, :]
    inverse[row] = scaled


def _first_basis(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Feasible start and its inverse: each length with the longest one that
    fits beside it and is not yet paired; what has no partner is alone, as
    often as it fits."""
    alone = (capacity // lengths).astype(np.float64)
    basis, inverse = np.diag(alone), np.diag(1.0 / alone)
    free = np.ones(len(lengths), dtype=bool)
    for k in range(len(lengths) - 1, -1, -1):
        mates = np.flatnonzero(free[:k] & (lengths[:k] <= capacity - lengths[k]))
        if not free[k] or not len(mates):
            continue
        j = int(mates[-1])
        free[k] = free[j] = False
        rare, other = (k, j) if counts[k] <= counts[j] else (j, k)
        column = np.zeros(len(lengths))
        column[[rare, other]] = 1.0
        basis[:, rare] = column
        _pivot(inverse, (inverse * column).sum(axis=1), rare)
    return basis, inverse


def fractional_patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int,
                        gap: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Revised simplex with priced columns: ``(patterns as columns, sequences of each)``.

    Stops when the dual bound (objective divided by the best price) is within
    ``gap`` of the objective, or after ``rounds`` columns; the solution is
    feasible at any time.
    """
    basis, inverse = _first_basis(lengths, counts, capacity)
    x = np.maximum((inverse * counts).sum(axis=1), 0.0)
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        price, copies = _price(np.maximum(duals, 0.0), lengths, capacity)
        if price <= 1.0 + gap:
            break
        column = (inverse * copies).sum(axis=1)
        up = column > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, column, 1.0), np.inf)
        out = int(ratio.argmin())
        theta = max(ratio[out], 0.0)
        x = np.maximum(x - theta * column, 0.0)
        x[out] = theta
        basis[:, out] = copies
        _pivot(inverse, column, out)
    return basis, x


def _fullest(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """Bounded knapsack with length as value: fills one sequence as far as the
    remaining counts allow, longest lengths first."""
    order = np.argsort(-lengths)
    reach = np.zeros(capacity + 1, dtype=bool)
    reach[0] = True
    taken_at: list[tuple[int, np.ndarray]] = []
    for k in order:
        length, have = int(lengths[k]), int(counts[k])
        before = reach.copy()
        for _ in range(min(have, capacity // length)):
            grown = reach.copy()
            grown[length:] |= reach[:-length]
            if (grown == reach).all():
                break
            reach = grown
        taken_at.append((int(k), before))
        if reach[capacity]:
            break
    c = int(np.flatnonzero(reach)[-1])
    items = []
    for k, before in reversed(taken_at):
        n = 0
        while not before[c]:
            c -= int(lengths[k])
            n += 1
        if n:
            items.append((k, n))
    return items


def cutting_stock(histogram: dict[int, int], capacity: int = CAPACITY, gap: float = 0.002,
                  rounds: int = 1500) -> list[Pattern]:
    """Patterns that together hold every length of the histogram exactly as
    often as it counts. Lengths lie in ``1 .. capacity``."""
    lengths = np.array(sorted(k for k, v in histogram.items() if v > 0), dtype=np.int64)
    if not len(lengths):
        return []
    left = np.array([histogram[int(k)] for k in lengths], dtype=np.int64)
    basis, x = fractional_patterns(lengths, left.astype(np.float64), capacity, gap, rounds)
    out = []

    def use(copies: np.ndarray, times: int) -> None:
        nonlocal left
        out.append(Pattern([(int(lengths[k]), int(copies[k])) for k in np.flatnonzero(copies)], times))
        left = left - copies * times

    for j in range(basis.shape[1]):
        copies = np.rint(basis[:, j]).astype(np.int64)
        times = int(np.floor(x[j] + 1e-6))
        need = copies > 0
        times = min(times, int((left[need] // copies[need]).min())) if need.any() else 0
        if times > 0:
            use(copies, times)
    # what rounding down left over: round up the patterns with the largest
    # fractions while the counts still hold them, then fill sequence by sequence
    for j in np.argsort(-(x - np.floor(x))):
        copies = np.rint(basis[:, j]).astype(np.int64)
        if x[j] - np.floor(x[j]) > 0.05 and (copies <= left).all() \
                and 100 * (copies * lengths).sum() >= 99 * capacity:
            use(copies, 1)
    while left.any():
        some = np.flatnonzero(left)
        items = _fullest(lengths[some], left[some], capacity)
        copies = np.zeros(len(lengths), dtype=np.int64)
        for k, n in items:
            copies[some[k]] = n
        used = copies > 0
        use(copies, int((left[used] // copies[used]).min()))
    return out


# ---------------------------------------------------------------- the operator

def _tokenizer(capacity: int, separator: int, vocabulary: str, with_ids: bool):
    def tokenize(batches):
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                n, crcs, raw = [], [], []
                for text in part.column(1).to_pylist():
                    ids = token_ids(text or "", separator, vocabulary)
                    n.append(len(ids))
                    blob = ids.tobytes()
                    crcs.append([zlib.crc32(blob[k:k + 4 * capacity])
                                 for k in range(0, len(blob), 4 * capacity)])
                    raw.append(blob if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())),
                     pa.array(raw, pa.binary())], names=["doc_id", "doc_tokens", "crcs", "ids"])
    return tokenize


def _dealer(slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
    """From (class, rank) to (sequence, place). ``slots[class]`` has for each
    pattern holding the class: first rank, first sequence, copies in one
    sequence, place of the first copy among the pieces of the sequence."""
    def deal(batches):
        for batch in batches:
            cls, rank = np.asarray(batch.column("cls")), np.asarray(batch.column("rank"))
            seq, place = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for c in np.unique(cls):
                at = np.flatnonzero(cls == c)
                first, base, copies, start = slots[int(c)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                pos = rank[at] - first[k]
                seq[at] = base[k] + pos // copies[k]
                place[at] = start[k] + pos % copies[k]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start", "length", "crc", "doc_tokens", "row")),
                 pa.array(seq), pa.array(place)],
                names=["doc_id", "start", "length", "crc", "doc_tokens", "row", "sequence_id", "place"])
    return deal


def _slots(patterns: list[Pattern]) -> tuple[dict, int]:
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    next_rank: dict[int, int] = {}
    sequence = 0
    for p in patterns:
        place = 0
        for cls, copies in p.items:
            rank = next_rank.get(cls, 0)
            table.setdefault(cls, []).append((rank, sequence, copies, place))
            next_rank[cls] = rank + copies * p.times
            place += copies
        sequence += p.times
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v)) for k, v in table.items()}, sequence


def pack(docs: DataFrame, capacity: int = CAPACITY, separator: int = SEPARATOR,
         vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = False, step: int = STEP) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``, with ``with_ids`` also ``ids`` (binary, little-endian
    unsigned 32-bit)."""
    if capacity % step:
        raise ValueError("step must divide capacity")
    ship_package(docs.sparkSession)
    base = id_and_text(docs, id_col, text_col)
    tokens = base.mapInArrow(_tokenizer(capacity, separator, vocabulary, with_ids),
                             "doc_id long, doc_tokens long, crcs array<long>, ids binary")
    # the row number only tells rows of one doc_id apart; it is stored, not recomputed
    tokens = stage(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    n_docs = tokens.count()
    salts = groups_for(n_docs, DOCS_PER_SALT)
    rem = (F.col("doc_tokens") % capacity).cast("int")
    sized = (tokens.withColumn("salt", F.pmod(F.xxhash64("row", "doc_id"), F.lit(salts)))
             .withColumn("rem", rem).withColumn("cls", F.ceil(rem / step).cast("int"))
             .withColumn("full", F.floor(F.col("doc_tokens") / capacity).cast("long")))

    counts = sized.filter("rem > 0").groupBy("cls", "salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["cls"]: r["n"] for r in counts.groupBy("cls")
                 .agg(F.sum("n").alias("n")).collect()}  # at most capacity / step rows
    slots, packed = _slots(cutting_stock(histogram, capacity // step))

    before = Window.partitionBy("cls").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("cls", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    within = Window.partitionBy("cls", "salt").orderBy("doc_id", "row")
    rest = (sized.filter("rem > 0")
            .withColumn("local", F.row_number().over(within) - 1)
            .join(offsets, ["cls", "salt"])
            .select("doc_id", (F.col("full") * capacity).alias("start"), F.col("rem").cast("long").alias("length"),
                    F.element_at("crcs", -1).alias("crc"), "doc_tokens", "cls",
                    (F.col("local") + F.col("skip")).alias("rank"), "row"))
    placed = rest.mapInArrow(_dealer(slots), "doc_id long, start long, length long, crc long, "
                             "doc_tokens long, row long, sequence_id long, place long")
    left_of = (Window.partitionBy("sequence_id").orderBy("place")  # at most capacity pieces
               .rowsBetween(Window.unboundedPreceding, -1))
    dealt = placed.withColumn("offset", F.coalesce(F.sum("length").over(left_of), F.lit(0))).drop("place")

    whole_counts = sized.filter("full > 0").groupBy("salt").agg(F.sum("full").alias("n"))
    ahead = Window.orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)  # one row per salt
    whole_skip = whole_counts.select("salt", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("skip"))
    run = Window.partitionBy("salt").orderBy("doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    whole = (sized.filter("full > 0")
             .withColumn("local", F.coalesce(F.sum("full").over(run), F.lit(0)))
             .join(whole_skip, "salt")
             .select("doc_id", "doc_tokens", "crcs", "row", (F.col("local") + F.col("skip") + packed).alias("first"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("k"))
             .select("doc_id", (F.col("k") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
                     F.element_at("crcs", (F.col("k") + 1).cast("int")).alias("crc"), "doc_tokens", "row",
                     (F.col("first") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    out = dealt.unionByName(whole).withColumnRenamed("crc", "ids_crc32")
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if not with_ids:
        return out.select(*cols)
    # the ids meet their places at the end, one exchange of them in all
    piece = F.substring("ids", F.col("start").cast("int") * 4 + 1, F.col("length").cast("int") * 4)
    return out.join(tokens.select("row", "ids"), "row").select(*cols, piece.alias("ids"))


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read_documents(spark, sf_dir))
