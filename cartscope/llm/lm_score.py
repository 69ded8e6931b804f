"""Language-model scores from a hashed maximum-entropy model.

Method. The probability of a word given its history is factored into its class
and the word within the class. Classes are the hash of a word's last two
bytes; both factors are maximum-entropy models (softmax) over hashed features
of the history: the previous word, the one before it (a skip feature), and the
pair of both. Within a class the ``HEADS`` most frequent words and "any other"
are outcomes; other words share the latter in proportion to their smoothed
counts. Each text ends with one end token, so the model is a distribution over
texts of any words.

Counts. Word counts cover all training documents. Documents are dealt into
groups of some megabytes; a group sends each distinct word once with its
count, hash buckets add them up and answer each group with the corpus counts
of exactly its words. A frequent word costs one entry a group, and no task or
driver holds the vocabulary.

Training. Distributed gradient updates: each round takes a different share of
the training documents, dealt into shards of about ``TRAIN_BYTES``. A shard
starts from the broadcast weights and Adagrad sums, takes Adagrad steps, and
sends its change of both. Together the rounds read every position of every
training document once. In Spark, block by block, the Adagrad sums are added
up, and a row's changes are averaged by how much each shard added to its sum,
so a shard that never met a row does not hold it back. The average of n equal
shards counts n^SPREAD fold: one shard over all their rows would have gone
about sqrt(n) times as far. There are ``ROUNDS``
rounds and one more for each doubling of the text beyond ``ROUND_BYTES``. The
weights are a fixed number of parameters. Rounds, shards and the order within a
shard follow hashes of id and text, so the model is a function of the rows,
however files and partitions hold them. A shard is read as a stream: rows that
repeat both id and text share one, and it need not fit into memory.

Scoring reads whole texts in sparse numpy batches of positions.

Words are identified by 64-bit hashes (for V distinct words about V^2 / 2^65
pairs are confused).

Documents are numbered as read and stored once; groups are dealt by that number,
so that null or repeated ids spread like others.

Defined results: a null or empty text is the end token alone; without training
documents every count is 0 and the score is the base score; repeated rows are
counted and scored each; a null doc_id trains; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartscope.llm.common import (as_binary, crc_mod, groups_for, id_and_text, mix, read_documents,
                                  ship_package, split_words, stage, text_bytes, text_chunks)

CLASSES, HEADS = 64, 15
ROWS1, ROWS2, ROWS12 = 1 << 12, 1 << 12, 1 << 13
WORD_ROWS = 1 << 13
ROUNDS, BATCH, RATE = 3, 4096, 0.3
ROUND_BYTES = 64 << 20
TRAIN_BYTES = 16 << 20
SPREAD = 0.5
GROUP_BYTES = 8 << 20
BUCKET_BYTES = 24 << 20
DELTA_BLOCKS = 16

_END = np.uint64(0x2545F4914F6CDD1D)
_START = np.uint64(0x9FB21C651E98DF25)
_FOLD = np.arange(256, dtype=np.int64)
_FOLD[65:91] += 32


@dataclass
class Tokens:
    """Tokens of several texts, one end token after each: hashes, classes, and
    for document i the range ``doc[i]:doc[i + 1]``."""
    hashes: np.ndarray
    classes: np.ndarray
    doc: np.ndarray


def tokens_of(data: np.ndarray, off: np.ndarray) -> Tokens:
    words = split_words(data, off, fold_case=True)
    doc = words.doc + np.arange(len(words.doc))
    n = int(doc[-1])
    hashes = np.full(n, _END, dtype=np.uint64)
    classes = np.zeros(n, dtype=np.int64)
    at = np.arange(len(words.hashes)) + words.doc_of_word()
    hashes[at] = words.hashes
    if len(at):
        last = _FOLD[words.data[words.ends - 1]]
        before = np.where(words.ends - words.starts > 1, _FOLD[words.data[np.maximum(words.ends - 2, 0)]], 0)
        classes[at] = ((last * 257 + before + 1) * 2654435761 >> 13) % CLASSES
    return Tokens(hashes, classes, doc)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


# -------------------------------------------------------------------- counts

def _distinct(hashes: np.ndarray, classes: np.ndarray, n: np.ndarray):
    """Distinct hashes, sorted, their classes, and the sums of ``n``."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[head], classes[order][head], (np.add.reduceat(n[order], head) if len(head) else n[:0])


def _group_words(table: pa.Table):
    train = np.array(table.column("train").to_pylist(), dtype=bool)
    parts = []
    for i, j, data, off in text_chunks(table.column("text")):
        t = tokens_of(data, off)
        counted = np.repeat(train[i:j], np.diff(t.doc)).astype(np.int64)
        parts.append(_distinct(t.hashes, t.classes, counted))
    return _distinct(*(np.concatenate(x) for x in zip(*parts)))


def _sender(buckets: int):
    def send(table: pa.Table) -> pa.Table:
        h, c, n = _group_words(table)
        cuts = np.searchsorted(_bucket(h, buckets), np.arange(buckets + 1))  # sorted: buckets follow hashes
        some = [b for b in range(buckets) if cuts[b + 1] > cuts[b]]
        pick = lambda x, kind: as_binary([x[cuts[b]:cuts[b + 1]].astype(kind).tobytes() for b in some])
        gid = table.column("gid")[0].as_py()
        return pa.table({"bucket": pa.array(some, pa.int64()), "gid": pa.array([gid] * len(some), pa.int64()),
                         "hashes": pick(h, "<u8"), "classes": pick(c, "u1"), "counts": pick(n, "<u4")})
    return send


COUNTED = ("gid long, bucket long, counts binary, class int, hash long, n long, tail boolean, total long, kinds long")


def _adder(table: pa.Table) -> pa.Table:
    """Corpus counts of one bucket: an answer for each group, the bucket's most
    frequent words of each class, and the class totals."""
    gids = table.column("gid").to_pylist()
    raw = [np.frombuffer(x, "<u8") for x in table.column("hashes").to_pylist()]
    cls = [np.frombuffer(x, "u1").astype(np.int64) for x in table.column("classes").to_pylist()]
    cnt = [np.frombuffer(x, "<u4").astype(np.int64) for x in table.column("counts").to_pylist()]
    h, c, n = _distinct(np.concatenate(raw), np.concatenate(cls), np.concatenate(cnt))
    bucket = table.column("bucket")[0].as_py()
    rows = [(g, bucket, n[np.searchsorted(h, r)].astype("<u8").tobytes(), None, None, None, None, None, None)
            for g, r in zip(gids, raw)]
    for k in np.unique(c):
        mine = np.flatnonzero((c == k) & (n > 0))
        top = mine[np.lexsort((h[mine], -n[mine]))][:HEADS]
        rows += [(None, bucket, None, int(k), int(h[i].astype(np.int64)), int(n[i]), False, None, None) for i in top]
        rows.append((None, bucket, None, int(k), None, None, True, int(n[mine].sum()), len(mine)))
    cols = list(zip(*rows))
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in COUNTED.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


# --------------------------------------------------------------------- model

@dataclass
class Model:
    total: int  # training tokens
    kinds: int  # distinct training tokens
    head_hash: np.ndarray  # sorted
    head_place: np.ndarray  # outcome within the class
    tail_total: np.ndarray  # per class, without heads
    tail_kinds: np.ndarray
    class_bias: np.ndarray
    word_bias: np.ndarray  # classes x outcomes; -inf where there is no head
    by_class: np.ndarray  # rows x classes
    by_word: np.ndarray  # rows x outcomes

    def place(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.head_hash):
            return np.full(len(hashes), HEADS)
        at = np.searchsorted(self.head_hash, hashes)
        at[at == len(self.head_hash)] = 0
        return np.where(self.head_hash[at] == hashes, self.head_place[at], HEADS)


def _history(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    one = np.concatenate([[_START], t.hashes[:-1]])
    two = np.concatenate([[_START, _START], t.hashes[:-2]]) if len(t.hashes) > 1 else one.copy()
    first = t.doc[:-1]
    one[first] = _START
    two[first] = _START
    second = first + 1
    two[second[second < np.append(first[1:], len(t.hashes))]] = _START
    return one, two


def _features(one: np.ndarray, two: np.ndarray, classes: np.ndarray):
    both = mix(one * np.uint64(3) + two)
    rows = np.stack([(one >> np.uint64(52)).astype(np.int64) & (ROWS1 - 1),
                     ROWS1 + ((two >> np.uint64(40)).astype(np.int64) & (ROWS2 - 1)),
                     ROWS1 + ROWS2 + ((both >> np.uint64(50)).astype(np.int64) & (ROWS12 - 1))])
    k = classes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    words = np.stack([(mix(one + k) >> np.uint64(51)).astype(np.int64) & (WORD_ROWS - 1),
                      WORD_ROWS + ((mix(two * np.uint64(5) + k) >> np.uint64(51)).astype(np.int64) & (WORD_ROWS - 1))])
    return rows, words


def _sums(table: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = table.take(rows[0], axis=0)
    for r in rows[1:]:
        z += table.take(r, axis=0)
    z += bias
    # weights of a row add up to 0, so no row is low throughout
    return np.minimum(z, 60.0, out=z)


def _shares(z: np.ndarray) -> np.ndarray:
    np.exp(z, out=z)
    z *= (1.0 / z.sum(axis=1))[:, None]
    return z


def _forward(m: Model, rows, words, classes):
    return _sums(m.by_class, m.class_bias, rows), _sums(m.by_word, m.word_bias[classes], words)


def _log_share(z: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """log10 of the picked outcomes' shares."""
    mine = z[np.arange(len(z)), pick].astype(np.float64)
    return np.maximum((mine - np.log(np.exp(z, out=z).sum(axis=1, dtype=np.float64))) / np.log(10), -30.0)


def log_probabilities(m: Model, t: Tokens, counts: np.ndarray) -> np.ndarray:
    """log10 of the probability of each token, given its corpus count."""
    out = np.empty(len(t.hashes))
    one, two = _history(t)
    place = m.place(t.hashes)
    rest = (m.tail_total + 0.5 * (m.tail_kinds + 1))[t.classes]
    tail = np.where(place == HEADS, (counts + 0.5) / rest, 1.0)
    for lo in range(0, len(out), BATCH):
        s = slice(lo, lo + BATCH)
        rows, words = _features(one[s], two[s], t.classes[s])
        z, y = _forward(m, rows, words, t.classes[s])
        out[s] = _log_share(z, t.classes[s]) + _log_share(y, place[s])
    return out + np.log10(tail)


#: Rows met more often than this in a batch are added up by a matrix product.
OFTEN = 6


def _update(table: np.ndarray, square: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
    """Adagrad with one step size a row; gradients of equal rows are added first.
    ``rows`` has a line of rows for each kind of feature; kinds share no row."""
    flat = rows.ravel()
    order = np.argsort(flat.astype(np.uint16), kind="stable")  # the tables have under 2^16 rows
    r = flat[order]
    head = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
    times = np.diff(np.append(head, len(r)))
    at = order % rows.shape[1]
    g = grad.take(at[head], axis=0)
    some, k = np.flatnonzero((times > 1) & (times <= OFTEN)), 1
    while len(some):
        g[some] += grad.take(at[head[some] + k], axis=0)
        k += 1
        some = some[times[some] > k]
    often = np.flatnonzero(times > OFTEN)
    if len(often):
        which = np.zeros((len(often), rows.shape[1]), np.float32)
        span = times[often]
        line = np.repeat(np.arange(len(often)), span)
        step = np.arange(len(line)) - np.repeat(np.cumsum(span) - span, span)
        which[line, at[head[often][line] + step]] = 1.0
        g[often] = which @ grad
    r = r[head]
    square[r] += np.einsum("ij,ij->i", g, g)
    g *= (RATE / np.sqrt(square[r] + 1.0))[:, None]
    table[r] -= g


def _learn(m: Model, t: Tokens, state: dict) -> None:
    one, two = _history(t)
    place = m.place(t.hashes)
    for lo in range(0, len(t.hashes), BATCH // 2):
        k = slice(lo, lo + BATCH // 2)
        cls = t.classes[k]
        rows, words = _features(one[k], two[k], cls)
        z, y = _forward(m, rows, words, cls)
        p, q = _shares(z), _shares(y)
        n = np.arange(len(cls))
        p[n, cls] -= 1.0
        q[n, place[k]] -= 1.0
        _update(m.by_class, state["class"], rows, p)
        _update(m.by_word, state["word"], words, q)


CHANGE = "block long, shard long, change binary, gain binary"


def _trainer(m: Model, sums: dict):
    """A shard's change of the model, from its rows ``text, shard`` in their order."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_class, by_word = m.by_class.copy(), m.by_word.copy()
        mine = Model(**{**m.__dict__, "by_class": by_class, "by_word": by_word})
        state = {k: v.copy() for k, v in sums.items()}
        shard = None
        for batch in batches:
            if not len(batch):
                continue
            shard = batch.column(1)[0].as_py()
            for i, j, data, off in text_chunks(batch.column(0)):
                _learn(mine, tokens_of(data, off), state)
        if shard is not None:
            rows = [*zip(np.array_split(by_class - m.by_class, DELTA_BLOCKS),
                         np.array_split(state["class"] - sums["class"], DELTA_BLOCKS)),
                    *zip(np.array_split(by_word - m.by_word, DELTA_BLOCKS),
                         np.array_split(state["word"] - sums["word"], DELTA_BLOCKS))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(rows)), pa.int64()), pa.array([shard] * len(rows), pa.int64()),
                 as_binary([c.astype("<f2").tobytes() for c, _ in rows]),
                 as_binary([g.astype("<f4").tobytes() for _, g in rows])], names=["block", "shard", "change", "gain"])
    return work


def _averager(kind: str, spread: float = 0.0):
    """A block's changes, each row averaged by its gains, times the number of shards
    that met it to the power ``spread``; the gains added up."""
    def average(table: pa.Table) -> pa.Table:
        total, gains, squares = 0.0, 0.0, 0.0
        table = table.sort_by("shard")  # the same sum however the rows arrived
        for raw, gain in zip(table.column("change").to_pylist(), table.column("gain").to_pylist()):
            g = np.frombuffer(gain, "<f4").astype(np.float64)
            total = total + g[:, None] * np.frombuffer(raw, kind).reshape(len(g), -1)
            gains, squares = gains + g, squares + g * g
        shards = np.where(gains > 0, gains * gains / np.where(squares > 0, squares, 1.0), 1.0)
        change = (shards ** spread / np.where(gains > 0, gains, 1.0))[:, None] * total
        return pa.table({"block": table.column("block").slice(0, 1), "shard": table.column("shard").slice(0, 1),
                         "change": as_binary([change.astype("<f4").tobytes()]),
                         "gain": as_binary([gains.astype("<f4").tobytes()])})
    return average


def rounds_for(size: int) -> int:
    return ROUNDS + max(0, (groups_for(size, ROUND_BYTES) - 1).bit_length())


def train(base: DataFrame, stats: DataFrame, rounds: int = ROUNDS, shards: int = 1) -> Model:
    """``base`` has ``doc_id, text, train``; ``stats`` the heads and class totals.
    ``shards`` is their number in a round."""
    totals = {r["class"]: (r["total"], r["kinds"]) for r in stats.filter("tail").groupBy("class")
              .agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds")).collect()}  # a row a class
    w = Window.partitionBy("class").orderBy(F.desc("n"), "hash")
    heads = stats.filter("NOT tail").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= HEADS).collect()
    tail_total, tail_kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, (total, kinds) in totals.items():
        tail_total[k], tail_kinds[k] = total, kinds
    mass = tail_total.copy()
    share = np.zeros((CLASSES, HEADS + 1))
    for r in heads:
        share[r["class"], r["rank"] - 1] = r["n"]
        tail_total[r["class"]] -= r["n"]
        tail_kinds[r["class"]] -= 1
    share[:, HEADS] = tail_total + 0.5 * (tail_kinds + 1)
    with np.errstate(divide="ignore"):
        word_bias = np.log(share / share.sum(axis=1, keepdims=True))
    smoothed = mass + 1.0
    order = sorted(range(len(heads)), key=lambda i: np.int64(heads[i]["hash"]).view(np.uint64))
    model = Model(
        int(mass.sum()), int(sum(k for _, k in totals.values())),
        np.array([np.int64(heads[i]["hash"]) for i in order], dtype=np.int64).view(np.uint64),
        np.array([heads[i]["rank"] - 1 for i in order], dtype=np.int64), tail_total, tail_kinds,
        np.log(smoothed / smoothed.sum()).astype(np.float32), word_bias.astype(np.float32),
        np.zeros((ROWS1 + ROWS2 + ROWS12, CLASSES), np.float32), np.zeros((2 * WORD_ROWS, HEADS + 1), np.float32))
    if model.total == 0:
        return model
    sums = {"class": np.zeros(len(model.by_class), np.float32), "word": np.zeros(len(model.by_word), np.float32)}
    own = F.xxhash64(F.lit("own"), "doc_id", "text")
    for r in range(rounds):
        # each round another share of the documents, together all of them
        part = (base.filter("train")
                .filter(F.pmod(F.xxhash64(F.lit("round"), "doc_id", "text"), F.lit(rounds)) == r)
                .select("text", F.pmod(F.xxhash64(F.lit("shard"), "doc_id", "text"), F.lit(shards)).alias("shard"),
                        own.alias("own"))
                # the groups keep this order
                .repartition(shards, "shard").sortWithinPartitions("shard", "own").drop("own"))
        # a change has the size of the model, however little text made it
        sent = part.groupBy("shard").applyInArrow(_trainer(model, sums), CHANGE)
        # added up in two levels, so that no group gathers the changes of all shards
        some = (sent.withColumn("lane", F.pmod("shard", F.lit(64))).groupBy("block", "lane")
                .applyInArrow(_averager("<f2", SPREAD), CHANGE))
        got = some.groupBy("block").applyInArrow(_averager("<f4", SPREAD), CHANGE).orderBy("block").collect()
        if got:  # 2 * DELTA_BLOCKS rows, the size of the model
            for rows, table, name in ((got[:DELTA_BLOCKS], model.by_class, "class"),
                                      (got[DELTA_BLOCKS:], model.by_word, "word")):
                table += np.concatenate([np.frombuffer(x["change"], "<f4") for x in rows]).reshape(table.shape)
                sums[name] += np.concatenate([np.frombuffer(x["gain"], "<f4") for x in rows])
    return model


# ------------------------------------------------------------------- scoring

RESULT = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scorer(model: Model, buckets: int):
    log_total = np.log10(model.total + 0.5 * (model.kinds + 1))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [tokens_of(data, off) for _, _, data, off in text_chunks(left.column("text"))]
        h, at = np.unique(np.concatenate([t.hashes for t in parts]), return_inverse=True)
        answers = dict(zip(right.column("bucket").to_pylist(), right.column("counts").to_pylist()))
        corpus = (np.concatenate([np.frombuffer(answers[b], "<u8") for b in sorted(answers)]).astype(np.int64)
                  if answers else np.zeros(len(h), np.int64))[at]
        out, done = [], 0
        for t in parts:
            counts = corpus[done:done + len(t.hashes)]
            done += len(t.hashes)
            base = np.log10(counts + 0.5) - log_total
            own = log_probabilities(model, t, counts) if model.total else base
            out.append([np.diff(t.doc), *(np.add.reduceat(x, t.doc[:-1]) for x in ((counts > 0).astype(np.int64), base, own))])
        n, known, base, own = (np.concatenate(x) for x in zip(*out))
        return pa.table({"doc_id": left.column("doc_id"), "train": left.column("train"), "n_tokens": pa.array(n),
                         "n_known": pa.array(known), "train_tokens": pa.array([model.total] * len(n), pa.int64()),
                         "base_score": pa.array(base), "score": pa.array(own)})
    return score


def score(docs: DataFrame, is_training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, ``RESULT``. ``is_training`` is a condition on ``doc_id``."""
    ship_package(docs.sparkSession)
    base = stage(id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
                 .withColumn("train", is_training).withColumn("row", F.monotonically_increasing_id()), "numbered")
    size = text_bytes(base)
    groups, buckets = groups_for(size, GROUP_BYTES), groups_for(size, BUCKET_BYTES)
    dealt = base.select("doc_id", "text", "train", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("gid"))
    sent = dealt.groupBy("gid").applyInArrow(
        _sender(buckets), "bucket long, gid long, hashes binary, classes binary, counts binary")
    counted = stage(sent.groupBy("bucket").applyInArrow(_adder, COUNTED), "counted")
    rounds = rounds_for(size)
    model = train(base, counted.filter("gid IS NULL"), rounds, groups_for(size // rounds, TRAIN_BYTES))
    answers = counted.filter("gid IS NOT NULL").select("gid", "bucket", "counts")
    return dealt.groupBy("gid").cogroup(answers.groupBy("gid")).applyInArrow(_scorer(model, buckets), RESULT)


def op4_lm_score(spark, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 1, F.lit(False))
    found = score(read_documents(spark, sf_dir), ~held_out)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")
