"""Toxicity scores by a factorization machine over hashed terms.

Method: a document is the set of its terms (runs of letters, digits and
non-ASCII bytes, lower-cased), hashed into ``2^BITS`` slots. The machine adds
linear weights and pairwise interactions through ``FACTORS`` latent factors,
so that two terms which are harmless apart can be toxic together.

Every hashed term of the sample has a weight and factors, also one that tells
nothing alone. Weights are fitted first, by Newton steps. The factors then start from the leading
eigenvectors of the residuals' pair matrix (the sum over texts of residual times
the products of their terms, diagonal left out), found by multiplying with the
sparse rows, never formed: a random start is a saddle from which a pair among
thousands of terms isn't found. Both then go on together in sparse mini-batches with
Adagrad, for each of ``DECAYS``, and the state with the least loss on a held-back
fifth is kept.

The sample is bounded: of each label at most ``SAMPLE`` rows, the first by a hash of
the id, a repeated id once, weighted back to the true shares, so scores stay
calibrated. It is fitted in one task. Scoring reads every whole text.

Defined results: null or empty texts get the base score of a text without
terms; without labels of both kinds the score is the share of label 1 (0 if
there are no labels); several labels of one doc_id count as the largest;
repeated rows and null ids are scored like any other; other columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartscope.llm.common import (NOT_ALNUM, as_binary, crc_mod, id_and_text, read_documents,
                                  read_table, ship_package, split_words, stage, text_chunks)

BITS, FACTORS = 18, 8
SAMPLE = 4000
EPOCHS, PATIENCE, BATCH = 40, 5, 256
RATE, FACTOR_RATE = 0.1, 0.15
DECAYS = (1e-5, 1e-4, 1e-3)
PULLS = (300.0, 100.0, 30.0, 10.0, 3.0, 1.0)
NEWTON, CONJUGATE = 6, 12
TURNS, START = 12, 0.5
THRESHOLD = 0.3


def term_slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, slot) pairs of the texts, sorted."""
    words = split_words(data, offsets, fold_case=True, separators=NOT_ALNUM)
    slot = (words.hashes >> np.uint64(64 - BITS)).astype(np.int64)
    both = np.unique((words.doc_of_word() << BITS) | slot)
    return both >> BITS, both & ((1 << BITS) - 1)


def _labelled_terms(batches):
    for batch in batches:
        for i, j, data, off in text_chunks(batch.column(batch.schema.get_field_index("text"))):
            doc, slot = term_slots(data, off)
            cuts = np.searchsorted(doc, np.arange(j - i + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)).slice(i, j - i) for c in ("doc_id", "label")]
                + [as_binary([slot[a:b].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])])],
                names=["doc_id", "label", "slots"])


@dataclass
class FactorizationMachine:
    place: np.ndarray  # slot -> feature, -1 for unused
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, doc: np.ndarray, slot: np.ndarray, n_docs: int) -> np.ndarray:
        f = self.place[slot]
        doc, f = doc[f >= 0], f[f >= 0]
        own = self.weights - 0.5 * (self.factors ** 2).sum(axis=1)
        z = self.bias + np.bincount(doc, own[f], minlength=n_docs)
        for v in self.factors.T:
            z += 0.5 * np.bincount(doc, v[f], minlength=n_docs) ** 2
        return _sigmoid(z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Rows:
    """Sparse rows: row i has the features ``feature[cut[i]:cut[i + 1]]``, at least one."""
    cut: np.ndarray
    feature: np.ndarray
    label: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.label)

    def pick(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.cut)[rows]
        cut = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(cut[-1]) + np.repeat(self.cut[rows] - cut[:-1], size)
        return Rows(cut, self.feature[at], self.label[rows], self.weight[rows])

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.cut))


def _logits(x: Rows, bias: float, w: np.ndarray, v: np.ndarray):
    got = v[x.feature]
    sums = np.add.reduceat(got, x.cut[:-1], axis=0)
    own = np.add.reduceat(w[x.feature] - 0.5 * np.einsum("ij,ij->i", got, got), x.cut[:-1])
    return bias + own + 0.5 * np.einsum("ij,ij->i", sums, sums), sums, got


def _loss(x: Rows, state) -> float:
    z = np.clip(_logits(x, *state)[0], -40, 40)
    return float((x.weight * (np.logaddexp(0, z) - x.label * z)).sum() / x.weight.sum())


def _descend(x: Rows, held: Rows, state, decay: tuple[float, float], rng) -> tuple[float, np.ndarray, np.ndarray]:
    """Adagrad over mini-batches; the state with the least loss on ``held``. ``decay``
    pulls weights and factors towards 0."""
    bias, w, v = state[0], state[1].copy(), state[2].copy()
    sb, sw, sv = 1.0, np.full(len(w), 0.1), np.full(v.shape, 0.1)
    pace = min(1.0, 12 * len(x) / x.cut[-1])  # all terms of a text move together
    best, least, late = (bias, w.copy(), v.copy()), _loss(held, state), 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            b = x.pick(rows)
            z, sums, got = _logits(b, bias, w, v)
            err = b.weight * (_sigmoid(z) - b.label)
            each = np.repeat(err, np.diff(b.cut))
            order = np.argsort(b.feature, kind="stable")
            f = b.feature[order]
            head = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
            f = f[head]
            gw = np.add.reduceat(each[order], head) + decay[0] * len(rows) * w[f]
            sw[f] += gw * gw
            w[f] -= pace * RATE * gw / np.sqrt(sw[f])
            if v.shape[1]:
                gv = each[:, None] * (np.repeat(sums, np.diff(b.cut), axis=0) - got)
                gv = np.add.reduceat(gv[order], head, axis=0) + decay[1] * len(rows) * v[f]
                sv[f] += gv * gv
                v[f] -= pace * FACTOR_RATE * gv / np.sqrt(sv[f])
            sb += err.sum() ** 2
            bias -= pace * RATE * err.sum() / np.sqrt(sb)
        loss = _loss(held, (bias, w, v))
        if loss < least - 1e-6:
            best, least, late = (bias, w.copy(), v.copy()), loss, 0
        else:
            late += 1
            if late >= PATIENCE:
                break
    return best


def _fit_weights(x: Rows, held: Rows, bias: float, n: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Weights by Newton steps (conjugate gradients, diagonal preconditioner) under a
    pull towards 0 that falls along ``PULLS`` as long as the loss on ``held`` does. A
    term is pulled less the more its rows of both labels differ in number."""
    row, none = x.row_of(), np.zeros((n, 0))
    n1 = max(x.label.sum(), 1.0)
    n0 = max(len(x) - n1, 1.0)
    with1 = np.bincount(x.feature, x.label[row], minlength=n)
    times = np.bincount(x.feature, minlength=n)
    share = (times + 1) / (len(x) + 2)
    z = (with1 / n1 - (times - with1) / n0) / np.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    ease = 4.0 / (z * z + 0.1)
    theta = np.zeros(n + 1)  # the bias is last and is not pulled
    theta[n] = bias

    def down(u: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(x.feature, u[row], minlength=n), u.sum())

    def logits(t: np.ndarray) -> np.ndarray:
        return np.bincount(row, t[x.feature], minlength=len(x)) + t[n]

    def cost(t: np.ndarray, pull: np.ndarray) -> float:
        z = np.clip(logits(t), -40, 40)
        return float((x.weight * (np.logaddexp(0, z) - x.label * z)).sum() + 0.5 * (pull * t * t).sum())

    best, least = (bias, theta[:n].copy(), none), _loss(held, (bias, theta[:n], none))
    for strength in PULLS:
        pull = np.append(strength * ease, 1e-6)
        for _ in range(NEWTON):
            p = _sigmoid(logits(theta))
            grad = down(x.weight * (p - x.label)) + pull * theta
            bend = x.weight * p * (1 - p)
            diagonal = down(bend) + pull
            step, r = np.zeros(n + 1), -grad
            y = r / diagonal
            d, ry = y, r @ y
            for _ in range(CONJUGATE):
                hd = down(bend * logits(d)) + pull * d
                a = ry / max(d @ hd, 1e-300)
                step, r = step + a * d, r - a * hd
                y = r / diagonal
                ry, old = r @ y, ry
                d = y + ry / max(old, 1e-300) * d
            now, size = cost(theta, pull), 1.0
            while size > 1e-3 and cost(theta + size * step, pull) > now:
                size /= 2
            theta = theta + size * step
            if np.abs(size * step).max() < 1e-2:
                break
        state = (float(theta[n]), theta[:n].copy(), none)
        loss = _loss(held, state)
        if loss >= least:
            break
        best, least = state, loss
    return best


def _leading(x: Rows, err: np.ndarray, scale: np.ndarray, count: int, rng) -> np.ndarray:
    """The ``count`` leading positive eigenvectors, rescaled, of the pair matrix of ``err``."""
    n, row = len(scale), x.row_of()
    own = np.bincount(x.feature, err[row], minlength=n) * scale ** 2

    def times_pairs(q: np.ndarray) -> np.ndarray:
        out = np.empty_like(q)
        for k in range(q.shape[1]):
            r = np.bincount(row, (scale * q[:, k])[x.feature], minlength=len(x)) * err
            out[:, k] = np.bincount(x.feature, r[row], minlength=n) * scale - own * q[:, k]
        return out

    q = np.linalg.qr(rng.normal(size=(n, min(n, 2 * count))))[0]
    for _ in range(TURNS):
        q = np.linalg.qr(times_pairs(q))[0]
    size, turn = np.linalg.eigh(q.T @ times_pairs(q))
    some = np.argsort(-size)[:count]
    some = some[size[some] > 0]
    return (q @ turn[:, some]) * scale[:, None] * np.sqrt(size[some])


def _start_factors(x: Rows, state, factors: int, rng) -> np.ndarray:
    """Leading positive eigenvectors of the residuals' pair matrix: half of them as it
    is, where frequent terms lead, half with every term made equally frequent."""
    n = len(state[1])
    err = x.weight * (x.label - _sigmoid(_logits(x, *state)[0])) / np.diff(x.cut)
    times = np.bincount(x.feature, minlength=n)
    some = times > 2  # terms of one or two rows can't tell a pair
    v, k = rng.normal(0, 0.01, (n, factors)), 0
    for scale in (some * 1.0, some / np.sqrt(np.maximum(times, 1))):
        lead = _leading(x, err, scale, factors // 2, rng)
        for part in lead.T:
            # a single factor changes the logits by START or so
            alone = _logits(x, 0.0, np.zeros(n), part[:, None])[0]
            v[:, k] += part * np.sqrt(START / max(np.sqrt((alone ** 2).mean()), 1e-12))
            k += 1
    return v


def fit_rows(x: Rows, n_features: int, factors: int = FACTORS) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted logistic loss; without factors a linear model."""
    rng = np.random.default_rng(5)
    x.weight = x.weight / x.weight.mean()
    rate = float(np.clip((x.weight * x.label).sum() / x.weight.sum(), 1e-4, 1 - 1e-4))
    turn = rng.permutation(len(x))
    held, rest = x.pick(turn[:len(x) // 5]), x.pick(turn[len(x) // 5:])
    if len(set(held.label)) < 2:  # too few rows to hold any back
        held = rest = x
    state = _fit_weights(rest, held, float(np.log(rate / (1 - rate))), n_features)
    if not factors:
        return state
    start = (state[0], state[1], _start_factors(rest, state, factors, rng))
    found = min((_descend(rest, held, start, (d, d), rng) for d in DECAYS), key=lambda f: _loss(held, f))
    if _loss(held, found) < _loss(held, state):
        return found
    return state[0], state[1], np.zeros((n_features, factors))


def _fit(table: pa.Table) -> pa.Table:
    """The machine of a sample ``label, slots, rows``, as bytes; ``rows`` is how many the label has."""
    label = table.column("label").to_pylist()
    drawn = {k: label.count(k) for k in (0, 1)}
    got = sorted((s, k, n / drawn[k]) for s, k, n in zip(table.column("slots").to_pylist(), label,
                                                         table.column("rows").to_pylist()))  # they arrive in any order
    got = [g for g in got if g[0]]
    model = None
    if got:
        size = np.array([len(g[0]) // 4 for g in got])
        slots = np.frombuffer(b"".join(g[0] for g in got), "<u4")
        used, feature = np.unique(slots, return_inverse=True)
        rows = Rows(np.concatenate([[0], np.cumsum(size)]), feature, np.array([g[1] for g in got], dtype=np.float64),
                    np.array([g[2] for g in got], dtype=np.float64))
        bias, w, v = fit_rows(rows, len(used))
        place = np.full(1 << BITS, -1, dtype=np.int32)
        place[used] = np.arange(len(used))
        model = FactorizationMachine(place, bias, w, v.astype(np.float32))
    return pa.table({"model": as_binary([pickle.dumps(model)])})


def train(docs: DataFrame, labels: DataFrame, is_training: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> FactorizationMachine | float:
    """The machine, or a constant score if the labels can't tell anything.
    ``is_training`` is a condition on ``doc_id``."""
    ship_package(docs.sparkSession)
    marks = (labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
             .filter(is_training & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    # the same plan at every size: the labels are hashed, texts are never sorted
    rows = stage(id_and_text(docs, id_col, text_col).filter(is_training).join(marks.hint("shuffle_hash"), "doc_id")
                 .select("doc_id", "text", "label")
                 .mapInArrow(_labelled_terms, "doc_id long, label int, slots binary"), "labelled")
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return float(n1 > 0)
    # twice the sample by a hash of the id, repeated ids once, then its first rows: what
    # meets in one task follows SAMPLE, not the number of partitions
    key = F.shiftrightunsigned(F.xxhash64("doc_id"), 11)
    first = [rows.filter((F.col("label") == k) & (key < F.lit(int(min(1.0, 2 * SAMPLE / n) * (1 << 53)))))
             .groupBy("doc_id").agg(F.min("slots").alias("slots")).orderBy(key, "doc_id").limit(SAMPLE)
             .select(F.lit(k).alias("label"), "slots", F.lit(n).alias("rows")) for k, n in ((0, n0), (1, n1))]
    got = first[0].unionAll(first[1]).groupBy().applyInArrow(_fit, "model binary").first()
    return (got and pickle.loads(bytes(got["model"]))) or n1 / (n0 + n1)


def _scorer(model):
    def score(batches):
        for batch in batches:
            out = []
            for i, j, data, off in text_chunks(batch.column(batch.schema.get_field_index("text"))):
                out.append(np.full(j - i, model) if isinstance(model, float)
                           else model.score(*term_slots(data, off), j - i))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")),
                 pa.array(np.concatenate(out) if out else np.zeros(0))], names=["doc_id", "score"])
    return score


def score(docs: DataFrame, model: FactorizationMachine | float, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` for every row."""
    ship_package(docs.sparkSession)
    return id_and_text(docs, id_col, text_col).mapInArrow(_scorer(model), "doc_id long, score double")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                     F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
