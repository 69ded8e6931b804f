"""Language identification in two levels.

Method: linear support vector machines on hashed byte n-grams of the
lower-cased letters. The first level decides the language *family*; inside a
family, one machine for each pair of languages separates the close relatives.
Both levels vote one against one. With a family of one language the second
level has nothing to decide.

Training uses a bounded sample of labelled rows: about ``PER_LANGUAGE`` distinct texts of
each language, drawn by a hash of the text (copies of a drawn text count once). The
machines are fitted in one task on that sample; only the weights come to the driver.
Predictions read the whole text of every document, batch by batch.

A prediction is *typical* if the text is as near to the mean of its language as
texts of its length are: the bound is taken from the sample, per power of two of the
length, as a share of the nearness of its least typical texts. So it doesn't depend on
the number of languages; other languages, scripts and letter noise are not typical.
Lengths shorter than any in the sample are always typical.

Defined results: null text or text without a letter is ``und`` with score 0;
without any labelled row everything is ``und``; a language without a known
family is a family of its own; repeated rows and null ids are predicted like
any other; other columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartscope.llm.common import crc_mod, read_documents, ship_package, text_chunks, text_column, text_of

PER_LANGUAGE = 1500
DIM = 2048
STEPS = 120
UNKNOWN = "und"

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "yi", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"), "baltic": ("lt", "lv"), "celtic": ("ga", "cy", "gd", "br"),
    "indic": ("hi", "ur", "bn", "mr", "ne", "pa", "gu"), "turkic": ("tr", "az", "kk", "uz", "ky"),
    "semitic": ("ar", "he", "mt", "am"), "dravidian": ("ta", "te", "kn", "ml"),
}
_FAMILY_OF = {lang: name for name, langs in FAMILIES.items() for lang in langs}

_LETTER = regex.compile(r"\p{L}")
# other bytes than letters become a space
_KEEP = np.full(256, 32, dtype=np.uint8)
for _b in [*range(97, 123), *range(128, 256)]:
    _KEEP[_b] = _b


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang, f"own:{lang}")


def features(text: str) -> np.ndarray:
    """Hashed counts of byte 1-, 2- and 3-grams, square-rooted, of unit length."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    b = _KEEP[raw].astype(np.uint32)
    gap = b == 32
    b = b[~(gap & np.concatenate([[False], gap[:-1]]))] if len(b) else b
    b = np.concatenate([np.array([32], np.uint32), b, np.array([32], np.uint32)])
    out = np.zeros(DIM)
    for code in (b, b[:-1] * np.uint32(257) + b[1:] + np.uint32(70000),
                 (b[:-2] * np.uint32(65599) + b[1:-1]) * np.uint32(257) + b[2:] + np.uint32(9000000)):
        slot = ((code * np.uint32(2654435761)) >> np.uint32(21)).astype(np.int64)
        out += np.bincount(slot, minlength=DIM)
    out = np.sqrt(out)
    norm = np.sqrt((out * out).sum())
    return out / norm if norm else out


def _dot(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.einsum("ij,j->i", x, w)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 20.0, steps: int = STEPS) -> np.ndarray:
    """Squared-hinge linear machine with bias (last weight), by accelerated
    gradient steps; both classes weigh the same. ``y`` is +1 or -1."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * cost
    w = np.zeros(x.shape[1])
    look, t = w, 1.0
    rate = 1.0 / (1.0 + 4.0 * weight.sum())
    for _ in range(steps):
        slack = np.maximum(0.0, 1.0 - y * _dot(x, look))
        grad = look - 2.0 * np.einsum("ij,i->j", x, weight * slack * y)
        new = look - rate * grad
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = new + (t - 1) / t_next * (new - w)
        w, t = new, t_next
    return w


@dataclass
class Machine:
    """One-versus-one vote among classes."""
    classes: list[str]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def shares(self, x: np.ndarray) -> np.ndarray:
        """For each row the share of each class, summing to 1."""
        k = len(self.classes)
        if k == 1:
            return np.ones((len(x), 1))
        votes = np.zeros((len(x), k))
        for (a, b), w in self.pairs.items():
            p = 1.0 / (1.0 + np.exp(-np.clip(3.0 * (_dot(x, w[:-1]) + w[-1]), -30, 30)))
            votes[:, a] += np.log(p + 1e-13)
            votes[:, b] += np.log(1 - p + 1e-13)
        votes = np.exp(votes - votes.max(axis=1, keepdims=True))
        return votes / votes.sum(axis=1, keepdims=True)


def fit_machine(x: np.ndarray, labels: np.ndarray) -> Machine:
    m = Machine(sorted(set(labels.tolist())))
    for a, b in combinations(range(len(m.classes)), 2):
        is_a, is_b = labels == m.classes[a], labels == m.classes[b]
        use = is_a | is_b
        m.pairs[a, b] = fit_svm(x[use], np.where(is_a[use], 1.0, -1.0))
    return m


def _nearness(x: np.ndarray, langs, means: dict[str, np.ndarray]) -> np.ndarray:
    return np.einsum("ij,ij->i", x, np.stack([means[v] for v in langs]))


#: Texts of a length class from which a bound is taken.
LEAST_TEXTS = 30
#: At sf0.01 the least typical labelled texts (one word over and over) are at 0.87 of
#: their class's least typical hundredth, letter noise is at 0.8 and other scripts at 0.2.
SLACK = 0.85


@dataclass
class LanguageModel:
    family: Machine
    languages: dict[str, Machine]
    #: mean of each language, and per length class the least nearness to it
    means: dict[str, np.ndarray] = field(default_factory=dict)
    bounds: dict[int, float] = field(default_factory=dict)

    def typical(self, x: np.ndarray, langs: list[str], sizes: list[int]) -> list[bool]:
        near = _nearness(x, langs, self.means) if langs else []
        out = []
        for c, size in zip(near, sizes):
            known = [k for k in self.bounds if k <= size.bit_length()]
            out.append(not known or bool(c >= self.bounds[max(known)]))
        return out

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        by_family = self.family.shares(x)
        best = by_family.argmax(axis=1)
        score = by_family[np.arange(len(x)), best]
        out = [""] * len(x)
        for f, name in enumerate(self.family.classes):
            rows = np.flatnonzero(best == f)
            if len(rows):
                m = self.languages[name]
                shares = m.shares(x[rows])
                pick = shares.argmax(axis=1)
                score[rows] *= shares[np.arange(len(rows)), pick]
                for r, p in zip(rows, pick):
                    out[r] = m.classes[p]
        return out, score


def _featurize(batches):
    for batch in batches:
        for lo in range(0, len(batch), 256):
            part = batch.slice(lo, 256)
            texts = part.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([features(t).astype("<f2").tobytes() for t in texts], pa.binary())],
                names=["lang", "size", "x"])


def _closeness_bounds(near: np.ndarray, sizes: np.ndarray) -> dict[int, float]:
    """Per length class ``SLACK`` of the nearness that one text in a hundred is below."""
    classes = np.array([int(n).bit_length() for n in sizes])
    return {k: float(SLACK * np.quantile(near[classes == k], 0.01))
            for k in np.unique(classes).tolist() if (classes == k).sum() >= LEAST_TEXTS}


def _fit(table: pa.Table) -> pa.Table:
    """The model of a sample, as bytes."""
    x = np.frombuffer(b"".join(table.column("x").to_pylist()), "<f2").reshape(-1, DIM).astype(np.float32)
    sizes = table.column("size").to_numpy()
    lang = np.array(table.column("lang").to_pylist(), dtype=object)
    # the rows' order is that of the shuffle: the sums below shall not depend on it
    order = np.lexsort((x[:, 1], x[:, 0], sizes, lang.astype(str)))
    x, sizes, lang = x[order], sizes[order], lang[order]
    families = np.array([family_of(v) for v in lang], dtype=object)
    means = {}
    for v in sorted(set(lang)):
        mean = x[lang == v].mean(axis=0, dtype=np.float64)
        means[v] = mean / max(np.sqrt((mean * mean).sum()), 1e-9)
    model = LanguageModel(
        fit_machine(x, families),
        {f: fit_machine(x[families == f], lang[families == f]) for f in sorted(set(families))}, means)
    model.bounds = _closeness_bounds(_nearness(x, lang, means), sizes)
    return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})


def draw_sample(rows: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame | None:
    """Of rows ``lang, text`` with a language and a letter: about ``per_language``
    distinct texts of each language, all of a language that has fewer rows."""
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    rate = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, per_language / n))])
    drawn = (rows.withColumn("key", F.xxhash64("text"))
             .filter(F.pmod("key", F.lit(1_000_000)) < rate[F.col("lang")] * 1_000_000))
    # copies of a text: one a task, then one at all
    return drawn.groupBy("lang", "key").agg(F.min("text").alias("text")).select("lang", "text")


def train(docs: DataFrame, is_training: Column, text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Fit in one task on a bounded sample, see ``draw_sample``."""
    ship_package(docs.sparkSession)
    sample = draw_sample(docs.filter(is_training).select(
        docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text")), per_language)
    if sample is None:
        return None
    got = (sample.mapInArrow(_featurize, "lang string, size long, x binary")
           .groupBy().applyInArrow(_fit, "model binary").first())
    return pickle.loads(bytes(got["model"])) if got else None


def _predictor(model: LanguageModel | None, inside: str | None = None):
    """``inside`` names the text's field in ``row`` where it has no column of its own."""
    def predict(batches):
        for batch in batches:
            texts = text_of(batch, inside)
            lang, score, typical = [], [], []
            for i, j, data, off in text_chunks(texts):
                blob = data.tobytes()
                part = [blob[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])]
                named = [k for k, t in enumerate(part) if model and _LETTER.search(t)]
                got, p, near = [UNKNOWN] * len(part), [0.0] * len(part), [False] * len(part)
                for lo in range(0, len(named), 256):
                    some = named[lo:lo + 256]
                    x = np.stack([features(part[k]) for k in some])
                    ls, ss = model.predict(x)
                    good = model.typical(x, ls, [len(part[k]) for k in some])
                    for k, l, s, g in zip(some, ls, ss, good):
                        got[k], p[k], near[k] = l, float(s), g
                lang += got
                score += p
                typical += near
            rest = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in rest),
                 pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(typical, pa.bool_())],
                names=[*rest, "lang_pred", "score", "typical"])
    return predict


def identify(rows: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """``rows`` with ``lang_pred``, ``score`` and ``typical`` added (columns of these
    names are replaced)."""
    ship_package(rows.sparkSession)
    keep = [c for c in rows.columns if c not in (*dict(ADDED), "__text")]
    return _with_added(rows.select(*keep, rows[text_col].cast("string").alias("__text")), _predictor(model))


ADDED = (("lang_pred", "string"), ("score", "double"), ("typical", "boolean"))


def _with_added(given: DataFrame, predictor) -> DataFrame:
    schema = StructType([f for f in given.schema if f.name != "__text"])
    for name, kind in ADDED:
        schema = schema.add(name, kind)
    return given.mapInArrow(predictor, schema)


def keep_identified(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs``, all columns, without documents in no known language: no letters, or
    a text that is not typical of the language nearest to it. Learns from the rows
    with a language."""
    model = train(docs, F.lit(True), text_col, lang_col)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *text_column(docs, text_col))
    found = _with_added(rows, _predictor(model, text_col))
    if model is None:  # nothing to judge by: only texts without a letter go
        return found.filter(F.col("row")[text_col].rlike(r"\p{L}")).select("row.*")
    return found.filter((F.col("lang_pred") != UNKNOWN) & F.col("typical")).select("row.*")


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    model = train(docs, ~held_out)
    found = identify(docs.select("doc_id", "text"), model).select("doc_id", "lang_pred", "score")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
