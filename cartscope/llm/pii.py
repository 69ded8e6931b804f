"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Method. High-recall generators propose spans, which may overlap: the base
kinds (e-mail, IP address, payment card, international phone) with and without
their validity rules, and formats the base kinds do not cover. Each candidate
gets format and context features with few values. Gradient-boosted regression
trees learn from them whether a candidate of that look is valid, and a
threshold per kind is calibrated to a precision, smoothed by a prior; candidates
above it are added to the valid base spans, which always stay. Valid candidates
of ``STRONG_KINDS`` are added whatever the counts and scores.

The labels are the validity rules themselves (check digits, ranges, digit
counts, known top-level domains); the trees do not see them, only format and
context. All candidates of the corpus are counted: features have few values,
so grouping by them leaves at most ``CELLS`` rows, whatever the input. The
trees are fitted on these counts and become column expressions, so nothing but
DataFrame operations touches the data.

Patterns are written with possessive repeats and look-behind so that they match
exactly what the plain patterns match, in linear time and constant stack.

Defined results: a null text is empty; repeated rows are scanned each; a null
doc_id is kept; other columns are ignored. With no candidates, or candidates
of one label only, only strong kinds are added. Positions are code points, end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartscope.llm.common import id_and_text, read_documents
from cartscope.llm.spans import SPAN, count_kind, digest, let, mask

BASE_KINDS = ("email", "ip", "card", "phone")
#: Added formats whose own rule is strong enough alone: check digits, issuing rules, known endings.
STRONG_KINDS = ("email_spelled", "ssn", "iban")
#: Cases of doubt (half of them valid) that a kind's precision starts from.
PRECISION, PRIOR_CASES = 0.97, 2.0
ROUNDS, LEARNING_RATE = 40, 0.3

# Formats, cue words and domain endings.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "email_spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[] ?at ?[)\]] ?[A-Za-z0-9-]{1,63}(?: ?[(\[] ?dot ?[)\]] ?[A-Za-z]{2,10}|\.[A-Za-z]{2,10})",
    "phone_local": r"(?<![0-9+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
}
KINDS = tuple(PATTERNS)
CUES = r"(?i)mail|phone|tel|call|mobile|fax|card|visa|credit|payment|\bip\b|host|address|contact|ssn|social|iban|account"
ENDINGS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu")

#: feature -> number of values; the kind is one of them
FEATURES = {"kind": len(KINDS), "digits": 6, "marks": 4, "cue": 2, "before": 3, "after": 3, "length": 4}
CELLS = int(np.prod(list(FEATURES.values())))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + d - F.when(d > 9, 9).otherwise(0)

    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add)
    return F.when((n >= 13) & (n <= 19), total % 10 == 0).otherwise(F.lit(False))


def _iban(m: Column) -> Column:
    turned = F.concat(F.substring(m, 5, 40), F.substring(m, 1, 4))

    def add(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c >= 65, (acc * 100 + c - 55) % 97).otherwise((acc * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(m)), F.lit(0), add) == 1


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\.", -1), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.coalesce(F.substring(p, -4, 4).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return _luhn(_digits(m))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    if kind == "email_spelled":
        return F.lower(F.regexp_extract(m, r"([A-Za-z]+)[^A-Za-z]*$", 1)).isin(*ENDINGS)
    if kind == "phone_local":
        return _digits(m).rlike("^[2-9][0-9]{2}[2-9]")
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return _iban(m)


def _bin(c: Column, edges: list[int]) -> Column:
    out = F.lit(0)
    for e in edges:
        out = out + F.when(c >= e, 1).otherwise(0)
    return out


def _edge(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")).rlike("[A-Za-z0-9]"), 2).when(
        F.coalesce(c, F.lit("")).rlike("[#$%&*=/_-]"), 1).otherwise(0)


def candidate_spans(text: Column, kind: str) -> Column:
    """All matches of a generator with position, label and features."""
    pattern, rank = PATTERNS[kind], KINDS.index(kind)
    def zipped(z: Column) -> Column:
        n = F.size(z["m"])
        return F.arrays_zip(z["m"].alias("m"), F.slice(z["b"], F.lit(1), n).alias("p"),
                            F.slice(z["b"], F.lit(2), n).alias("q"))

    def located(rows: Column) -> Column:
        starts = F.aggregate(
            rows, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
            lambda a, x: F.struct((a["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"),
                                  F.concat(a["starts"], F.array(a["at"] + F.length(x["p"]))).alias("starts")),
            lambda a: a["starts"])
        return F.arrays_zip(rows.alias("x"), starts.alias("s"))

    def describe(r: Column) -> Column:
        x, start = r["x"], r["s"]
        m = x["m"]
        digits = F.length(_digits(m))
        return F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(m)).alias("stop"),
            F.lit(kind).alias("kind"), F.coalesce(_valid(kind, m), F.lit(False)).alias("ok"),
            F.struct(
                F.lit(rank).alias("kind"), _bin(digits, [1, 9, 13, 16, 20]).alias("digits"),
                _bin(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), [1, 3, 5]).alias("marks"),
                F.when(F.substring(x["p"], -24, 24).rlike(CUES), 1).otherwise(0).alias("cue"),
                _edge(F.substring(x["p"], -1, 1)).alias("before"),
                _edge(F.substring(x["q"], 1, 1)).alias("after"),
                _bin(F.length(m), [8, 15, 25]).alias("length")).alias("f"))

    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                     F.split(text, pattern, -1).alias("b"))
    found = let(let(parts, zipped), lambda rows: F.transform(located(rows), describe))
    return F.when(_may_match(text, kind) & text.rlike(pattern), found)


def _may_match(text: Column, kind: str) -> Column:
    """A cheap condition that every match of the kind's pattern implies."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "email_spelled":
        return F.contains(text, F.lit("(")) | F.contains(text, F.lit("["))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike("[0-9]{2}|[0-9][ .-]")


def _candidates(base: DataFrame) -> DataFrame:
    none = F.filter(candidate_spans(F.lit("1 1"), "card"), lambda s: F.lit(False))  # typed, empty
    return base.select("doc_id", "text", F.concat(
        *[F.coalesce(candidate_spans(F.col("text"), k), none) for k in KINDS]).alias("found"))


# ------------------------------------------------------------------ the trees

@dataclass
class Model:
    """Boosted trees of depth two as (feature, value, left, right) splits:
    inside a leaf of the first split, a second. ``threshold`` by kind rank."""
    bias: float
    trees: list[tuple]
    threshold: dict[int, float]


def _best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    best = (1e-9, -1, 0)
    total = g.sum() ** 2 / (h.sum() + 1.0)
    for f in range(x.shape[1]):
        for v in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= v
            gl, hl = g[left].sum(), h[left].sum()
            gr, hr = g.sum() - gl, h.sum() - hl
            gain = gl ** 2 / (hl + 1.0) + gr ** 2 / (hr + 1.0) - total
            if gain > best[0]:
                best = (float(gain), f, int(v))
    return best


def fit(cells: list[dict], precision: float = PRECISION, prior: float = PRIOR_CASES) -> Model | None:
    """Trees from counted cells (feature values, ``n``, ``pos``)."""
    if not cells:
        return None
    x = np.array([[c[f] for f in FEATURES] for c in cells])
    n = np.array([c["n"] for c in cells], dtype=float)
    pos = np.array([c["pos"] for c in cells], dtype=float)
    rate = pos.sum() / n.sum()
    if rate in (0.0, 1.0):
        return None
    bias = float(np.log(rate / (1 - rate)))
    score = np.full(len(n), bias)
    trees = []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        g, h = pos - n * p, n * p * (1 - p)

        def leaf(m):
            return float(LEARNING_RATE * g[m].sum() / (h[m].sum() + 1.0))

        gain, f, v = _best_split(x, g, h)
        if f < 0:
            break
        sides = []
        for side in (x[:, f] <= v, x[:, f] > v):
            _, f2, v2 = _best_split(x[side], g[side], h[side])
            if f2 < 0:
                sides.append((0, -1, leaf(side), leaf(side)))
            else:
                sides.append((f2, v2, leaf(side & (x[:, f2] <= v2)), leaf(side & (x[:, f2] > v2))))
        trees.append((f, v, *sides))
        for side, (f2, v2, a, b) in zip((x[:, f] <= v, x[:, f] > v), sides):
            score[side] += np.where(x[side, f2] <= v2, a, b)
    threshold = {}
    for k in range(len(KINDS)):
        mine = np.flatnonzero(x[:, 0] == k)
        mine = mine[np.argsort(-score[mine])]
        cn, cp = np.cumsum(n[mine]), np.cumsum(pos[mine])
        good = np.flatnonzero(cp + prior / 2 >= precision * (cn + prior))
        # the cut may not fall between cells of one score
        good = [i for i in good if i + 1 == len(mine) or score[mine[i + 1]] < score[mine[i]]]
        if good:
            threshold[k] = float(score[mine[good[-1]]])
    return Model(bias, trees, threshold)


def score_column(model: Model, f: Column) -> Column:
    names = list(FEATURES)
    out = F.lit(model.bias)
    for first, v, left, right in model.trees:
        def side(s):
            return F.when(f[names[s[0]]] <= s[1], s[2]).otherwise(s[3])
        out = out + F.when(f[names[first]] <= v, side(left)).otherwise(side(right))
    return out


def train(found: DataFrame) -> Model | None:
    cells = (found.select(F.explode("found").alias("c")).groupBy("c.f")
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c.ok").cast("long")).alias("pos"))
             .select("f.*", "n", "pos").collect())  # at most CELLS rows
    return fit([r.asDict() for r in cells])


# ---------------------------------------------------------------- the operator

def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``text`` (never null), ``spans``
    (valid base spans and those the trees add, by kind, then start). A span the
    trees add from a base generator has the kind ``<kind>_like``."""
    base = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    found = _candidates(base)
    model = train(found)
    valid = F.filter("found", lambda s: (s["rank"] < len(BASE_KINDS)) & s["ok"])
    strong = lambda s: s["ok"] & s["kind"].isin(*STRONG_KINDS)
    if model is None or not model.threshold:
        added = F.filter("found", strong)
    else:
        cut = F.create_map(*[F.lit(x) for kv in model.threshold.items() for x in kv])
        added = F.filter("found", lambda s: strong(s) | (
            (~s["ok"] | (s["rank"] >= len(BASE_KINDS)))
            & F.coalesce(score_column(model, s["f"]) >= cut[s["rank"]] - 1e-9, F.lit(False))))
    def plain(c: Column, mark: str = "") -> Column:
        return F.transform(c, lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"),
            F.when(s["rank"] < len(BASE_KINDS), F.concat(s["kind"], F.lit(mark)))
            .otherwise(s["kind"]).alias("kind"))).cast(SPAN)

    both = found.select("doc_id", "text", plain(valid).alias("valid"), plain(added, "_like").alias("added"))
    free = F.filter("added", lambda a: ~F.exists("valid", lambda v: (v["start"] < a["stop"]) & (a["start"] < v["stop"])))
    by_kind = F.transform(F.array_sort(F.transform(F.concat("valid", free), lambda s: F.struct(
        s["rank"].alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"),
                           s["kind"].alias("kind"))).cast(SPAN)
    return both.select("doc_id", "text", by_kind.alias("spans"))


def redact(docs: DataFrame, token: str = "[PII]") -> DataFrame:
    found = find(docs)
    return found.select("doc_id", mask(F.col("text"), F.array_sort("spans"), token).alias("text"), "spans")


def op10_pii(spark, sf_dir: str) -> DataFrame:
    found = find(read_documents(spark, sf_dir))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: F.array_contains(F.array(*map(F.lit, BASE_KINDS)), s["kind"]))
    return found.select(
        "doc_id", *[count_kind(base, k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(digest(base).cast("binary"), 256).alias("base_sha256"), digest(spans).alias("spans"))
