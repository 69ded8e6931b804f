"""Secret scanning through a trigram inverted index.

Method: every rule's pattern is turned into a Boolean query over trigrams that
any match must contain (an AND of clauses, a clause an OR of literals, a
literal the AND of its trigrams). The index lists, for each trigram the rules
ask for, the documents that have it; intersecting these postings by the
queries leaves candidates, and only those are scanned with the pattern. A rule
without a mandatory trigram (runs of hex digits) scans every text.

Everything on the way is a DataFrame operation. Postings are grouped by
document, not by trigram, so a trigram that most documents have is no hot key;
text meets candidates in a shuffled hash join whose build side has at most one
row per document, without text.

Defined results: a null text is empty; repeated rows are scanned each; a null
doc_id is kept; other columns are ignored. Positions are code points, end
exclusive; spans of one kind do not overlap, spans of different kinds may.
"""

from __future__ import annotations

import re._constants as ops
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartscope.llm.common import read_documents
from cartscope.llm.spans import SPAN, count_kind, digest, let, mask, match_spans, no_spans


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    ignore_case: bool = False
    #: least length of capture group 1, for matches to drop after matching
    group_min: int = 0

    def java(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


# The base rules, then formats of well-known credentials.
# The runs with a bound ({20,}, {24,}) match exactly the longer runs.
RULES = (
    Rule("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         ignore_case=True, group_min=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("slack", r"(?:xoxa|xoxb|xoxp|xoxr|xoxs)-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
)
BASE_KINDS = ("assign", "access", "hex")

MAX_LITERALS = 64


# ------------------------------------------------------- queries from patterns

def _join(left: set[str], right: set[str]) -> set[str] | None:
    out = {a + b for a in left for b in right}
    return out if len(out) <= MAX_LITERALS else None


def _exact(op, arg) -> set[str] | None:
    """All strings a node matches, if they are few; else None."""
    if op is ops.LITERAL:
        return {chr(arg).lower()}
    if op is ops.IN:
        if all(o is ops.LITERAL for o, _ in arg) and len(arg) <= 4:
            return {chr(a).lower() for _, a in arg}
        return None
    if op is ops.SUBPATTERN:
        return _exact_sequence(arg[-1])
    if op is ops.BRANCH:
        parts = [_exact_sequence(x) for x in arg[1]]
        if any(p is None for p in parts):
            return None
        return set().union(*parts)
    if op is ops.MAX_REPEAT and arg[1] != ops.MAXREPEAT and arg[1] <= 3:
        once = _exact_sequence(arg[2])
        if once is None:
            return None
        out, power = (set() if arg[0] else {""}), {""}
        for k in range(1, arg[1] + 1):
            power = _join(power, once)
            if power is None:
                return None
            if k >= arg[0]:
                out |= power
        return out if len(out) <= MAX_LITERALS else None
    return None


def _exact_sequence(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        part = _exact(op, arg)
        out = _join(out, part) if part is not None else None
        if out is None:
            return None
    return out


def _clauses(nodes) -> list[set[str]]:
    """Clauses every match satisfies: it contains one of the literals of each."""
    found: list[set[str]] = []
    run: set[str] = {""}

    def flush() -> None:
        nonlocal run
        if run and min(map(len, run)) >= 3:
            found.append(run)
        run = {""}

    for op, arg in nodes:
        part = _exact(op, arg)
        grown = _join(run, part) if part is not None else None
        if grown is not None:
            run = grown
            continue
        flush()
        if part is not None:
            run = part
        elif op is ops.SUBPATTERN:
            found += _clauses(arg[-1])
        elif op is ops.MAX_REPEAT and arg[0] >= 1:
            found += _clauses(arg[2])
    flush()
    return found


def trigram_query(pattern: str) -> list[dict[str, list[str]]]:
    """Clauses of a pattern, each a map from literal to its distinct trigrams;
    empty for a pattern without mandatory trigrams. Trigrams are lower-case."""
    return [{s: sorted({s[i:i + 3] for i in range(len(s) - 2)}) for s in sorted(clause)}
            for clause in _clauses(parser.parse(pattern))]


# ---------------------------------------------------------------- the operator

def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def postings(base: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index over the trigrams asked for: ``(trigram, key)``."""
    held = let(F.lower("text"), lambda low: F.filter(
        F.array(*map(F.lit, trigrams)), lambda t: F.contains(low, t)))
    return base.select(_key().alias("key"), F.explode(held).alias("trigram"))


def candidates(base: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(key, rules)``: which indexed rules may match which document."""
    wanted = [(r.kind, c, literal, t, len(grams))
              for r in rules for c, clause in enumerate(trigram_query(r.pattern))
              for literal, grams in clause.items() for t in grams]
    spark = base.sparkSession
    # bounded by the rules, not by the data
    asked = F.broadcast(spark.createDataFrame(wanted, "rule string, clause int, literal string, trigram string, need int"))
    clauses = {r.kind: len(trigram_query(r.pattern)) for r in rules}
    index = postings(base, sorted({w[3] for w in wanted})).distinct()
    literals = (index.join(asked, "trigram").groupBy("key", "rule", "clause", "literal")
                .agg(F.count(F.lit(1)).alias("have"), F.first("need").alias("need")).filter("have = need"))
    met = literals.groupBy("key", "rule").agg(F.count_distinct("clause").alias("met"))
    need = F.create_map(*[F.lit(x) for kv in clauses.items() for x in kv])
    return (met.filter(F.col("met") == need[F.col("rule")])
            .groupBy("key").agg(F.collect_set("rule").alias("rules")))  # at most one entry a rule


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``text`` (never null), ``spans`` (all
    rules, by start, then rule order), ``row`` (the document's own columns)."""
    row = F.struct(*[docs[c] for c in docs.columns])
    base = docs.select(row.alias("row"), docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    rank = {r.kind: k for k, r in enumerate(rules)}

    def spans_of(r: Rule) -> Column:
        keep = ("group", lambda g: F.length(g) >= r.group_min) if r.group_min else None
        return match_spans(text, r.java(), r.kind, rank[r.kind], keep)

    full = [spans_of(r) for r in rules if r not in indexed]
    scanned = base.select("row", "doc_id", "text", _key().alias("key"),
                          (F.concat(*full) if full else no_spans()).alias("full"))
    if indexed:
        scanned = scanned.join(candidates(base, indexed).hint("shuffle_hash"), "key", "left")
    else:
        scanned = scanned.withColumn("rules", F.array().cast("array<string>"))
    some = [F.when(F.array_contains("rules", r.kind), spans_of(r)).otherwise(no_spans()) for r in indexed]
    return scanned.select("row", "doc_id", "text", F.array_sort(F.concat(F.col("full").cast(SPAN), *some)).alias("spans"))


def redact(docs: DataFrame, token: str = "[SECRET]", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with every secret in the text replaced by
    ``token``; ``n_chars``, if there, counts the new text."""
    found = scan(docs, id_col=id_col, text_col=text_col)
    hit = F.size("spans") > 0
    masked = mask(F.col("text"), F.col("spans"), token)
    cols = []
    for c in docs.columns:
        own = F.col("row")[c]
        if c == text_col:
            own = F.when(hit, masked).otherwise(own)
        elif c == "n_chars":
            own = F.when(hit, F.length(masked).cast(docs.schema[c].dataType)).otherwise(own)
        cols.append(own.alias(c))
    return found.select(*cols)


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(read_documents(spark, sf_dir))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["rank"] < len(BASE_KINDS))
    return found.drop("row").select(
        "doc_id", *[count_kind(spans, k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(digest(base).cast("binary"), 256).alias("base_sha256"), digest(spans).alias("spans"))


def _oracle() -> str:
    parts = []
    for rank, r in enumerate(RULES):
        p = r.java().replace("'", "''")
        keep = f"WHERE length(g) >= {r.group_min}" if r.group_min else ""
        parts.append(f"""
  SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, pos AS start, pos + length(m) AS stop FROM (
    SELECT doc_id, m[i] AS m, g[i] AS g,
           coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)
           + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS pos
    FROM (SELECT doc_id, m, g, p, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(t, '{p}') AS m,
             regexp_extract_all(t, '{p}', {1 if r.group_min else 0}) AS g,
             string_split_regex(t, '{p}') AS p FROM docs))) {keep}""")
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)
    names = ", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in BASE_KINDS)
    one = "kind || ':' || start::BIGINT || ':' || stop::BIGINT"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({' UNION ALL '.join(parts)}),
per AS (
  SELECT doc_id, {counts},
         string_agg({one}, ',' ORDER BY start, rank) FILTER (rank < {len(BASE_KINDS)}) AS base,
         string_agg({one}, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, {names}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN per USING (doc_id)
"""


ORACLE_SQL = _oracle()
