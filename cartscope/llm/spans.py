"""Match positions and masking with column functions only.

Spark can list the matches of a pattern but not where they are. The text split
by the same pattern has the pieces between the matches, so the running length
of pieces and matches gives each position, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,rank:int,stop:int,kind:string>>"


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once a row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def no_spans() -> Column:
    return F.array().cast(SPAN)


def match_spans(text: Column, pattern: str, kind: str, rank: int, keep=None) -> Column:
    """All leftmost, non-overlapping matches as ``SPAN``. ``keep`` is a
    predicate on ``(match, group)``, where group is capture group 1 if the
    pattern has one that matters, else the match."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    grouped = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if keep and keep[0] == "group" else whole
    # one piece more than matches: the rest of the text has no match after it
    pairs = F.filter(F.arrays_zip(whole.alias("m"), between.alias("p"), grouped.alias("g")),
                     lambda x: x["m"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), no_spans().alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["p"])
        end = begin + F.length(x["m"])
        span = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("stop"),
                                F.lit(kind).alias("kind"))).cast(SPAN)
        good = keep[1](x["g"]) if keep else F.lit(True)
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), found).otherwise(no_spans())


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def mask(text: Column, spans: Column, token: str) -> Column:
    """``text`` with each stretch covered by spans (sorted by start) replaced
    by ``token``; overlapping spans count once."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(token))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"),
                        F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    masked = F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.greatest(F.length(text) - acc["at"], F.lit(0)))))
    return F.when(F.size(spans) > 0, masked).otherwise(text)
