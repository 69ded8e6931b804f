"""Connected components by alternating large-star and small-star steps.

Edges never leave Spark: each step groups the edge table by node, keeps the
smallest neighbour, and rewrites the edges towards it. A node with many
neighbours is reduced by a partial ``min`` before the shuffle and joined back;
its neighbours are never listed in one group. Every round is written to the
shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartscope.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return (both.join(least, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (moved.unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct())


def _fingerprint(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` of longs to ``(node, label)``: the smallest node reachable,
    for each node that has an edge. Self edges and repeats do no harm."""
    edges = stage(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    seen = _fingerprint(edges)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        edges = stage(_small_star(_large_star(edges)), "edges")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct())
