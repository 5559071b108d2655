"""Connected components by alternating large-star and small-star steps (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.scratch import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least.hint("merge"), "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("u", "m"))


def _mark(edges: DataFrame) -> tuple:
    """Order-free checksum of an edge set."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node on an edge; ``component`` is the least node reachable.

    ``src`` and ``dst`` share one orderable type. Self loops name an isolated node. Nulls are ignored.
    Only aggregates with map-side combine and sort-merge joins that AQE can split are used, so a hub node
    does not end up in one task and no side goes through the driver. Each round is written to the shared folder.
    """
    named = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    base = settle(named.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    now, mark = base.where("a <> b"), None
    for _ in range(max_rounds):
        now = settle(_small_star(_large_star(now)).where("a <> b").distinct())
        seen, mark = mark, _mark(now)
        if mark == seen:
            break
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select("b").union(base.where("a = b").select("b")).distinct()
    lone = roots.join(stars.select(F.col("node").alias("b")).hint("merge"), "b", "left_anti")
    return stars.union(lone.select(F.col("b").alias("node"), F.col("b").alias("component")))
