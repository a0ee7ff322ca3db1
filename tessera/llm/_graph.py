"""Connected components of an edge table, by alternating large and small stars
(Kiveris et al., "Connected Components in MapReduce and Beyond")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)`` (bigint) that is not the
    smallest of its component; ``root`` is that smallest node.  Hubs are never
    gathered: minima are partial aggregates, and AQE splits a hub's join rows.
    Each round is a written table, so no lineage grows."""
    cur = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while (now := _state(cur)) != before:
        before = now
        if not now[0]:
            break
        cur = written(_small_star(written(_large_star(cur), "large-star")), "small-star")
    return cur.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
