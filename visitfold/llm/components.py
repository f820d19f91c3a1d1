"""Connected components of a graph of numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitfold.llm.common import discard, settle


def _state(edges: DataFrame) -> tuple[int, int]:
    """Changes whenever the edges do; sums of hashes are cut to stay in range."""
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31)).alias("mix")
    ).first()
    return row["n"], row["mix"] or 0


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b): root is the smallest node reachable.

    Large-star and small-star steps by turns: each node's larger, then smaller neighbours are
    linked to its smallest one, until stars of depth one are left. Steps are joins and
    partial minima, so a node with very many neighbours is split over tasks; the number of
    rounds grows with the logarithm of the longest path. Every round is a written table.
    """
    edges = settle(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = settle(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
        large = (
            both.join(nearest, "a")
            .where("b > a AND b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
            .where("a <> b")
            .distinct()
        )
        before, edges = edges, settle(small, "links")
        discard(before, nearest)
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
