"""Connected components of an edge list, as Spark joins.

Alternating large-star and small-star rounds: every node points at the
smallest node it has seen.  A hot centre is aggregated map-side (``min``) and
its edges meet that one row in a join that adaptive execution can split.
Edges are written to the shared folder after each round; the driver only sees
a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (near.where("b > a").join(least, "a")
                .where("b <> m").select(F.col("m").alias("a"), "b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionAll(least.select(F.col("m").alias("a"), "b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b bigint); root: the smallest node reachable.

    Self edges and repeated edges do no harm; an empty edge list gives no rows.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = materialise(edges.distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        edges = materialise(_small_star(_large_star(edges)), "edges")
        now = _mark(edges)
        if now == before:
            break
        before = now
    roots = edges.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(roots)
