"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from taxaloom.session import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours move to the least node of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = both.join(least, F.col("u") == F.col("w"))
    moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable, for every node that has an edge. Ends in about log(n) rounds; each
    round's edges are written to the checkpoint folder. Stars keep the number of edges of a hub within that of its nodes."""
    now = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    sign = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = sign(now)
    while before[0]:
        now = cut(_star(_star(now, True), False))
        if (after := sign(now)) == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
