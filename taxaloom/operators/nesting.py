"""Intervals of a tree that lie in each other, by ordered sweeps: no two rows of a tree meet that needn't."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def with_outer(rows: DataFrame, carry: list[str], outer: str = "true") -> DataFrame:
    """rows (tree_id, lo, hi, depth, ...) with level, how many of those chosen by the expression ``outer`` lie around a row, and up, the
    carried columns of the nearest of them (null if there is none).

    Intervals of a tree are apart or in each other; of equal ones the deeper lies in the other. Starts and ends are swept in
    order for the level; the nearest row around one is the last of those a level above it that starts before.
    """
    chosen = F.expr(outer)
    mark = lambda at, kind, depth, by: F.struct(at.alias("at"), F.lit(kind).alias("kind"), depth.alias("depth"), by.alias("by"))
    step = F.when(chosen, 1).otherwise(0)
    swept = rows.withColumn("_swept", F.explode(F.array(mark(F.col("lo"), 0, F.col("depth"), step), mark(F.col("hi"), 1, -F.col("depth"), -step))))
    run = Window.partitionBy("tree_id").orderBy("_swept.at", "_swept.kind", "_swept.depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = swept.withColumn("level", (F.sum("_swept.by").over(run) - step).cast("int")).where("_swept.kind = 0").drop("_swept").withColumn("_chosen", chosen)
    offer = F.struct(F.lit(0).alias("turn"), (F.col("level") + 1).alias("on"))
    ask = F.struct(F.lit(1).alias("turn"), F.col("level").alias("on"))
    both = levels.withColumn("_offer", F.explode(F.when(F.col("_chosen"), F.array(offer, ask)).otherwise(F.array(ask))))
    before = Window.partitionBy("tree_id", "_offer.on").orderBy("lo", "depth", "_offer.turn").rowsBetween(Window.unboundedPreceding, -1)
    near = F.last(F.when(F.col("_offer.turn") == 0, F.struct(*carry)), ignorenulls=True).over(before)
    found = both.withColumn("up", near).where("_offer.turn = 1")
    return found.select(*rows.columns, "level", F.when(F.col("level") > 0, F.col("up")).alias("up"))


def outermost(rows: DataFrame) -> DataFrame:
    """The rows (tree_id, lo, hi, depth, ...) that lie in no other."""
    before = Window.partitionBy("tree_id").orderBy("lo", "depth").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("reach", F.max("hi").over(before)).where("reach is null or reach < lo").drop("reach")


def least_between(values: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (tree_id, a, b, ...; a <= b) with least, the least v of values (tree_id, r, v; r from 1 without gaps) from a to b.

    Minima over stretches of every power of two are kept for each place; an interval is the union of two of them.
    """
    top = asked.agg(F.max(F.col("b") - F.col("a") + 1)).first()[0] or 1
    powers = range(int(top).bit_length())
    by = Window.partitionBy("tree_id").orderBy("r")
    t = values.select("tree_id", "r", F.col("v").alias("m0"))
    for j in powers[1:]:
        t = t.withColumn(f"m{j}", F.least(f"m{j - 1}", F.lead(f"m{j - 1}", 1 << (j - 1)).over(by)))
    table = t.select("tree_id", "r", F.posexplode(F.array(*[F.col(f"m{j}") for j in powers])).alias("j", "m"))
    j = F.floor(F.log2(F.col("b") - F.col("a") + 1) + 1e-9).cast("int")
    q = asked.withColumn("j", j).withColumn("r2", F.expr("b - shiftleft(1, j) + 1"))
    left = table.select("tree_id", F.col("r").alias("a"), "j", F.col("m").alias("left"))
    right = table.select("tree_id", F.col("r").alias("r2"), "j", F.col("m").alias("right"))
    return q.join(left, ["tree_id", "a", "j"]).join(right, ["tree_id", "r2", "j"]).select(*[q[c] for c in asked.columns], F.least("left", "right").alias("least"))
