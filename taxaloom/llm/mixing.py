"""Mixing sources to target weights by a time-varying curriculum.

Each source has a target in words (its share of the demand by weight, at most twice its size, the excess reshared) and a
weight schedule over the training run t in [0, 1], here a ramp. The integral of the schedule, scaled to the target, is the
source's cumulative token demand; a document that begins after c words of its source's stream is trained on at the t where
that demand reaches c. Streams run through their source in an order drawn by hash, a second time where the target asks for
more than the source has. Documents are range-sorted by position.

Streams are prefix sums over (source, hash range) blocks, so a source with a third of all rows is no single task's work.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from taxaloom.session import cut

# Weights of the sources in code point order, repeating, and their ramps (weight at the start and the end).
WEIGHTS = (5, 2, 1)
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
TOTAL_SHARE = 1.5
MAX_PASSES = 2
#: Documents of a block of the prefix sums, about; rows of the blocks' table (40 bytes each) up to which it is broadcast.
BLOCK_ROWS, BROADCAST_ROWS = 20_000, 200_000
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target and the ramp (start, end) of each source from (source, source_size).

    The common level per unit of weight is found in one pass: sources ordered by the level at which they fill up, the first
    of them whose fill-up level lies above the level left for the rest ends the full ones. A table of one row a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    pick = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]), F.col("k") + 1)
    named = sizes.withColumn("k", k.cast("int")).select("source", "source_size", pick(WEIGHTS).alias("weight"), pick([r[0] for r in RAMPS]).alias("start"), pick([r[1] for r in RAMPS]).alias("end"))
    cap = named.withColumn("cap", F.col("source_size") * float(MAX_PASSES)).withColumn("fills", F.col("cap") / F.col("weight"))
    before = Window.orderBy("fills", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    left = (F.sum("source_size").over(everyone) * TOTAL_SHARE - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    level = F.min(F.when(F.col("fills") >= F.col("left"), F.struct("fills", "left"))).over(everyone)["left"]
    return cap.withColumn("left", left).withColumn("level", level).select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"), "start", "end")


def position(c: Column, target: Column, start: Column, end: Column) -> Column:
    """The t at which a ramp's demand, target * integral / (whole integral), reaches c."""
    share = F.when(target > 0, c / target).otherwise(F.lit(0.0)) * (start + end) / 2
    slope = end - start
    return F.least(F.lit(1.0), F.abs(F.when(F.abs(slope) < 1e-12, share / start).otherwise((F.sqrt(F.greatest(start * start + 2 * slope * share, F.lit(0.0))) - start) / slope)))


def plan(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", keep: bool = False, split_last: bool = True) -> DataFrame:
    """One row per document: with ``keep`` the whole row as kept, a struct; doc_id, source, size, source_size, target, taken, first, passes.

    taken: words of the document that the mix takes. With ``split_last`` the document in which a stream ends gives only the
    words still asked for; else it is taken whole if at least half of it is asked for. first: position of its first copy,
    null if none is taken. Documents without words take no part (taken 0). Rows that agree in everything keep their own
    places; a null source is a source, sorted last. Other columns are left out or in the struct, so their names can't clash.
    """
    key = F.xxhash64(F.col(doc_id), F.col(text))
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")] if keep else []
    rows = docs.select(*kept, F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size"), key.alias("h"))
    if not keep:
        rows = cut(rows)  # the texts are read once
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sums = cut(sums)
    all_rows, sources = sums.agg(F.sum("rows"), F.count("*")).first()
    blocks = max(1, math.ceil((all_rows or 0) / BLOCK_ROWS))
    # where they are known to be small, so that the texts stay where the window has put them
    near = F.broadcast if blocks * sources <= BROADCAST_ROWS else lambda df: df
    aims = targets(sums.select("source", "source_size"))
    rows = rows.withColumn("block", F.pmod(F.shiftright("h", 8), F.lit(blocks)).cast("int"))
    in_order = Window.partitionBy("source", "block").orderBy("h", F.col("doc_id").asc_nulls_last())
    inside = rows.withColumn("inside", F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    totals = rows.groupBy("source", "block").agg(F.sum("size").alias("n"))
    base = totals.withColumn("base", F.sum("n").over(Window.partitionBy("source").orderBy("block")) - F.col("n")).drop("n")
    base = base.withColumnRenamed("source", "s2").withColumnRenamed("block", "b2")
    same = F.col("source").eqNullSafe(F.col("s2")) & (F.col("block") == F.col("b2"))
    placed = inside.join(near(base), same).drop("s2", "b2").withColumn("at", F.col("base") + F.col("inside"))
    aims = aims.withColumnRenamed("source", "s2")
    placed = placed.join(near(aims), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    whole = F.round("target").cast("long")

    def asked(lap: int) -> Column:
        """Words of the document asked for in a pass."""
        part = F.greatest(F.lit(0), F.least(F.col("size"), whole - F.lit(lap) * F.col("source_size") - F.col("at")))
        return part if split_last else F.when(F.col("size") > 0, F.when(part * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0))).otherwise(F.lit(0))

    laps = F.array(*[F.struct(asked(i).alias("words"), position(F.lit(i) * F.col("source_size") + F.col("at"), F.col("target"), F.col("start"), F.col("end")).alias("t")) for i in range(MAX_PASSES)])
    out = placed.withColumn("passes", F.filter(laps, lambda x: x["words"] > 0))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return out.select(*(["kept"] if keep else []), "doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), taken.alias("taken"), F.get("passes", F.lit(0))["t"].alias("first"), "passes")


def digest(docs: DataFrame) -> DataFrame:
    """The plan by document, range-sorted by the position of the first copy."""
    out = plan(docs).select("doc_id", "size", "source_size", "target", "taken", "first")
    return out.repartitionByRange(F.col("first").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("first").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the training stream, whole documents in the order of their positions, a row for each copy taken."""
    out = plan(docs, keep=True, split_last=False).select("kept", "doc_id", F.explode("passes").alias("taken")).select("kept", "doc_id", "taken.t")
    return out.repartitionByRange("t", "doc_id").sortWithinPartitions("t", "doc_id").select(*[F.col("kept")[c].alias(c) for c in docs.columns])
