"""Numbers for the rows of a table in order, without one task for a group or for the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from taxaloom.session import cut, free_name

#: Rows of the table of offsets (some 40 bytes each) up to which it is broadcast.
BROADCAST_ROWS = 100_000


def numbered(df: DataFrame, by: list[str], order: list[str], pos: str = "pos", total: str | None = None, group: str | None = None) -> DataFrame:
    """``df`` with ``pos``, each row's place from 0 among the rows of equal ``by``, in ``order`` (ascending, nulls first); total: how many
    these are; group: a number of the group, rising with ``by``. Nulls in ``by`` are a group.

    Rows are range-sorted by ``by`` and ``order`` and counted where they lie; a table of one row for each part and group gives
    where each part begins. Which of two rows comes first that agree in all these columns is fixed once they are sorted.
    """
    m, first = free_name(df), free_name(df) + "f"
    keys = [*by, *order]
    laid = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(m, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(m), 33).alias("part")
    runs = cut(laid.groupBy(part, *by).agg(F.min(m).alias(first), F.count("*").alias("n")))
    own = Window.partitionBy(*by)
    base = F.sum("n").over(own.orderBy("part")) - F.col("n")
    extra = ([F.sum("n").over(own).alias(total)] if total else []) + ([F.min(first).over(own).alias(group)] if group else [])
    offsets = runs.select("part", *[F.col(c).alias(f"{m}{i}") for i, c in enumerate(by)], F.col(first), base.alias("base"), *extra)
    same = F.shiftright(laid[m], 33) == F.col("part")
    for i, c in enumerate(by):
        same = same & laid[c].eqNullSafe(F.col(f"{m}{i}"))
    near = F.broadcast(offsets) if runs.count() <= BROADCAST_ROWS else offsets
    return laid.join(near, same).select(*[laid[c] for c in df.columns], (F.col("base") + F.col(m) - F.col(first)).alias(pos), *[c for c in (total, group) if c])
