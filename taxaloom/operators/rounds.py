"""Graph rounds that replace sequential loops."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from taxaloom.session import cut


def greedy_representatives(ranked: DataFrame, pairs: DataFrame, by: list[str]) -> DataFrame:
    """(by, taxon_id, rep): what taking taxa in order of rank gives, each a representative unless an earlier representative is
    its neighbour in ``pairs`` (by, a, b); members go to the earliest. All groups run together, in rounds: whoever has no
    earlier undecided neighbour is a representative, and its neighbours are members."""
    r = lambda s: ranked.select(*by, F.col("taxon_id").alias(s), F.col("rank").alias(f"r{s}"))
    edges = pairs.join(r("a"), [*by, "a"]).join(r("b"), [*by, "b"])
    x = F.col("ra") < F.col("rb")
    down = cut(edges.select(*by, F.when(x, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(x, F.col("ra")).otherwise(F.col("rb")).alias("ru"), F.when(x, F.col("b")).otherwise(F.col("a")).alias("v")).distinct())
    open_, reps = cut(ranked.select(*by, "taxon_id", "rank")), None
    while True:
        node = lambda s: open_.select(*by, F.col("taxon_id").alias(s))
        live = down.join(node("u"), [*by, "u"], "left_semi").join(node("v"), [*by, "v"], "left_semi")
        first = cut(open_.join(live.select(*by, F.col("v").alias("taxon_id")), [*by, "taxon_id"], "left_anti"))
        reps = first if reps is None else reps.unionByName(first)
        covered = live.join(first.select(*by, F.col("taxon_id").alias("u")), [*by, "u"], "left_semi").select(*by, F.col("v").alias("taxon_id"))
        open_ = cut(open_.join(first, [*by, "taxon_id"], "left_anti").join(covered, [*by, "taxon_id"], "left_anti"), open_)
        if open_.isEmpty():
            break
    of = down.join(reps.select(*by, F.col("taxon_id").alias("u")), [*by, "u"], "left_semi").groupBy(*by, F.col("v").alias("taxon_id")).agg(F.min_by("u", "ru").alias("rep"))
    own = reps.select(*by, "taxon_id", F.col("taxon_id").alias("rep"))
    return own.unionByName(of.join(own.select(*by, "taxon_id"), [*by, "taxon_id"], "left_anti").select(*by, "taxon_id", "rep"))
