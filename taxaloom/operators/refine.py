"""Recursive splitting of clusters whose own alignment is poor: level by level, all clusters of a depth and all attempts together."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from taxaloom.operators import clusters as cl, partitions as pt
from taxaloom.operators.alignment import SPLIT_MAX_EXPANSION, SPLIT_MAX_GAP, gap_stats, needs_split, strip_gap_columns
from taxaloom.operators.numbering import numbered
from taxaloom.session import cut

#: Fixed value: numbers of clusters that are tried for embeddings.
PLM_KS = (2, 3, 4, 5)
#: Between the representatives of a path; no id holds it.
STEP = "\x01"

#: (cluster, taxon_id) -> (cluster, alphabet, gap_fraction, expansion), where it could be aligned
Measure = Callable[[DataFrame], DataFrame]
#: (cluster, taxon_id), (cluster, threshold) -> (cluster, attempt, threshold, taxon_id, rep, score) of all attempts
Splitter = Callable[[DataFrame, DataFrame], DataFrame]


class Refinement(NamedTuple):
    clusters: DataFrame  # name, parent, rep, size, depth, threshold, outcome, gap_fraction, expansion, kept_because; split ones too
    members: DataFrame  # name, taxon_id of the clusters that are kept
    log: DataFrame  # name, size, depth, reason, threshold, to_threshold, sub_clusters, kept, outcome, attempts


def measured_on(aln: DataFrame) -> Measure:
    """Statistics of each cluster's rows of an alignment (taxon_id, alphabet, row, ord), without the columns that are gaps in all of them."""

    def measure(members: DataFrame) -> DataFrame:
        by = ["cluster", "alphabet"]
        return gap_stats(strip_gap_columns(aln.select("taxon_id", "alphabet", "row", "ord").join(members, "taxon_id"), by), by)

    return measure


def by_pairs(pairs: DataFrame, kind: str, coverage: float = 0.0, attempts: int = pt.MAX_ATTEMPTS) -> Splitter:
    """Set cover of the pairs (a, b, score, coverage) inside each cluster, at the thresholds of its schedule."""

    def split(members: DataFrame, at: DataFrame) -> DataFrame:
        plan = pt.schedule(at.select(F.lit(kind).alias("kind"), "threshold").distinct(), attempts).select("threshold", F.posexplode("schedule").alias("attempt", "tried"))
        tries = cut(at.join(F.broadcast(plan), "threshold").select("cluster", "attempt", F.col("tried").alias("threshold")))
        inside = pairs.where((F.col("a") != F.col("b")) & (F.coalesce("coverage", F.lit(1.0)) >= coverage)).join(members.withColumnRenamed("taxon_id", "a"), "a").join(members.withColumnRenamed("taxon_id", "b"), ["b", "cluster"])
        near = (F.col("score") <= F.col("threshold")) if kind == "evalue" else (F.col("score") >= F.col("threshold"))
        by = ["cluster", "attempt"]
        edges = cut(inside.join(tries, "cluster").where(near).select(*by, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        found = cl.set_cover(edges, members.join(tries.select(*by), "cluster"), by)
        return found.join(tries, by).withColumn("score", F.lit(None).cast("double"))

    return split


def by_kmeans(vectors: DataFrame, ks: tuple[int, ...] = PLM_KS) -> Splitter:
    """k-means of the unit vectors (taxon_id, vec) of each cluster for every k below its size, scored by cosine silhouette. Representatives
    are medoids. Members have vectors (align_spaces)."""

    def split(members: DataFrame, at: DataFrame) -> DataFrame:
        points = cut(members.join(at.select("cluster"), "cluster", "left_semi").join(vectors.select("taxon_id", pt.unit(F.col("vec")).alias("vec")), "taxon_id"))
        labels = cut(cl.grouped_kmeans(points, ["cluster"], ks))
        placed, by = labels.join(points, ["cluster", "taxon_id"]), ("cluster", "k")
        reps = pt.medoids(placed, by).select(*by, "label", "rep")
        score = pt.silhouette(placed, by).select(*by, F.col("silhouette").alias("score"))
        each = labels.join(reps, [*by, "label"]).join(score, list(by), "left")
        return each.select("cluster", F.col("k").cast("int").alias("attempt"), F.col("k").cast("double").alias("threshold"), "taxon_id", "rep", "score")

    return split


def _tag(kind: str, threshold: float) -> Column:
    """cluster_<n>_ is followed by the kind's sign and the threshold, in as few digits as it needs."""
    known = sorted({*(t for g in pt.GRIDS.values() for t in g), *pt.EVALUE_STEPS, *map(float, PLM_KS), float(threshold)})
    return F.concat(F.lit(pt.TAGS.get(kind, "t")), F.create_map(*[F.lit(x) for t in known for x in (t, f"{t:g}")])[F.col("threshold")])


def recursive_refine(members: DataFrame, measure: Measure, splitter: Splitter, kind: str, threshold: float, recursion: bool = True, min_size: int = pt.MIN_SIZE, max_depth: int = 2, both: bool = False, best: bool = False, max_gap: float = SPLIT_MAX_GAP, max_expansion: float = SPLIT_MAX_EXPANSION, least: float = pt.RECURSE_MIN_KEPT) -> Refinement:
    """The partition (taxon_id, rep) with its poorly aligned clusters split, and the log of all splits tried.

    A cluster of at least 2 * max(2, min_size) whose alignment is over the limits is split at the first attempt, or with ``best``
    the attempt of highest score, that gives several clusters and keeps ``least`` of it in clusters of tree size; where none
    does it stays whole (not_divisible). All clusters of a depth are measured together, and their attempts made together, so
    that there are as many rounds as depths, whatever the number of clusters. Numbers follow the tree, each cluster before
    its parts, larger ones first; a split cluster keeps its own, so that none is used twice.
    """
    first = F.struct((-F.col("size")).alias("minus"), "rep")
    start = members.groupBy("rep").agg(F.count("*").alias("size"))
    frontier = cut(start.select(F.col("rep").alias("cluster"), F.lit(None).cast("string").alias("up"), "rep", "size", F.lit(float(threshold)).alias("threshold"), F.array(first).alias("path")))
    inside = cut(members.select(F.col("rep").alias("cluster"), "taxon_id"))
    done, kept, logs = [], [], []
    for depth in range(max_depth + 1):
        stats = cut(measure(inside))
        own = stats.where(F.col("alphabet") == "3di").select("cluster", "gap_fraction", "expansion")
        poor = needs_split(stats, ["cluster"], both, max_gap, max_expansion)
        judged = cut(frontier.join(own, "cluster", "left").join(poor, "cluster", "left").withColumn("depth", F.lit(depth)))
        todo = judged.where(F.col("split") & (F.col("size") >= 2 * max(2, min_size)))
        if not recursion or depth == max_depth or todo.isEmpty():
            done.append(judged.select(*judged.columns, F.lit("kept").alias("outcome")))
            kept.append(inside)
            break
        tried = cut(splitter(inside.join(todo.select("cluster"), "cluster", "left_semi"), todo.select("cluster", "threshold")))
        subs = cut(tried.groupBy("cluster", "attempt", F.col("threshold").alias("to_threshold"), "rep").agg(F.count("*").alias("n"), F.max("score").alias("score")))
        each = subs.groupBy("cluster", "attempt", "to_threshold").agg(F.count("*").alias("sub_clusters"), F.coalesce(F.sum(F.when(F.col("n") >= pt.TREE_MIN_TAXA, F.col("n"))), F.lit(0)).alias("in_trees"), F.max("score").alias("score"))
        each = each.join(todo.select("cluster", "size"), "cluster").withColumn("kept", F.col("in_trees") / F.col("size"))
        fine = (F.col("sub_clusters") > 1) & (F.col("kept") >= least)
        order = Window.partitionBy("cluster").orderBy(F.desc("fine"), *([F.coalesce("score", F.lit(0.0)).desc()] if best else []), "attempt")
        ranked = cut(each.withColumn("fine", fine).withColumn("place", F.row_number().over(order)))
        taken = ranked.where("fine and place = 1").select("cluster", F.col("attempt").alias("taken"), "to_threshold", "sub_clusters", "kept")
        shown = ranked.join(taken.select("cluster", "taken"), "cluster", "left").where(F.lit(best) | F.col("taken").isNull() | (F.col("attempt") <= F.col("taken")))
        one = F.struct("attempt", F.col("to_threshold").alias("threshold"), "sub_clusters", F.round("kept", 3).alias("kept"), F.round("score", 4).alias("score"))
        notes = shown.groupBy("cluster").agg(F.array_sort(F.collect_list(one)).alias("attempts"))
        log = cut(todo.join(taken, "cluster", "left").join(notes, "cluster", "left").select("cluster", "size", "depth", "reason", "threshold", "to_threshold", "sub_clusters", F.round("kept", 3).alias("kept"), F.when(F.col("to_threshold").isNull(), "not_divisible").otherwise("split").alias("outcome"), "attempts"))
        logs.append(log)
        done.append(judged.join(log.select("cluster", "outcome"), "cluster", "left").fillna("kept", ["outcome"]))
        split = log.where("outcome = 'split'").select("cluster")
        kept.append(inside.join(split, "cluster", "left_anti"))
        parent = judged.select(F.col("cluster"), "path")
        child = F.concat_ws(STEP, "cluster", "rep")
        new = subs.join(taken.select("cluster", F.col("taken").alias("attempt")), ["cluster", "attempt"]).withColumnRenamed("n", "size").join(parent, "cluster")
        members_of = tried.join(taken.select("cluster", F.col("taken").alias("attempt")), ["cluster", "attempt"], "left_semi")
        frontier = cut(new.select(child.alias("cluster"), F.col("cluster").alias("up"), "rep", "size", F.col("to_threshold").alias("threshold"), F.concat("path", F.array(first)).alias("path")))
        inside = cut(members_of.select(child.alias("cluster"), "taxon_id"))
    every = done[0]
    for x in done[1:]:
        every = every.unionByName(x)
    number = numbered(every, [], ["path"], "pos")
    named = cut(number.withColumn("name", F.concat(F.lit("cluster_"), (F.col("pos") + 1).cast("string"), F.lit("_"), _tag(kind, threshold))))
    up = named.select(F.col("cluster").alias("up"), F.col("name").alias("parent"))
    told = pt.report(named.withColumn("not_divisible", F.col("outcome") == "not_divisible"), recursion, max_depth, max_gap, max_expansion)
    clusters = told.join(up, "up", "left").select("name", "parent", "rep", "size", "depth", "threshold", "outcome", "gap_fraction", "expansion", F.when(F.col("outcome") != "split", F.col("kept_because")).alias("kept_because"))
    whole = kept[0]
    for x in kept[1:]:
        whole = whole.unionByName(x)
    name = named.select("cluster", "name")
    if logs:
        log = logs[0]
        for x in logs[1:]:
            log = log.unionByName(x)
    else:
        log = named.where("false").select("cluster", "size", "depth", "reason", "threshold", F.col("threshold").alias("to_threshold"), F.lit(0).cast("long").alias("sub_clusters"), F.lit(0.0).alias("kept"), "outcome", F.array().cast("array<struct<attempt:int,threshold:double,sub_clusters:bigint,kept:double,score:double>>").alias("attempts"))
    return Refinement(clusters, whole.join(name, "cluster").select("name", "taxon_id"), log.join(name, "cluster").drop("cluster"))
