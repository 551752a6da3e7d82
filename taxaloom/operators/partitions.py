"""Partitions: scores, constrained selection, refinement decisions, reports. Candidates of many runs go through one job."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from taxaloom.operators.blocks import arrow, batch, by_hash, kinds, met_with, packed, strips, typed
from taxaloom.operators.numbering import numbered
from taxaloom.session import cut

#: Limits of selection and refinement, and threshold grids.
MIN_SIZE, MIN_RETAINED, RETENTION_GAIN, RETENTION_BAND = 10, 0.70, 0.10, 0.03
TREE_MIN_TAXA, RECURSE_MIN_KEPT, MAX_ATTEMPTS = 4, 0.70, 3
TOP_SIZES = 25
GRIDS = {"evalue": [0.001, 0.01, 1.0, 10.0], "tmscore": [0.4, 0.5, 0.6, 0.7], "min_seq_id": [0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]}
EVALUE_STEPS = [10.0, 1.0, 0.3, 0.1, 0.03, 0.01, 0.001]
KEPT_BECAUSE = ("recursion disabled", "no split kept enough taxa in clusters of 4+", "recursion depth limit reached", "too small to split")
TAGS = {"evalue": "e", "tmscore": "tm", "min_seq_id": "id", "k": "k"}


def label_partition(members: DataFrame, taxa: DataFrame) -> DataFrame:
    """taxon_id, label of every taxon: representatives numbered in sorted order, -1 where unassigned."""
    reps = numbered(members.select("rep").distinct(), [], ["rep"], "label")
    return taxa.select("taxon_id").join(members.join(reps, "rep").select("taxon_id", "label"), "taxon_id", "left").select("taxon_id", F.coalesce("label", F.lit(-1)).alias("label"))


def shape(labels: DataFrame, min_size: int, by: tuple = ("candidate_id",)) -> DataFrame:
    """Cluster sizes of each candidate (the TOP_SIZES largest listed) and how much its clusters of at least ``min_size`` retain."""
    sizes = labels.groupBy(*by, "label").agg(F.count("*").alias("n"))
    real = F.when(F.col("label") >= 0, F.col("n"))
    big = F.when(real >= min_size, real)
    # clusters of a size are counted, and of a candidate's sizes only the largest TOP_SIZES listed
    kinds = sizes.where("label >= 0").groupBy(*by, "n").agg(F.least(F.count("*"), F.lit(TOP_SIZES)).cast("int").alias("c"))
    top = kinds.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n")))).where(F.col("place") <= TOP_SIZES)
    listed = top.groupBy(*by).agg(F.slice(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("n", "c")), asc=False), lambda x: F.array_repeat(x["n"], x["c"]))), 1, TOP_SIZES).alias("sizes"))
    out = sizes.groupBy(*by).agg(
        F.count(real).alias("n_clusters"), F.coalesce(F.max(real), F.lit(0)).alias("largest"), F.count_if(real == 1).alias("singletons"),
        F.count(big).alias("usable"), F.sum("n").alias("taxa_total"), F.coalesce(F.sum(big), F.lit(0)).alias("taxa_retained"), F.coalesce(F.sum(F.when(F.col("label") < 0, F.col("n"))), F.lit(0)).alias("unassigned"),
    )
    out = out.join(listed, list(by), "left").withColumn("sizes", F.coalesce("sizes", F.array().cast("array<bigint>")))
    return out.withColumn("retained_fraction", F.round(F.col("taxa_retained") / F.col("taxa_total"), 4))


def unit(vec: Column) -> Column:
    norm = F.greatest(F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x)), F.lit(1e-12))
    # as a field, the norm is taken once, not for each element
    both = F.array(F.struct(vec.alias("v"), norm.alias("n")))
    return F.get(F.transform(both, lambda b: F.transform(b["v"], lambda x: x / b["n"])), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _partial_sums(keys: list[str], schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """keys, n and s: the vectors u of each batch, summed; null and empty ones are left out."""
    for every in batches:
        b = every.filter(pc.fill_null(pc.greater(pc.list_value_length(every.column("u")), 0), False))
        if not b.num_rows:
            continue
        lengths, values = pc.list_value_length(b.column("u")).to_numpy(), pc.fill_null(b.column("u").flatten(), 0.0).to_numpy()
        m = np.zeros((b.num_rows, lengths.max()))
        m[np.arange(m.shape[1]) < lengths[:, None]] = values
        group = b.select(keys).to_pandas().groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
        order = np.argsort(group, kind="stable")
        start = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
        own = b.select(keys).take(pa.array(order[start]))
        n = np.diff(np.append(start, len(order)))
        yield typed(pa.RecordBatch.from_arrays([*own.columns, pa.array(n), pa.array(list(np.add.reduceat(m[order], start, axis=0)))], names=[*keys, "n", "s"]), schema)


def cluster_sums(points: DataFrame, by: tuple = ("candidate_id",)) -> DataFrame:
    """Each cluster's size and the sum of its vectors u; of the points of a batch whole vectors are summed, then element by element."""
    keys = [*by, "label"]
    schema = f"{kinds(points, keys)}, n long, s array<double>"
    some = points.select(*keys, "u").mapInArrow(partial(_partial_sums, keys, arrow(schema)), schema)
    each = some.select(*keys, "n", F.posexplode("s").alias("i", "x")).groupBy(*keys, "i").agg(F.sum("x").alias("s"), F.sum("n").alias("n"))
    return each.groupBy(*keys).agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda e: e["s"]).alias("s"))


def silhouette(points: DataFrame, by: tuple = ("candidate_id",)) -> DataFrame:
    """Mean cosine silhouette of each candidate from (by, taxon_id, label, vec), in closed form: the mean distance of a point to
    a cluster is 1 - u.S/n, so clusters' sums take the place of all pairs; blocks of points meet blocks of sums. Points alone in their cluster score 0; null
    with under two clusters, or as many as points."""
    own = list(by)
    p = points.where("label >= 0").select(*by, "taxon_id", "label", unit(F.col("vec")).alias("u"))
    sums = cut(cluster_sums(p, by))
    sizes = cut(sums.groupBy(*by).agg(F.sum("n").alias("points"), F.count("*").alias("clusters")))
    blocks = packed(by_hash(p.withColumnRenamed("u", "vec"), own, "taxon_id", sizes.select(*by, F.col("points").alias("size"))), own, ["taxon_id", "label"])
    centres = packed(by_hash(sums.withColumnRenamed("s", "vec"), own, "label", sizes.select(*by, F.col("clusters").alias("size"))), own, ["label", "n"])

    def meet(x: dict, y: dict) -> pa.RecordBatch:
        """a and b of a block's points as far as a block of clusters tells them."""
        at = np.searchsorted(y["label"], x["label"])
        here = y["label"][np.minimum(at, len(y["label"]) - 1)] == x["label"]
        a, b = np.full(x["rows"], np.nan), np.full(x["rows"], np.inf)
        for r in strips(x["rows"], y["rows"]):
            u, i = x["m"][r], np.flatnonzero(here[r])
            us, n = u @ y["m"].T, y["n"]
            j = at[r][i]
            with np.errstate(divide="ignore", invalid="ignore"):
                a[r][i] = np.where(n[j] > 1, (n[j] - us[i, j] - (1 - (u[i] * u[i]).sum(1))) / (n[j] - 1), np.nan)
            d = 1 - us / n
            d[i, j] = np.inf
            b[r] = d.min(1)
        return batch(x["rows"], {c: x[c] for c in by}, taxon_id=x["taxon_id"], label=x["label"], a=pa.array(a, from_pandas=True), b=pa.array(np.where(np.isinf(b), np.nan, b), from_pandas=True))

    schema = f"{kinds(p, [*by, 'taxon_id', 'label'])}, a double, b double"
    each = met_with(cut(blocks), cut(centres), own, meet, schema).groupBy(*by, "taxon_id", "label").agg(F.max("a").alias("a"), F.min("b").alias("b"))
    score = F.when(F.col("a").isNull(), 0.0).when(F.greatest("a", "b") > 0, (F.col("b") - F.col("a")) / F.greatest("a", "b")).otherwise(0.0)
    out = each.groupBy(*by).agg(F.avg(score).alias("s"), F.count("*").alias("n"), F.count_distinct("label").alias("parts"))
    return out.select(*by, F.when((F.col("parts") >= 2) & (F.col("n") > F.col("parts")), F.col("s")).alias("silhouette"))


def scoped_silhouette(points: DataFrame, min_size: int, by: tuple = ("candidate_id",)) -> DataFrame:
    """silhouette over the points in clusters of at least ``min_size``; null under three points or two clusters."""
    size = cut(points.groupBy(*by, "label").agg(F.count("*").alias("size")))
    large = size.where((F.col("label") >= 0) & (F.col("size") >= min_size))
    enough = large.groupBy(*by).agg(F.sum("size").alias("n")).where("n >= 3").select(*by)
    kept = points.join(large.join(enough, list(by), "left_semi").select(*by, "label"), [*by, "label"], "left_semi")
    return size.select(*by).distinct().join(silhouette(kept, by), list(by), "left")


def score(labels: DataFrame, spaces: dict[str, DataFrame], min_size: int) -> DataFrame:
    """shape, and a map from space to scoped silhouette."""
    out, names = shape(labels, min_size), []
    for i, (name, vectors) in enumerate(spaces.items()):
        s = scoped_silhouette(labels.join(vectors.select("taxon_id", "vec"), "taxon_id"), min_size).withColumnRenamed("silhouette", f"s{i}")
        out = out.join(s, "candidate_id", "left")
        names.append((name, f"s{i}"))
    return out.withColumn("silhouette", F.create_map(*[x for name, c in names for x in (F.lit(name), F.col(c))])).drop(*[c for _, c in names])


def silhouette_of(primary: str) -> Column:
    """The primary space's value, else the first other space's, else -1."""
    other = F.get(F.filter(F.map_entries("silhouette"), lambda e: (e["key"] != primary) & e["value"].isNotNull()), 0)["value"]
    return F.coalesce(F.col("silhouette")[primary], other, F.lit(-1.0))


def select(candidates: DataFrame, primary: str, min_retained: float = MIN_RETAINED, by: tuple = ("run",)) -> DataFrame:
    """The selected candidate of each run: among the feasible the best silhouette, then retention, then usable clusters; if none
    is feasible the best retention, then silhouette. Ties go to the first in the grid."""
    ok = (F.col("retained_fraction") >= min_retained) & (F.col("usable") >= 2)
    c = candidates.withColumn("feasible", ok).withColumn("s", silhouette_of(primary)).withColumn("relaxed", ~F.max("feasible").over(Window.partitionBy(*by)))
    pool = c.where("feasible or relaxed")
    one, two = F.when(F.col("relaxed"), F.col("retained_fraction")).otherwise(F.col("s")), F.when(F.col("relaxed"), F.col("s")).otherwise(F.col("retained_fraction"))
    three = F.when(F.col("relaxed"), 0).otherwise(F.col("usable"))
    order = Window.partitionBy(*by).orderBy(one.desc(), two.desc(), three.desc(), "grid_pos")
    return pool.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k", "s", "feasible")


def disagreement(candidates: DataFrame, primary: str, min_retained: float = MIN_RETAINED, by: tuple = ("run",)) -> DataFrame:
    """Spaces that would have picked another candidate than the primary one, and which."""
    chosen = select(candidates, primary, min_retained, by).select(*by, F.col("grid_pos").alias("primary_pos"), "relaxed")
    ok = (F.col("retained_fraction") >= min_retained) & (F.col("usable") >= 2)
    pool = candidates.join(chosen, list(by)).where(ok | F.col("relaxed"))
    each = pool.select(*by, "primary_pos", "grid_pos", F.explode("silhouette").alias("space", "value")).where(F.col("space") != primary)
    k = F.row_number().over(Window.partitionBy(*by, "space").orderBy(F.coalesce("value", F.lit(-1.0)).desc(), "grid_pos"))
    return each.withColumn("k", k).where("k = 1 and grid_pos <> primary_pos").select(*by, "space", "primary_pos", F.col("grid_pos").alias("other_pos"))


def alternative(candidates: DataFrame, selected: DataFrame, gain: float = RETENTION_GAIN, band: float = RETENTION_BAND, by: tuple = ("run",)) -> DataFrame:
    """A more inclusive candidate than the selected one: of those near the best retention the one with most usable clusters."""
    base = selected.select(*by, F.col("grid_pos").alias("base_pos"), F.col("retained_fraction").alias("base"), F.greatest(F.lit(2), F.floor(F.col("usable") * 0.75)).alias("floor"))
    viable = candidates.join(base, list(by)).where((F.col("retained_fraction") >= F.col("base") + gain) & (F.col("usable") >= F.col("floor")) & (F.col("grid_pos") != F.col("base_pos")))
    near = viable.withColumn("best", F.max("retained_fraction").over(Window.partitionBy(*by))).where(F.col("retained_fraction") >= F.col("best") - band)
    k = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("usable"), F.desc("retained_fraction"), "grid_pos"))
    return near.withColumn("k", k).where("k = 1").drop("k", "best", "floor")


def _percent(x: Column) -> Column:
    return F.format_string("%d%%", F.bround(x * 100).cast("long"))


def explain_selection(selected: DataFrame, candidates: DataFrame, primary: str, min_size: int = MIN_SIZE, min_retained: float = MIN_RETAINED, by: tuple = ("run",)) -> DataFrame:
    """selected with reason (why this candidate) and, where no candidate met the limits, recommendation (what that says of the input, with
    the best retention there was)."""
    top = candidates.groupBy(*by).agg(F.max("retained_fraction").alias("top"))
    s = selected.join(top, list(by))
    limit = f"{min_retained:.0%} of taxa in clusters of {min_size}+"
    relaxed = F.concat(F.lit("limits not met: keeps the most taxa ("), _percent(F.col("retained_fraction")), F.lit("), since the best silhouette would belong to the most fragmented partition"))
    reason = F.when(F.col("relaxed"), relaxed).otherwise(F.lit(f"best {primary} silhouette of the partitions that keep {limit}"))
    advice = F.concat(F.lit(f"no partition kept {limit}; the best kept "), _percent(F.col("top")), F.lit(": look for smaller clusters, cluster by structure, or take it that the set has no such groups"))
    return s.withColumn("reason", reason).withColumn("recommendation", F.when(F.col("relaxed"), advice)).drop("top")


def explain_alternative(alternatives: DataFrame, min_size: int = MIN_SIZE) -> DataFrame:
    """alternatives (of alternative()) with rationale: what is gained over the selection, and what it costs."""
    gain = F.format_string("%d", F.bround((F.col("retained_fraction") - F.col("base")) * 100).cast("long"))
    parts = [F.lit("keeps "), _percent(F.col("retained_fraction")), F.lit(" of taxa instead of "), _percent(F.col("base")), F.lit(" (+"), gain, F.lit(" points) in "), F.col("usable").cast("string"), F.lit(f" clusters of {min_size}+, which are less clearly apart: for aligning as many taxa as possible")]
    return alternatives.withColumn("rationale", F.concat(*parts))


def summary(candidates: DataFrame) -> DataFrame:
    """Candidates without their members."""
    return candidates.drop("members")


def schedule(points: DataFrame, attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """next and schedule for each (kind, threshold): e-values start at the current one, others one step stricter."""
    grid = F.create_map(*[x for k, v in GRIDS.items() for x in (F.lit(k), F.array(*[F.lit(float(t)) for t in v]))])[F.col("kind")]
    lower, higher = (lambda g: F.sort_array(F.filter(g, lambda t: t < F.col("threshold")), asc=False)), F.sort_array(F.filter(grid, lambda t: t > F.col("threshold")))
    steps = F.array(*[F.lit(t) for t in EVALUE_STEPS])
    is_e = F.col("kind") == "evalue"
    plan = F.when(is_e, F.concat(F.array("threshold"), lower(steps))).otherwise(higher)
    return points.select("kind", "threshold", F.when(is_e, F.get(lower(grid), 0)).otherwise(F.get(higher, 0)).alias("next"), F.slice(plan, 1, attempts).alias("schedule"))


def fraction_kept(subs: DataFrame, min_taxa: int = TREE_MIN_TAXA, least: float = RECURSE_MIN_KEPT) -> DataFrame:
    """Each attempt at splitting a parent: clusters, share of the parent in clusters of tree size, accepted or not."""
    g = subs.groupBy("parent", "attempt").agg(F.count("*").alias("n_sub"), (F.coalesce(F.sum(F.when(F.col("size") >= min_taxa, F.col("size"))), F.lit(0)) / F.max("parent_size")).alias("kept"))
    return g.withColumn("accepted", (F.col("n_sub") > 1) & (F.col("kept") >= least))


def report(clusters: DataFrame, recursion: bool = True, max_depth: int = 2, max_gap: float = 0.65, max_expansion: float = 3.0) -> DataFrame:
    """Clusters with eligible (of tree size), over (their alignment is over the limits) and, if so, why they were kept: the first of the
    reasons that holds. not_divisible says that no split kept enough, as the refinement's log has it."""
    over = F.coalesce((F.col("gap_fraction") >= max_gap) | (F.col("expansion") > max_expansion), F.lit(False))
    why = F.when(~F.lit(recursion), KEPT_BECAUSE[0]).when(F.col("not_divisible"), KEPT_BECAUSE[1]).when(F.col("depth") >= max_depth, KEPT_BECAUSE[2]).otherwise(KEPT_BECAUSE[3])
    return clusters.withColumn("eligible", F.col("size") >= TREE_MIN_TAXA).withColumn("over", over).withColumn("kept_because", F.when(over, why))


def cluster_name(clusters: DataFrame, kind: str, threshold: float, by: tuple = ("candidate_id",)) -> DataFrame:
    """cluster_<n>_<tag> by size, then representative; the tag tells the kind of threshold and its value."""
    tag = f"{TAGS.get(kind, 't')}{threshold:g}"
    n = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("size"), "rep"))
    return clusters.withColumn("name", F.format_string(f"cluster_%d_{tag}", n))


def operating_point(selected: DataFrame, taxa: DataFrame, mode: str, kind: str) -> DataFrame:
    n = taxa.agg(F.count("*").alias("taxa"))
    note = "e-values depend on the size of the set: compare runs of like size only" if kind == "evalue" else "comparable between runs"
    return selected.crossJoin(F.broadcast(n)).select("*", F.lit(mode).alias("mode"), F.lit(kind).alias("threshold_kind"), F.lit(note).alias("note"))


def align_spaces(spaces: list[DataFrame]) -> DataFrame:
    """Taxa that all spaces hold, in a common order; none if they are under three."""
    common = spaces[0].select("taxon_id")
    for s in spaces[1:]:
        common = common.join(s.select("taxon_id"), "taxon_id", "left_semi")
    enough = common.agg(F.count("*").alias("n")).where("n >= 3")
    return common.join(F.broadcast(enough)).select("taxon_id").orderBy("taxon_id")


def medoids(points: DataFrame, by: tuple = ("candidate_id",)) -> DataFrame:
    """The member nearest each cluster's mean, the first by name of ties."""
    p = points.select(*by, "taxon_id", "label", F.col("vec").alias("u"))
    mean = cluster_sums(p, by).select(*by, "label", "n", F.expr("transform(s, x -> x / n)").alias("mean"))
    gap = F.sqrt(F.aggregate(F.zip_with("u", "mean", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    near = p.join(mean, [*by, "label"]).withColumn("d", F.round(gap, 9))
    return near.groupBy(*by, "label").agg(F.min_by("taxon_id", F.struct("d", "taxon_id")).alias("rep"), F.max("n").alias("size"))
