"""Provenance and quality of many runs: stages, statuses, diagnostics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def record_stages(stages: DataFrame) -> DataFrame:
    """Stages with their status: one that declared outputs and made none is skipped, with a reason."""
    none = (F.col("status") == "ok") & (F.col("declared") > 0) & (F.col("made") == 0)
    return stages.withColumn("reason", F.when(none, "declared output was not produced")).withColumn("status", F.when(none, "skipped").otherwise(F.col("status")))


def final_status(stages: DataFrame) -> DataFrame:
    failed, skipped = F.bool_or(F.col("status") == "failed"), F.bool_or(F.col("status") == "skipped")
    return stages.groupBy("run").agg(F.when(failed, "failed").when(skipped, "completed_with_skips").otherwise("completed").alias("status"), F.count("*").alias("stages"))


# How severe a check's status is, the severest first, and what two of the checks imply.
SEVERITIES = ["fail", "warn", "info", "pass"]
LAYOUT_ONLY = "Whole-set (master) trees rest on this alignment. Treat their topology as a layout, not as inference. Per-cluster trees are unaffected."
GAPPIER = "Those clusters' trees rest on gappier alignments than the rest."
QC_IGNORED = "Sequences QC rejected are still present in the whole-set trees."
UNUSABLE = "Built on an alignment that failed the usability gate."
LOCAL_SUPPORT = "SH-like local support is an approximation, not a bootstrap, and tends to read optimistically."
UNCOMMITTED = "The working tree differed from the recorded commit, so this run is not reproducible from that commit alone."


def _check(key: str, label: str, status: Column, detail: Column, implication: Column | None = None) -> Column:
    """One check; null (not made) where status is null."""
    text = F.lit(None).cast("string") if implication is None else implication
    return F.when(status.isNotNull(), F.struct(F.lit(key).alias("key"), F.lit(label).alias("label"), status.alias("status"), detail.alias("detail"), text.alias("implication")))


def diagnostics(runs: DataFrame) -> DataFrame:
    """run, key, label, status, detail, implication, place: up to nine checks of each run, the severest first.

    Columns of ``runs``, null where a run doesn't record them: usable, gap_fraction, expansion, reason (whole-set alignment),
    retained, excluded, tips (quality control against the tips of master trees), failed, skipped (names of stages), n_stages,
    trees_ok, trees_failed, trees_skipped, over_3di, over_aa (clusters over the limits), blockers, preflight (warnings), masters
    (array of usable, interpretation, support), git_dirty, git_commit.
    """
    c, none = F.col, F.lit(None).cast("string")
    n = lambda x: F.coalesce(F.size(x), F.lit(0))
    some = lambda *xs: F.format_string(*xs)
    has_tips = c("retained").isNotNull() & (F.coalesce("tips", F.lit(0)) > 0)
    marked = F.filter("masters", lambda m: ~m["usable"])
    kinds = F.array_sort(F.array_distinct(F.filter(F.transform("masters", lambda m: m["support"]), lambda x: F.coalesce(x, F.lit("")) != "")))
    local = F.exists(kinds, lambda x: F.contains(x, F.lit("SH-like")) | F.contains(x, F.lit("local")))
    over = (F.coalesce("over_3di", F.lit(0)) > 0) | (F.coalesce("over_aa", F.lit(0)) > 0)
    commit = F.coalesce(F.left("git_commit", F.lit(8)), F.lit("None"))
    checks = [
        _check(
            "full_set",
            "Whole-set alignment",
            F.when(c("usable").isNull(), "info").when(c("usable"), "pass").otherwise("fail"),
            F.when(c("usable").isNull(), "not assessed").when(c("usable"), some("%.1f%% gaps, %.2fx expansion", F.coalesce("gap_fraction", F.lit(0.0)) * 100, F.coalesce("expansion", F.lit(0.0)))).otherwise(F.coalesce("reason", F.lit("flagged unusable"))),
            F.when(~c("usable"), LAYOUT_ONLY),
        ),
        _check(
            "qc_applied",
            "QC exclusions in master trees",
            F.when(has_tips, F.when(c("tips") > c("retained"), "fail").otherwise("pass")),
            F.when(c("tips") > c("retained"), some("%d excluded by QC, but master trees carry %d tips", F.coalesce("excluded", c("tips") - c("retained")), c("tips"))).otherwise(some("%d tips, %d retained", c("tips"), c("retained"))),
            F.when(c("tips") > c("retained"), QC_IGNORED),
        ),
        _check(
            "stages",
            "Pipeline stages",
            F.when(n("failed") > 0, "fail").when(n("skipped") > 0, "warn").otherwise("pass"),
            F.when(n("failed") > 0, F.concat(F.lit("failed: "), F.array_join("failed", ", "))).when(n("skipped") > 0, F.concat(F.lit("skipped: "), F.array_join("skipped", ", "))).otherwise(some("all %d completed", F.coalesce("n_stages", F.lit(0)))),
        ),
        _check("cluster_trees", "Per-cluster trees", F.when(c("trees_failed") > 0, "fail").when(c("trees_ok").isNotNull(), "pass"), some("%d built, %d failed, %d skipped as too small", c("trees_ok"), c("trees_failed"), c("trees_skipped"))),
        _check("over_threshold", "Cluster alignment quality", F.when(over, "warn").when(c("trees_ok").isNotNull(), "pass"), F.when(over, some("%d cluster(s) over 3Di thresholds, %d over AA thresholds", F.coalesce("over_3di", F.lit(0)), F.coalesce("over_aa", F.lit(0)))).otherwise("all within thresholds"), F.when(over, GAPPIER)),
        _check(
            "preflight",
            "Preflight",
            F.when(n("blockers") > 0, "fail").when(n("preflight") > 0, "warn").otherwise("pass"),
            F.when(n("blockers") > 0, some("%d blocker(s)", n("blockers"))).when(n("preflight") > 0, F.array_join(F.transform(F.slice("preflight", 1, 2), lambda w: F.left(w, F.lit(90))), "; ")).otherwise("no blockers or warnings"),
        ),
        _check("master_marked", "Whole-set trees marked", F.when(n(marked) > 0, "warn"), some("%d of %d master tree(s) flagged by the pipeline", n(marked), n("masters")), F.coalesce(F.nullif(F.get(marked, F.lit(0))["interpretation"], F.lit("")), F.lit(UNUSABLE))),
        _check("support", "Master tree support", F.when(n(kinds) > 0, F.when(local, "warn").otherwise("pass")), F.left(F.array_join(kinds, "; "), F.lit(110)), F.when(local, LOCAL_SUPPORT)),
        _check("reproducible", "Code state", F.when(c("git_dirty"), "warn").when(c("git_commit").isNotNull(), "pass"), F.when(c("git_dirty"), F.concat(F.lit("uncommitted changes at "), commit)).otherwise(F.concat(F.lit("clean at "), commit)), F.when(c("git_dirty"), F.lit(UNCOMMITTED)).otherwise(none)),
    ]
    made = runs.select("run", F.posexplode(F.array(*checks)).alias("ord", "x")).where("x is not null")
    rank = F.array_position(F.array(*[F.lit(x) for x in SEVERITIES]), F.col("x.status"))
    place = F.row_number().over(Window.partitionBy("run").orderBy(rank, "ord"))
    return made.select("run", "x.*", place.alias("place"))


def severity_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("run").pivot("status", SEVERITIES).count().fillna(0)


def qc_applied(tips: DataFrame, retained: DataFrame) -> DataFrame:
    """Tips of trees that quality control had excluded, by tree."""
    return tips.join(retained.withColumn("kept", F.lit(1)), "name", "left").groupBy("tree_id").agg(F.count("*").alias("tips"), F.count_if(F.col("kept").isNull()).alias("excluded"))


def warnings(messages: DataFrame) -> DataFrame:
    """Distinct messages of each run in the order first seen."""
    return messages.groupBy("run", "message").agg(F.min("seq").alias("first")).withColumn("place", F.row_number().over(Window.partitionBy("run").orderBy("first", "message")))


def outcomes(jobs: DataFrame, kinds: list[str]) -> DataFrame:
    """Jobs of each run by outcome, a column for each kind."""
    return jobs.groupBy("run").agg(*[F.count_if(F.col("outcome") == k).alias(k) for k in kinds])


def master_method(gates: DataFrame) -> DataFrame:
    """How the tree of the whole set is made, and whether it is for layout only."""
    return gates.withColumn("method", F.when(F.col("usable"), "iqtree").otherwise("fasttree")).withColumn("layout_only", ~F.col("usable"))


def alignment_provenance(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """The aligner that wrote each alignment file (run, path): what the run's sidecar (run, aligner, produced_by: file name ->
    aligner) says of the file, else its aligner. Names don't tell: some are kept for compatibility. unknown without a sidecar."""
    name = F.element_at(F.split("path", "/"), -1)
    held = files.join(sidecars, "run", "left")
    return held.withColumn("producer", F.coalesce(F.try_element_at("produced_by", name), "aligner", F.lit("unknown"))).withColumn("alphabet", F.when(F.lower(name).contains("3di"), "3di").otherwise("aa")).drop("aligner", "produced_by")
