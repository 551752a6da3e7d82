"""Queries G and H: provenance and quality of runs, in batch and from a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import alignment, runs as op
from taxaloom.plans import adapters as ad
from taxaloom.session import table


def _stages(spark, d):
    e = table(spark, d, "events")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "skipped").otherwise("ok")
    return e.select(F.col("user_id").alias("run"), F.col("event_type").alias("stage"), status.alias("status"), F.col("value").alias("duration"), F.col("event_id").alias("seq"), (F.col("event_id") % 3).alias("declared"), (F.col("event_id") % 4).alias("made"), "ts")


def g1_record_stages(spark, d):
    return op.record_stages(_stages(spark, d)).select("run", "seq", "status", "reason")


def g2_final_status(spark, d):
    return op.final_status(_stages(spark, d))


def _manifests(spark, d):
    """What a run's manifest records: a user's events are its stages; the rest follows from their number."""
    e = _stages(spark, d).groupBy("run").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.when(F.col("status") == "failed", F.col("stage")))).alias("failed"), F.array_sort(F.collect_set(F.when(F.col("status") == "skipped", F.col("stage")))).alias("skipped"))
    c = F.col
    tree = lambda usable, support: F.struct(usable.alias("usable"), F.lit("").alias("interpretation"), support.alias("support"))
    masters = F.array(tree(c("n") % 5 != 0, F.when(c("n") % 3 == 0, "SH-like local support").otherwise("UFBoot")), tree(F.lit(True), F.lit("UFBoot")))
    return e.select(
        "run", F.when(c("n") % 4 != 0, c("n") % 4 != 1).alias("usable"), ((c("n") % 100) / 100).alias("gap_fraction"), (c("n") % 7 + 0.5).alias("expansion"), F.when(c("n") % 8 == 1, "too many gaps").alias("reason"),
        F.when(c("n") % 6 != 0, 10).alias("retained"), F.when(c("n") % 2 == 0, 2).alias("excluded"), (c("n") % 12).alias("tips"), F.when(c("n") % 3 == 0, c("failed")).alias("failed"), "skipped", c("n").alias("n_stages"),
        F.when(c("n") % 7 != 0, c("n")).alias("trees_ok"), F.when(c("n") % 7 != 0, c("n") % 2).alias("trees_failed"), F.when(c("n") % 7 != 0, F.lit(3)).alias("trees_skipped"), (c("n") % 3).alias("over_3di"), (c("n") % 2).alias("over_aa"),
        F.when(c("n") % 9 == 0, F.array(F.lit("no tool"))).alias("blockers"), F.when(c("n") % 5 == 0, F.array(F.lit("slow disk"), F.lit("old tool"), F.lit("third"))).alias("preflight"), masters.alias("masters"), (c("n") % 4 == 0).alias("git_dirty"), F.when(c("n") % 4 < 3, F.lit("0123456789ab")).alias("git_commit"),
    )


def _found(spark, d):
    return op.diagnostics(_manifests(spark, d))


def g3_diagnostics(spark, d):
    return _found(spark, d)


def g3_severity_counts(spark, d):
    return op.severity_counts(_found(spark, d)).withColumnRenamed("pass", "passed")


def g4_qc_applied(spark, d):
    s = ad.sequences(spark, d)
    kept = alignment.qc_filter(s).where("kept").select(F.col("taxon_id").alias("name"))
    return op.qc_applied(s.select(F.col("dataset").alias("tree_id"), F.col("taxon_id").alias("name")), kept)


def g5_warnings(spark, d):
    return op.warnings(_stages(spark, d).select("run", F.col("stage").alias("message"), "seq"))


def _jobs(spark, d):
    o = F.element_at(F.array(*[F.lit(x) for x in ("ok", "failed", "too_small", "no_alignment")]), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, d, "events").select(F.col("user_id").alias("run"), o.alias("outcome"))


def g6_tree_jobs(spark, d):
    return op.outcomes(_jobs(spark, d), ["ok", "failed", "too_small", "no_alignment"])


def g7_start_trees(spark, d):
    return op.outcomes(_jobs(spark, d).withColumn("outcome", F.when(F.col("outcome") == "ok", "guided").when(F.col("outcome") == "failed", "fell_back").otherwise("not_used")), ["guided", "fell_back", "not_used"])


def g8_master_method(spark, d):
    return op.master_method(alignment.full_set_gate(alignment.gap_stats(ad.alignment(spark, d), ["partition", "alphabet"]))).select("partition", "alphabet", "method", "layout_only")


def g9_alignment_provenance(spark, d):
    """Files of a run by compatibility names; sidecars of three quarters of the runs, which name half of the files."""
    p = table(spark, d, "pages").select("page_id", F.col("page_id").alias("run"), F.format_string("runs/%d/foldmason.fasta_%s.fa", "page_id", F.when(F.col("page_id") % 2 == 0, "3di").otherwise("aa")).alias("path"))
    aligner = F.when(F.col("page_id") % 3 == 0, "foldmason").otherwise("mafft")
    sidecars = table(spark, d, "pages").where("page_id % 4 <> 3").select(F.col("page_id").alias("run"), aligner.alias("aligner"), F.create_map(F.lit("foldmason.fasta_3di.fa"), F.lit("mafft --aamatrix")).alias("produced_by"))
    return op.alignment_provenance(p, sidecars).select("page_id", "path", "producer", "alphabet")


QUERIES = {k: f for k, f in globals().items() if k[:1] == "g" and k[1:2].isdigit()}

_S = "s AS (SELECT user_id AS run, event_type AS stage, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' ELSE 'ok' END AS status, value AS duration, event_id AS seq, event_id % 3 AS declared, event_id % 4 AS made FROM events)"
_D = f"""{_S}, g AS (SELECT run, count(*) AS n, list_sort(list(DISTINCT stage) FILTER (status = 'failed')) AS bad, list_sort(list(DISTINCT stage) FILTER (status = 'skipped')) AS skip FROM s GROUP BY 1),
c AS (
  SELECT run, 0 AS ord, 'full_set' AS key, 'Whole-set alignment' AS label, CASE n % 4 WHEN 0 THEN 'info' WHEN 1 THEN 'fail' ELSE 'pass' END AS status, CASE n % 4 WHEN 0 THEN 'not assessed' WHEN 1 THEN CASE WHEN n % 8 = 1 THEN 'too many gaps' ELSE 'flagged unusable' END ELSE (n % 100) || '.0% gaps, ' || (n % 7) || '.50x expansion' END AS detail, CASE WHEN n % 4 = 1 THEN '{op.LAYOUT_ONLY}' END AS implication FROM g
  UNION ALL SELECT run, 1, 'qc_applied', 'QC exclusions in master trees', CASE WHEN n % 12 > 10 THEN 'fail' ELSE 'pass' END, CASE WHEN n % 12 > 10 THEN (CASE WHEN n % 2 = 0 THEN 2 ELSE n % 12 - 10 END) || ' excluded by QC, but master trees carry ' || (n % 12) || ' tips' ELSE (n % 12) || ' tips, 10 retained' END, CASE WHEN n % 12 > 10 THEN '{op.QC_IGNORED}' END FROM g WHERE n % 6 <> 0
  UNION ALL SELECT run, 2, 'stages', 'Pipeline stages', CASE WHEN n % 3 = 0 AND bad IS NOT NULL THEN 'fail' WHEN skip IS NOT NULL THEN 'warn' ELSE 'pass' END, CASE WHEN n % 3 = 0 AND bad IS NOT NULL THEN 'failed: ' || array_to_string(bad, ', ') WHEN skip IS NOT NULL THEN 'skipped: ' || array_to_string(skip, ', ') ELSE 'all ' || n || ' completed' END, NULL FROM g
  UNION ALL SELECT run, 3, 'cluster_trees', 'Per-cluster trees', CASE WHEN n % 2 > 0 THEN 'fail' ELSE 'pass' END, n || ' built, ' || (n % 2) || ' failed, 3 skipped as too small', NULL FROM g WHERE n % 7 <> 0
  UNION ALL SELECT run, 4, 'over_threshold', 'Cluster alignment quality', CASE WHEN n % 6 <> 0 THEN 'warn' ELSE 'pass' END, CASE WHEN n % 6 <> 0 THEN (n % 3) || ' cluster(s) over 3Di thresholds, ' || (n % 2) || ' over AA thresholds' ELSE 'all within thresholds' END, CASE WHEN n % 6 <> 0 THEN '{op.GAPPIER.replace("'", "''")}' END FROM g WHERE n % 6 <> 0 OR n % 7 <> 0
  UNION ALL SELECT run, 5, 'preflight', 'Preflight', CASE WHEN n % 9 = 0 THEN 'fail' WHEN n % 5 = 0 THEN 'warn' ELSE 'pass' END, CASE WHEN n % 9 = 0 THEN '1 blocker(s)' WHEN n % 5 = 0 THEN 'slow disk; old tool' ELSE 'no blockers or warnings' END, NULL FROM g
  UNION ALL SELECT run, 6, 'master_marked', 'Whole-set trees marked', 'warn', '1 of 2 master tree(s) flagged by the pipeline', '{op.UNUSABLE}' FROM g WHERE n % 5 = 0
  UNION ALL SELECT run, 7, 'support', 'Master tree support', CASE WHEN n % 3 = 0 THEN 'warn' ELSE 'pass' END, CASE WHEN n % 3 = 0 THEN 'SH-like local support; UFBoot' ELSE 'UFBoot' END, CASE WHEN n % 3 = 0 THEN '{op.LOCAL_SUPPORT}' END FROM g
  UNION ALL SELECT run, 8, 'reproducible', 'Code state', CASE WHEN n % 4 = 0 THEN 'warn' ELSE 'pass' END, CASE WHEN n % 4 = 0 THEN 'uncommitted changes at ' ELSE 'clean at ' END || '01234567', CASE WHEN n % 4 = 0 THEN '{op.UNCOMMITTED}' END FROM g WHERE n % 4 < 3
)"""

SQL = {
    "g1_record_stages": f"WITH {_S} SELECT run, seq, CASE WHEN status = 'ok' AND declared > 0 AND made = 0 THEN 'skipped' ELSE status END AS status, CASE WHEN status = 'ok' AND declared > 0 AND made = 0 THEN 'declared output was not produced' END AS reason FROM s",
    "g2_final_status": f"WITH {_S} SELECT run, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'skipped') THEN 'completed_with_skips' ELSE 'completed' END AS status, count(*) AS stages FROM s GROUP BY 1",
    "g3_diagnostics": f"WITH {_D} SELECT run, key, label, status, detail, implication, CAST(row_number() OVER (PARTITION BY run ORDER BY list_position(['fail', 'warn', 'info', 'pass'], status), ord) AS INT) AS place FROM c",
    "g3_severity_counts": f"WITH {_D} SELECT run, count(*) FILTER (status = 'fail') AS fail, count(*) FILTER (status = 'warn') AS warn, count(*) FILTER (status = 'info') AS info, count(*) FILTER (status = 'pass') AS passed FROM c GROUP BY 1",
    "g4_qc_applied": f"WITH {ad.SEQUENCES}, m AS (SELECT list_sort(list(length(seq)))[count(*) // 2 + 1] AS median FROM sequences) SELECT dataset AS tree_id, count(*) AS tips, count(*) FILTER (length(seq) < greatest(50, floor(median * 0.4))) AS excluded FROM sequences, m GROUP BY 1",
    "g5_warnings": f"WITH {_S}, f AS (SELECT run, stage AS message, min(seq) AS first FROM s GROUP BY ALL) SELECT *, CAST(row_number() OVER (PARTITION BY run ORDER BY first, message) AS INT) AS place FROM f",
    "g6_tree_jobs": "SELECT user_id AS run, count(*) FILTER (event_id % 4 = 0) AS ok, count(*) FILTER (event_id % 4 = 1) AS failed, count(*) FILTER (event_id % 4 = 2) AS too_small, count(*) FILTER (event_id % 4 = 3) AS no_alignment FROM events GROUP BY 1",
    "g7_start_trees": "SELECT user_id AS run, count(*) FILTER (event_id % 4 = 0) AS guided, count(*) FILTER (event_id % 4 = 1) AS fell_back, count(*) FILTER (event_id % 4 > 1) AS not_used FROM events GROUP BY 1",
    "g8_master_method": "SELECT \"partition\", alphabet, CASE WHEN usable THEN 'iqtree' ELSE 'fasttree' END AS method, NOT usable AS layout_only FROM (" + __import__("taxaloom.plans.alignment", fromlist=["SQL"]).SQL["b4_full_set_gate"] + ")",
    "g9_alignment_provenance": "SELECT page_id, 'runs/' || page_id || '/foldmason.fasta_' || CASE WHEN page_id % 2 = 0 THEN '3di' ELSE 'aa' END || '.fa' AS path, CASE WHEN page_id % 4 = 3 THEN 'unknown' WHEN page_id % 2 = 0 THEN 'mafft --aamatrix' WHEN page_id % 3 = 0 THEN 'foldmason' ELSE 'mafft' END AS producer, CASE WHEN page_id % 2 = 0 THEN '3di' ELSE 'aa' END AS alphabet FROM pages",
}
