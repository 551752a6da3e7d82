"""Queries C23 to C25: brands of parts as clusters, split by what parts have in common; embeddings split by k-means."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import refine
from taxaloom.plans import adapters as ad
from taxaloom.session import cut, table

SLOTS, WIDTH = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"), 24
LIMITS = {"min_size": 4, "max_gap": 0.15}


def _inputs(spark, d):
    """Brands as clusters; rows in which each type has columns of its own; pairs that are alike at 0.5 (type), 0.6 (and parity of the
    size) and 0.7 (and name), so that clusters at each threshold are classes of equal values. Pairs are given between each class's
    least member and the others: that connects the class, and no two parts of different classes."""
    p = table(spark, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("taxon_id"), F.col("p_partkey").alias("ord"), "p_brand", "p_type", "p_name", (F.col("p_size") % 2).alias("odd"), F.regexp_replace(F.lower("p_name"), "[^a-z]", "").alias("text"))
    slot = F.greatest(F.array_position(F.array(*map(F.lit, SLOTS)), F.col("p_type")) - 1, F.lit(0)).cast("int")
    row = F.concat(F.repeat(F.lit("-"), slot * WIDTH), F.rpad("text", WIDTH, "-"), F.repeat(F.lit("-"), (len(SLOTS) - 1 - slot) * WIDTH))
    aln = p.select("taxon_id", F.lit("3di").alias("alphabet"), row.alias("row"), "ord")
    members = p.join(p.groupBy("p_brand").agg(F.min("taxon_id").alias("rep")), "p_brand").select("taxon_id", "rep")
    # a class of equals is told by its pairs with its least member: those cover it alone, as all its pairs do, in the same order
    classes = []
    for score, key in ((0.5, ["p_brand", "p_type"]), (0.6, ["p_brand", "p_type", "odd"]), (0.7, ["p_brand", "p_type", "odd", "p_name"])):
        least = p.groupBy(*key).agg(F.min("taxon_id").alias("a"))
        classes.append(p.join(least, key).where("a < taxon_id").select("a", F.col("taxon_id").alias("b"), F.lit(score).alias("score"), F.lit(1.0).alias("coverage")))
    pairs = classes[0].unionByName(classes[1]).unionByName(classes[2])
    return members, refine.measured_on(aln), refine.by_pairs(pairs, "tmscore")


def _refined(spark, d):
    members, measure, splitter = _inputs(spark, d)
    return refine.recursive_refine(members, measure, splitter, "tmscore", 0.4, **LIMITS)


def c23_recursive_refine(spark, d):
    found = _refined(spark, d)
    log = found.log.select("name", F.col("to_threshold"), "sub_clusters", "kept", F.coalesce(F.size("attempts"), F.lit(0)).alias("attempts"))
    none = {"sub_clusters": 0, "attempts": 0}
    return found.clusters.join(log, "name", "left").fillna(none).select("name", "parent", "rep", "size", "depth", "threshold", "outcome", "gap_fraction", "to_threshold", "sub_clusters", "kept", "attempts")


def c25_report(spark, d):
    return _refined(spark, d).clusters.where("outcome <> 'split'").select("name", (F.col("size") >= 4).alias("eligible"), F.col("kept_because").isNotNull().alias("over"), "kept_because")


def c24_recursive_refine_plm(spark, d):
    """Vectors in clusters by id; a cluster's alignment has a row of one letter for each vector, in one of three columns by label, so that mixed
    clusters are gappy."""
    v = cut(ad.vectors(spark, d))
    aln = v.select("taxon_id", F.lit("3di").alias("alphabet"), F.concat(F.repeat(F.lit("-"), (F.col("label") % 3).cast("int")), F.lit("a"), F.repeat(F.lit("-"), (2 - F.col("label") % 3).cast("int"))).alias("row"), "ord")
    group = (F.col("ord") % 4).alias("g")
    members = v.select("taxon_id", group).join(v.groupBy(group).agg(F.min("taxon_id").alias("rep")), "g").select("taxon_id", "rep")
    found = refine.recursive_refine(members, refine.measured_on(aln), refine.by_kmeans(v), "k", 4.0, min_size=4, max_gap=0.3, best=True)
    return found.clusters.select("name", "parent", "rep", "size", "depth", "threshold", "outcome", "kept_because")


QUERIES = {f.__name__: f for f in (c23_recursive_refine, c24_recursive_refine_plm, c25_report)}

_DEPTHS = 3
_KEYS = "CASE tau WHEN 0.5 THEN p_type WHEN 0.6 THEN p_type || odd ELSE p_type || odd || p_name END"


def _level(i: int) -> str:
    """Statistics, attempts, log and clusters of a depth, and the members of the next."""
    kept = f"""s{i} AS (SELECT k, count(*) AS size, min(taxon) AS rep, sum(len) AS letters, list_sort(list(len))[count(*) // 2 + 1] AS median, any_value(thr) AS thr FROM l{i} GROUP BY k),
u{i} AS (SELECT k, sum(m) AS used FROM (SELECT k, slot, max(len) AS m FROM l{i} GROUP BY k, slot) GROUP BY k),
q{i} AS (SELECT *, round((size * used - letters) / (size * used), 4) AS gap, round(used / greatest(median, 1), 2) AS expansion FROM s{i} JOIN u{i} USING (k)),
n{i} AS (SELECT *, gap >= {LIMITS["max_gap"]} OR expansion > 3 AS over FROM q{i}),
a{i} AS (SELECT k, tau, count(*) AS subs, coalesce(sum(n) FILTER (n >= 4), 0) / any_value(size) AS share FROM (
  SELECT k, tau, {_KEYS} AS sub, count(*) AS n, any_value(size) AS size FROM l{i} JOIN n{i} USING (k), (VALUES (0.5), (0.6), (0.7)) AS v(tau) WHERE over AND size >= {2 * LIMITS["min_size"]} AND {i} < 2 AND tau > n{i}.thr GROUP BY ALL) GROUP BY k, tau),
t{i} AS (SELECT k, min(tau) AS tau FROM a{i} WHERE subs > 1 AND share >= 0.7 GROUP BY k),
g{i} AS (SELECT a.k, count(*) AS attempts FROM a{i} a LEFT JOIN t{i} t USING (k) WHERE t.tau IS NULL OR a.tau <= t.tau GROUP BY a.k),
c{i} AS (SELECT n{i}.*, {i} AS depth, t.tau AS to_threshold, a.subs, round(a.share, 3) AS share, coalesce(g.attempts, 0) AS tries, CASE WHEN t.tau IS NOT NULL THEN 'split' WHEN over AND size >= {2 * LIMITS["min_size"]} AND {i} < 2 THEN 'not_divisible' ELSE 'kept' END AS outcome
  FROM n{i} LEFT JOIN t{i} t USING (k) LEFT JOIN a{i} a ON a.k = n{i}.k AND a.tau = t.tau LEFT JOIN g{i} g ON g.k = n{i}.k)"""
    more = f""",
l{i + 1} AS (SELECT l.* EXCLUDE (k, thr), l.k || '|' || {_KEYS.replace("tau", "t.tau")} AS k, t.tau AS thr FROM l{i} l JOIN t{i} t USING (k))"""
    return kept + (more if i + 1 < _DEPTHS else "")


_REFINED = f"""WITH l0 AS (SELECT 'p' || p_partkey AS taxon, p_brand AS k, 0.4 AS thr, p_type, p_name, (p_size % 2)::VARCHAR AS odd, length(regexp_replace(lower(p_name), '[^a-z]', '', 'g')) AS len, greatest(coalesce(list_position({list(SLOTS)}, p_type), 1) - 1, 0) AS slot FROM part),
{",".join(_level(i) for i in range(_DEPTHS))},
every AS (SELECT *, size AS s0, rep AS r0, NULL::BIGINT AS s1, NULL AS r1, NULL::BIGINT AS s2, NULL AS r2, NULL AS up FROM c0
  UNION ALL SELECT c1.*, c0.size, c0.rep, c1.size, c1.rep, NULL, NULL, c0.k FROM c1 JOIN c0 ON starts_with(c1.k, c0.k || '|')
  UNION ALL SELECT c2.*, c0.size, c0.rep, c1.size, c1.rep, c2.size, c2.rep, c1.k FROM c2 JOIN c1 ON starts_with(c2.k, c1.k || '|') JOIN c0 ON starts_with(c1.k, c0.k || '|')),
named AS (SELECT *, 'cluster_' || row_number() OVER (ORDER BY -s0, r0, -s1 NULLS FIRST, r1 NULLS FIRST, -s2 NULLS FIRST, r2 NULLS FIRST) || '_tm' || thr AS name FROM every)"""

SQL = {
    "c23_recursive_refine": f"{_REFINED} SELECT n.name, p.name AS parent, n.rep, n.size, n.depth, n.thr::DOUBLE AS threshold, n.outcome, n.gap AS gap_fraction, n.to_threshold::DOUBLE AS to_threshold, coalesce(n.subs, 0) AS sub_clusters, n.share AS kept, CASE WHEN n.outcome <> 'kept' THEN n.tries ELSE 0 END::INT AS attempts FROM named n LEFT JOIN named p ON p.k = n.up",
    "c25_report": f"{_REFINED} SELECT name, size >= 4 AS eligible, over, CASE WHEN over THEN CASE WHEN outcome = 'not_divisible' THEN 'no split kept enough taxa in clusters of 4+' WHEN depth >= 2 THEN 'recursion depth limit reached' ELSE 'too small to split' END END AS kept_because FROM named WHERE outcome <> 'split'",
}
