"""Queries C, first part: scoring and selection of partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import partitions as op
from taxaloom.plans import adapters as ad
from taxaloom.session import table


def _reps(spark, d):
    """Suppliers are clusters of parts: the least part of a supplier's first line is its name."""
    return table(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("taxon_id"), F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("n"), F.col("c_nationkey"))).alias("rep"))


def c2_scores_to_distance(spark, d):
    from taxaloom.operators.distances import scores_to_distance
    return scores_to_distance(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 100).alias("b"), (F.col("l_discount") * 10).alias("score")))


def c6_medoids(spark, d):
    return op.medoids(_points(spark, d)).select("candidate_id", "label", "size")


def c7_label_partition(spark, d):
    m = _reps(spark, d)
    return op.label_partition(m.where("rep is not null"), m)


def c12_shape(spark, d):
    return op.shape(ad.memberships(spark, d), 10).withColumn("sizes", F.array_join(F.col("sizes").cast("array<string>"), ","))


def _points(spark, d):
    return ad.memberships(spark, d).join(ad.vectors(spark, d).select("taxon_id", "vec"), "taxon_id")


def c13_silhouette(spark, d):
    return op.silhouette(_points(spark, d)).select("candidate_id", F.round("silhouette", 6).alias("silhouette"))


def c14_scoped_silhouette(spark, d):
    return op.scoped_silhouette(_points(spark, d), 30).select("candidate_id", F.round("silhouette", 6).alias("silhouette"))


def c15_score(spark, d):
    s = op.score(ad.memberships(spark, d), {"vectors": ad.vectors(spark, d)}, 10)
    return s.select("candidate_id", "n_clusters", "usable", "retained_fraction", F.round(F.col("silhouette")["vectors"], 6).alias("silhouette"))


def _candidates(spark, d):
    """Runs and candidates out of orders: a run per customer, a candidate per order; scores by rule."""
    o = table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("grid_pos"), ((F.col("o_orderkey") * 37 % 101) / 100).alias("retained_fraction"), (F.col("o_orderkey") * 13 % 9).alias("usable"),
                    F.create_map(F.lit("esm2"), F.when(F.col("o_orderpriority") != "1-URGENT", (F.col("o_orderkey") * 29 % 97) / 100), F.lit("tm"), (F.col("o_orderkey") * 53 % 89) / 100).alias("silhouette"))


def c18_select(spark, d):
    c = _candidates(spark, d)
    return op.explain_selection(op.select(c, "esm2"), c, "esm2").select("run", "grid_pos", "relaxed", "reason", "recommendation")


def c19_alternative(spark, d):
    c = _candidates(spark, d)
    return op.explain_alternative(op.alternative(c, op.select(c, "esm2"))).select("run", "base_pos", "grid_pos", "rationale")


def c20_summary(spark, d):
    return op.summary(_candidates(spark, d).withColumn("members", F.array("run"))).select("run", "grid_pos", "usable")


def c21_schedule(spark, d):
    li = table(spark, d, "lineitem")
    return op.schedule(li.select(F.element_at(F.array(F.lit("evalue"), F.lit("tmscore"), F.lit("min_seq_id")), (F.col("l_linenumber") % 3 + 1)).alias("kind"), F.round(F.col("l_discount") * 10, 2).alias("threshold")).distinct()).select("kind", "threshold", "next", F.array_join(F.col("schedule").cast("array<string>"), ",").alias("schedule"))


def _subs(spark, d):
    """Splits of a parent (order) into sub-clusters (lines), as many attempts as return flags."""
    li = table(spark, d, "lineitem")
    total = li.groupBy("l_orderkey").agg(F.sum("l_quantity").cast("long").alias("parent_size"))
    return li.join(total, "l_orderkey").select(F.col("l_orderkey").alias("parent"), F.col("l_returnflag").alias("attempt"), F.col("l_quantity").cast("long").alias("size"), "parent_size")


def c22_fraction_kept(spark, d):
    return op.fraction_kept(_subs(spark, d)).withColumn("kept", F.round("kept", 6))


def c26_cluster_name(spark, d):
    s = ad.memberships(spark, d).groupBy("candidate_id", "label").agg(F.count("*").alias("size"), F.min("taxon_id").alias("rep"))
    return op.cluster_name(s, "evalue", 1.0).select("candidate_id", "label", "name")


def c27_operating_point(spark, d):
    s = op.shape(ad.memberships(spark, d), 10).select("candidate_id", "n_clusters")
    return op.operating_point(s, ad.vectors(spark, d), "auto", "evalue")


def c28_align_spaces(spark, d):
    v = ad.vectors(spark, d)
    return op.align_spaces([v, v.where("label <> 3"), v.where("label <> 5")])


def c31_disagreement(spark, d):
    return op.disagreement(_candidates(spark, d), "esm2")


QUERIES = {k: f for k, f in globals().items() if k[:1] == "c" and k[1:2].isdigit()}

_PCT = "(round({0} * 100)::BIGINT || '%')"
_CAND = """candidates AS (SELECT o_custkey AS run, o_orderkey AS grid_pos, (o_orderkey * 37 % 101) / 100 AS retained_fraction, o_orderkey * 13 % 9 AS usable, CASE WHEN o_orderpriority <> '1-URGENT' THEN (o_orderkey * 29 % 97) / 100 END AS esm2, (o_orderkey * 53 % 89) / 100 AS tm FROM orders),
flagged AS (SELECT *, retained_fraction >= 0.7 AND usable >= 2 AS feasible, coalesce(esm2, tm, -1) AS s FROM candidates),
pool AS (SELECT *, NOT bool_or(feasible) OVER (PARTITION BY run) AS relaxed FROM flagged QUALIFY feasible OR relaxed),
chosen AS (SELECT * FROM pool QUALIFY row_number() OVER (PARTITION BY run ORDER BY CASE WHEN relaxed THEN retained_fraction ELSE s END DESC, CASE WHEN relaxed THEN s ELSE retained_fraction END DESC, CASE WHEN relaxed THEN 0 ELSE usable END DESC, grid_pos) = 1)"""
_SIL = """units AS (SELECT taxon_id, list_transform(vec, lambda x: x / greatest(sqrt(list_dot_product(vec, vec)), 1e-12)) AS u FROM vectors),
pts AS (SELECT m.*, u FROM {0} m JOIN units USING (taxon_id)),
sums AS (SELECT candidate_id, label AS c, count(*) AS n0, i, sum(u[i]) AS s FROM (SELECT *, unnest(range(1, len(u) + 1)) AS i FROM pts) GROUP BY ALL),
cl AS (SELECT candidate_id, c, max(n0) AS n, list(s ORDER BY i) AS s FROM sums GROUP BY ALL),
met AS (SELECT p.candidate_id, taxon_id, label, c, n, list_dot_product(u, s) AS us, list_dot_product(u, u) AS uu FROM pts p JOIN cl ON p.candidate_id = cl.candidate_id),
each AS (SELECT candidate_id, taxon_id, label, max(CASE WHEN c = label AND n > 1 THEN (n - us - (1 - uu)) / (n - 1) END) AS a, min(CASE WHEN c <> label THEN 1 - us / n END) AS b FROM met GROUP BY ALL),
sil AS (SELECT candidate_id, CASE WHEN count(DISTINCT label) >= 2 AND count(*) > count(DISTINCT label) THEN round(avg(CASE WHEN a IS NULL THEN 0 WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) END AS silhouette FROM each GROUP BY 1)"""
_SHAPE = """sizes AS (SELECT candidate_id, label, count(*) AS n FROM memberships GROUP BY ALL),
shape AS (SELECT candidate_id, count(*) AS n_clusters, list(n ORDER BY n DESC)[1:25] AS sizes, max(n) AS largest, count(*) FILTER (n = 1) AS singletons, count(*) FILTER (n >= 10) AS usable, CAST(sum(n) AS BIGINT) AS taxa_total, CAST(coalesce(sum(n) FILTER (n >= 10), 0) AS BIGINT) AS taxa_retained, CAST(0 AS BIGINT) AS unassigned, round(coalesce(sum(n) FILTER (n >= 10), 0) / sum(n), 4) AS retained_fraction FROM sizes GROUP BY 1)"""
_V = f"{ad.VECTORS}, {ad.MEMBERSHIPS}"
_BIG = "big AS (SELECT * FROM memberships QUALIFY count(*) OVER (PARTITION BY candidate_id, label) >= {0})"

SQL = {
    "c2_scores_to_distance": "SELECT least(l_suppkey, l_partkey % 100) AS a, greatest(l_suppkey, l_partkey % 100) AS b, min(greatest(0.0, least(1.0, 1 - l_discount * 10))) AS d FROM lineitem WHERE l_suppkey <> l_partkey % 100 GROUP BY ALL HAVING d < 1",
    "c6_medoids": f"WITH {_V} SELECT candidate_id, label, count(*) AS size FROM memberships GROUP BY ALL",
    "c7_label_partition": "WITH m AS (SELECT 'c' || c_custkey AS taxon_id, CASE WHEN c_acctbal >= 0 THEN 'n' || c_nationkey END AS rep FROM customer), r AS (SELECT rep, CAST(row_number() OVER (ORDER BY rep) - 1 AS INT) AS label FROM (SELECT DISTINCT rep FROM m WHERE rep IS NOT NULL)) SELECT taxon_id, coalesce(label, -1) AS label FROM m LEFT JOIN r USING (rep)",
    "c12_shape": f"WITH {_V}, {_SHAPE} SELECT * REPLACE (array_to_string(sizes, ',') AS sizes) FROM shape",
    "c13_silhouette": f"WITH {_V}, {_SIL.format('memberships')} SELECT * FROM sil",
    "c14_scoped_silhouette": f"WITH {_V}, {_BIG.format(30)}, {_SIL.format('big')} SELECT candidate_id, silhouette FROM (SELECT DISTINCT candidate_id FROM memberships) LEFT JOIN sil USING (candidate_id)",
    "c15_score": f"WITH {_V}, {_SHAPE}, {_BIG.format(10)}, {_SIL.format('big')} SELECT candidate_id, n_clusters, usable, retained_fraction, silhouette FROM shape LEFT JOIN sil USING (candidate_id)",
    "c18_select": f"""WITH {_CAND}, t AS (SELECT run, max(retained_fraction) AS top FROM candidates GROUP BY run)
SELECT run, grid_pos, relaxed, CASE WHEN relaxed THEN 'limits not met: keeps the most taxa (' || {_PCT.format('retained_fraction')} || '), since the best silhouette would belong to the most fragmented partition' ELSE 'best esm2 silhouette of the partitions that keep 70% of taxa in clusters of 10+' END AS reason,
  CASE WHEN relaxed THEN 'no partition kept 70% of taxa in clusters of 10+; the best kept ' || {_PCT.format('top')} || ': look for smaller clusters, cluster by structure, or take it that the set has no such groups' END AS recommendation FROM chosen JOIN t USING (run)""",
    "c19_alternative": f"WITH {_CAND}, v AS (SELECT c.run, h.grid_pos AS base_pos, c.grid_pos, c.usable, c.retained_fraction AS r, h.retained_fraction AS b FROM candidates c JOIN chosen h ON c.run = h.run AND c.retained_fraction >= h.retained_fraction + 0.1 AND c.usable >= greatest(2, floor(h.usable * 0.75)) AND c.grid_pos <> h.grid_pos), n AS (SELECT * FROM v QUALIFY r >= max(r) OVER (PARTITION BY run) - 0.03) SELECT run, base_pos, grid_pos, 'keeps ' || {_PCT.format('r')} || ' of taxa instead of ' || {_PCT.format('b')} || ' (+' || round((r - b) * 100)::BIGINT || ' points) in ' || usable || ' clusters of 10+, which are less clearly apart: for aligning as many taxa as possible' AS rationale FROM n QUALIFY row_number() OVER (PARTITION BY run ORDER BY usable DESC, r DESC, grid_pos) = 1",
    "c20_summary": f"WITH {_CAND} SELECT run, grid_pos, usable FROM candidates",
    "c22_fraction_kept": "WITH t AS (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS ps FROM lineitem GROUP BY 1), g AS (SELECT l_orderkey AS parent, l_returnflag AS attempt, count(*) AS n_sub, coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_quantity >= 4), 0) / max(ps) AS k FROM lineitem JOIN t USING (l_orderkey) GROUP BY ALL) SELECT parent, attempt, n_sub, round(k, 6) AS kept, n_sub > 1 AND k >= 0.7 AS accepted FROM g",
    "c21_schedule": """WITH p AS (SELECT DISTINCT ['evalue', 'tmscore', 'min_seq_id'][l_linenumber % 3 + 1] AS kind, round(l_discount * 10, 2) AS threshold FROM lineitem),
g AS (SELECT *, CASE kind WHEN 'evalue' THEN [0.001, 0.01, 1.0, 10.0]::DOUBLE[] WHEN 'tmscore' THEN [0.4, 0.5, 0.6, 0.7]::DOUBLE[] ELSE [0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[] END AS grid FROM p),
s AS (SELECT *, CASE WHEN kind = 'evalue' THEN list_max(list_filter(grid, lambda t: t < threshold)) ELSE list_min(list_filter(grid, lambda t: t > threshold)) END AS next,
  CASE WHEN kind = 'evalue' THEN list_concat([threshold], list_reverse_sort(list_filter([10.0, 1.0, 0.3, 0.1, 0.03, 0.01, 0.001]::DOUBLE[], lambda t: t < threshold))) ELSE list_sort(list_filter(grid, lambda t: t > threshold)) END AS plan FROM g)
SELECT kind, threshold, next, array_to_string(plan[1:3], ',') AS schedule FROM s""",
    "c26_cluster_name": f"WITH {_V}, s AS (SELECT candidate_id, label, count(*) AS size, min(taxon_id) AS rep FROM memberships GROUP BY ALL) SELECT candidate_id, label, 'cluster_' || row_number() OVER (PARTITION BY candidate_id ORDER BY size DESC, rep) || '_e1' AS name FROM s",
    "c27_operating_point": f"WITH {_V} SELECT candidate_id, count(DISTINCT label) AS n_clusters, (SELECT count(*) FROM vectors) AS taxa, 'auto' AS mode, 'evalue' AS threshold_kind, 'e-values depend on the size of the set: compare runs of like size only' AS note FROM memberships GROUP BY 1",
    "c28_align_spaces": f"WITH {ad.VECTORS} SELECT taxon_id FROM vectors WHERE label NOT IN (3, 5)",
    "c31_disagreement": f"WITH {_CAND} , k AS (SELECT p.run, h.grid_pos AS primary_pos, p.grid_pos AS other_pos FROM pool p JOIN chosen h ON p.run = h.run QUALIFY row_number() OVER (PARTITION BY p.run ORDER BY coalesce(p.tm, -1) DESC, p.grid_pos) = 1) SELECT run, 'tm' AS space, primary_pos, other_pos FROM k WHERE primary_pos <> other_pos",
}
