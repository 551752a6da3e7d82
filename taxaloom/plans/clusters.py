"""Queries C, second part: clusterings, sweeps, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import clusters as op, distances
from taxaloom.plans import adapters as ad
from taxaloom.session import cut, table


def c1_embedding_pairs(spark, d):
    return distances.pairs(ad.vectors(spark, d), "cosine", by=("label",)).select("label", "a", "b", ad.to_six("d").alias("d"))


def c1_near_pairs(spark, d):
    found, _ = distances.near_pairs(ad.vectors(spark, d), 0.6, rows=200)
    return found.select("a", "b", F.round("d", 6).alias("d"))


def c4_cluster_from_pairs(spark, d):
    p = table(spark, d, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey")).alias("a"), F.concat(F.lit("s"), F.col("l_partkey") % 100).alias("b"), F.col("l_discount").alias("score"), F.lit(1.0).alias("coverage"))
    taxa = p.select(F.col("a").alias("taxon_id")).union(p.select("b")).distinct()
    return op.cluster_from_pairs(p, taxa, "evalue", 0.001)


def c3_sequence_cluster(spark, d):
    s = ad.part_alignment(spark, d).select("taxon_id", F.translate("row", "-", "").alias("seq"))
    return op.sequence_cluster(s, 0.95, 0.8)


def c5_plm_cluster(spark, d):
    return op.plm_cluster(ad.vectors(spark, d), 8).groupBy("label").agg(F.count("*").alias("n"))


def _datasets(spark, d):
    return ad.vectors(spark, d).select(F.concat(F.lit("l"), F.col("label")).alias("dataset"), "taxon_id", "vec")


def c8_linkage(spark, d):
    return op.linkage(_datasets(spark, d)).select("dataset", "step", "a", "b", F.round("height", 6).alias("height"), "size")


def c9_neighbor_joining(spark, d):
    e = op.neighbor_joining(_datasets(spark, d))
    return e.groupBy("dataset").agg(F.count("taxon_id").alias("leaves"), F.count("*").alias("edges"), F.count_distinct("parent").alias("joins"))


def c9_additive_trees(spark, d):
    """Distances along a tree of segments and bands of a nation's customers give that tree back: its leaves and its length."""
    c = table(spark, d, "customer").select(F.concat(F.lit("n"), F.col("c_nationkey")).alias("dataset"), F.ascii("c_mktsegment").alias("seg"), F.floor(F.col("c_acctbal") / 2000).cast("int").alias("band")).distinct()
    segs = F.transform(F.sequence(F.lit(0), F.lit(36)), lambda k: F.when(F.col("seg") % 37 == k, 0.5).otherwise(0.0))
    own = F.transform(F.sequence(F.lit(0), F.lit(37 * 8 - 1)), lambda k: F.when((F.col("seg") % 37) * 8 + F.col("band") + 1 == k, 1.0 + F.col("band") / 4).otherwise(0.0))
    p = c.select("dataset", F.concat_ws("/", "seg", "band").alias("taxon_id"), F.concat(segs, own).alias("vec"))
    e = op.neighbor_joining(p, "l1")
    return e.groupBy("dataset").agg(F.count("taxon_id").alias("leaves"), F.round(F.sum("length"), 6).alias("length"))


def c10_cut_tree(spark, d):
    return op.cut_tree(op.linkage(_datasets(spark, d)), 4)


def c11_silhouette_profile(spark, d):
    p = _datasets(spark, d)
    return op.silhouette_profile(p, cut(op.linkage(p)), 10)


def c16_sweep(spark, d):
    v = ad.vectors(spark, d)
    found = op.sweep_near(v, ["label"], [0.2, 0.5, 0.8], {"vectors": v}, 4)
    return found.select("candidate_id", "threshold", "grid_pos", "n_clusters", "usable", "retained_fraction", F.round(F.col("silhouette")["vectors"], 6).alias("silhouette"))


def c17_sweep_k(spark, d):
    return op.sweep_k(ad.vectors(spark, d), 2, 8).select("candidate_id", "n_clusters", "usable", "silhouette_all", "chosen", "relaxed")


def c29_project_2d(spark, d):
    """By how much the plane's axes are stretched is undone: variances along them are the largest two of the cloud's."""
    p = op.project_2d(ad.vectors(spark, d))
    r = p.agg(*[f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max))], F.corr("x", "y").alias("corr"), F.count("*").alias("n"))
    return r.select("n", *[F.round(c, 4).alias(c) for c in ("lo_x", "hi_x", "lo_y", "hi_y")], (F.abs("corr") < 1e-6).alias("apart"))


def c30_embed_sequences(spark, d):
    return op.embed_sequences(ad.sequences(spark, d)).select("taxon_id", F.posexplode("vec").alias("i", "x")).where("x > 0").select("taxon_id", "i", F.round("x", 9).alias("x"))


def _make_encoder():
    """A model of two numbers a token, from its letter and its place."""
    return lambda texts: [[(ord(c) % 7, (i + 1) % 5) for i, c in enumerate(t)] for t in texts]


def i2_embed_with(spark, d):
    return op.embed_with(ad.sequences(spark, d), _make_encoder).select("taxon_id", F.round(F.get("vec", F.lit(0)), 6).alias("a"), F.round(F.get("vec", F.lit(1)), 6).alias("b"))


def i3_metrics(spark, d):
    v = ad.vectors(spark, d)
    s = distances.summaries(v, ["euclidean", "l1", "largest"], ["label"])
    return s.select("metric", "label", "n", F.round("total", 4).alias("total"), F.round("most", 6).alias("most"))


def _by_number(vectors, threshold, coverage):
    """A clusterer of a user's: numbers in runs of the threshold; under 1 it fails."""
    if threshold < 1:
        raise ValueError("no runs under one")
    run = F.floor(F.col("ord") / threshold)
    return vectors.join(vectors.groupBy(run.alias("run")).agg(F.min("taxon_id").alias("rep")), run == F.col("run")).select("taxon_id", "rep")


def i1_callback_sweep(spark, d):
    v = cut(ad.vectors(spark, d))
    found, failed = op.sweep_with(v, _by_number, [(5, 0.0), (0.5, 0.0), (40, 0.5), (100, 0.0)], {"vectors": v}, 10)
    columns = ["candidate_id", "threshold", "grid_pos", "n_clusters", "usable", "retained_fraction", "error"]
    return found.withColumn("error", F.lit(None).cast("string")).select(*columns).unionByName(failed.select("candidate_id", "threshold", F.lit(-1).alias("grid_pos"), *[F.lit(-1).cast("long").alias(c) for c in ("n_clusters", "usable")], F.lit(None).cast("double").alias("retained_fraction"), "error"))


QUERIES = {k: f for k, f in globals().items() if k[:1] in "ci" and k[1:2].isdigit()}

SQL = {
    "c1_embedding_pairs": f"WITH {ad.VECTORS}, u AS (SELECT label, taxon_id, list_transform(vec, lambda x: x / greatest(sqrt(list_dot_product(vec, vec)), 1e-12)) AS u FROM vectors) SELECT x.label, x.taxon_id AS a, y.taxon_id AS b, round(1 - greatest(-1, least(1, list_dot_product(x.u, y.u))), 6) AS d FROM u x JOIN u y ON x.label = y.label AND x.taxon_id < y.taxon_id",
    "c1_near_pairs": f"WITH {ad.VECTORS}, u AS (SELECT taxon_id, list_transform(vec, lambda x: x / greatest(sqrt(list_dot_product(vec, vec)), 1e-12)) AS u FROM vectors) SELECT a, b, round(d, 6) AS d FROM (SELECT x.taxon_id AS a, y.taxon_id AS b, 1 - greatest(-1, least(1, list_dot_product(x.u, y.u))) AS d FROM u x JOIN u y ON x.taxon_id < y.taxon_id) WHERE d <= 0.6",
    "c9_neighbor_joining": f"WITH {ad.VECTORS} SELECT 'l' || label AS dataset, count(*) AS leaves, CASE count(*) WHEN 2 THEN 2 ELSE 2 * count(*) - 3 END AS edges, greatest(count(*) - 2, 1) AS joins FROM vectors GROUP BY label HAVING count(*) > 1",
    "c9_additive_trees": """WITH c AS (SELECT DISTINCT 'n' || c_nationkey AS dataset, ascii(c_mktsegment) AS seg, floor(c_acctbal / 2000)::INT AS band FROM customer),
s AS (SELECT dataset, seg, count(*) AS n, sum(1 + band / 4) AS len FROM c GROUP BY ALL)
SELECT dataset, sum(n)::BIGINT AS leaves, round(sum(len) + CASE WHEN count(*) > 1 THEN 0.5 * count(*) ELSE 0 END, 6) AS length FROM s GROUP BY dataset HAVING sum(n) > 1""",
    "c29_project_2d": f"WITH {ad.VECTORS} SELECT count(*) AS n, -500::DOUBLE AS lo_x, 500::DOUBLE AS hi_x, -500::DOUBLE AS lo_y, 500::DOUBLE AS hi_y, true AS apart FROM vectors",
    "c30_embed_sequences": f"""WITH {ad.SEQUENCES}, m AS (SELECT taxon_id, left(seq, 1024) AS s, unnest(range(1, greatest(length(left(seq, 1024)) - 2, 1) + 1)) AS i FROM sequences),
h AS (SELECT taxon_id, list_reduce(list_concat([0::BIGINT], list_transform([0, 1, 2], lambda j: coalesce(ascii(nullif(substr(s, i + j, 1), '')), 0)::BIGINT)), lambda a, c: (a * {op.HASH_FACTOR} + c) % {op.HASH_PRIME}) % 64 AS i FROM m)
SELECT taxon_id, i::INT AS i, round(count(*) / sum(count(*)) OVER (PARTITION BY taxon_id), 9) AS x FROM h GROUP BY taxon_id, i""",
    "i1_callback_sweep": f"""WITH {ad.VECTORS}, g(candidate_id, threshold, grid_pos) AS (VALUES ('g0', 5.0::DOUBLE, 0), ('g2', 40.0, 2), ('g3', 100.0, 3)), s AS (SELECT candidate_id, threshold, grid_pos, ord // threshold::BIGINT AS run, count(*) AS n FROM g, vectors GROUP BY ALL)
SELECT candidate_id, threshold, grid_pos, count(*) AS n_clusters, count(*) FILTER (n >= 10) AS usable, round(coalesce(sum(n) FILTER (n >= 10), 0) / sum(n), 4) AS retained_fraction, NULL AS error FROM s GROUP BY ALL UNION ALL SELECT 'g1', 0.5, -1, -1, -1, NULL, 'ValueError: no runs under one'""",
    "i2_embed_with": f"""WITH {ad.SEQUENCES}, c AS (SELECT taxon_id, length(left(seq, 1024)) AS n, seq, unnest(range(1, length(left(seq, 1024)) + 1)) AS i FROM sequences)
SELECT taxon_id, round(avg(ascii(substr(seq, i, 1)) % 7), 6) AS a, round(avg(i % 5), 6) AS b FROM c WHERE n <= 2 OR (i > 1 AND i < n) GROUP BY taxon_id""",
    "i3_metrics": f"""WITH {ad.VECTORS}, p AS (SELECT x.label, list_transform(list_zip(x.vec, y.vec), lambda z: abs(z[1] - z[2])) AS g FROM vectors x JOIN vectors y ON x.label = y.label AND x.taxon_id < y.taxon_id),
m AS (SELECT 'euclidean' AS metric, label, sqrt(list_sum(list_transform(g, lambda z: z * z))) AS d FROM p UNION ALL SELECT 'l1', label, list_sum(g) FROM p UNION ALL SELECT 'largest', label, list_max(g) FROM p)
SELECT metric, label, count(*) AS n, round(sum(d), 4) AS total, round(max(d), 6) AS most FROM m GROUP BY ALL""",
}
