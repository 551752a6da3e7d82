"""Queries F: metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import alignment, metadata as op
from taxaloom.plans import adapters as ad
from taxaloom.session import table


def _part(spark, d):
    return table(spark, d, "part")


def f1_find_id_column(spark, d):
    p = _part(spark, d)
    return op.find_id_column(p.select("p_brand", "p_type", "p_partkey", "p_name"), p.where("p_size > 20").select(F.col("p_partkey").cast("string").alias("name")))


def f2_classify_columns(spark, d):
    return op.classify_columns(_part(spark, d), "p_partkey").select("column", "kind", "cardinality", F.round("min", 4).alias("min"), F.round("max", 4).alias("max"))


def f3_assign_palette(spark, d):
    v = op.melt(_part(spark, d).select("p_partkey", "p_brand", "p_type"), "p_partkey").select("column", "value").distinct()
    return op.assign_palette(v, v.where("column = 'p_brand'").select("column", "value", F.length("value").alias("fixed_slot")))


def f4_default_colour_column(spark, d):
    p = _part(spark, d)
    order = op.melt(p, "p_partkey").groupBy("column").agg(F.min("ord").alias("ord"))
    return op.default_colour_column(op.classify_columns(p, "p_partkey").join(order, "column"))


def f5_normalise_values(spark, d):
    return op.normalise_values(op.melt(_part(spark, d), "p_partkey")).select("p_partkey", "column", "number", "text")


def f6_enrich_missing(spark, d):
    p = _part(spark, d)
    gaps = p.select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_brand")).alias("p_brand"))
    return op.enrich_missing(gaps, p.select("p_partkey", F.col("p_type").alias("p_brand")), "p_partkey", ["p_brand"])


def f7_from_structures(spark, d):
    li = table(spark, d, "lineitem")
    return op.from_structures(li.select(F.col("l_orderkey").alias("taxon"), F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("idx"), F.when(F.col("l_linenumber") > 2, F.col("l_quantity")).alias("confidence")))


def _leaves(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey") % 5
    return c.select(F.when(k == 0, F.col("c_name")).when(k == 1, F.upper("c_name")).when(k == 2, F.replace("c_name", F.lit("#"), F.lit("-"))).when(k == 3, F.concat("c_name", F.lit("|chain A"))).otherwise(F.concat(F.lit("x"), "c_name")).alias("leaf")), c.select(F.col("c_name").alias("meta_id"), "c_mktsegment")


def f8_match_to_leaves(spark, d):
    leaves, meta = _leaves(spark, d)
    return op.match_to_leaves(meta, leaves)


def f9_leaf_metadata(spark, d):
    leaves, meta = _leaves(spark, d)
    return op.leaf_metadata(leaves, op.match_to_leaves(meta, leaves), meta, "c_mktsegment")


def f10_filter_taxa(spark, d):
    p = _part(spark, d)
    gaps = p.withColumn("p_brand", F.when(F.col("p_size") > 5, F.col("p_brand")))
    return op.filter_taxa(op.filter_taxa(gaps, "p_brand", ["Brand#11", "Brand#23", "Unclassified"]), "p_retailprice", low=950.0, high=1500.0).select("p_partkey", "p_brand")


def f11_search_taxa(spark, d):
    return op.search_taxa(_part(spark, d).drop("p_retailprice"), "RED").select("p_partkey")


def f12_coverage_column(spark, d):
    cov = alignment.sequence_coverage(ad.part_alignment(spark, d), ["partition"])
    return op.coverage_column(cov.select("taxon_id"), cov, "taxon_id")


def f13_project(spark, d):
    p = _part(spark, d).withColumn("blank", F.when(F.col("p_size") > 25, F.lit(" ")).otherwise(F.col("p_brand")))
    return op.project(p, {"id": (["p_partkey"], ""), "family": (["blank", "p_type"], "Unknown"), "host": (["blank"], "Unknown")})


def f14_category_summary(spark, d):
    return op.category_summary(_part(spark, d).withColumn("conf", F.when(F.col("p_size") > 5, F.col("p_size").cast("double"))), "p_brand", "conf")


def f15_scale(spark, d):
    return op.scale(_part(spark, d), "p_retailprice", ["p_brand"]).select("p_partkey", F.round("scaled", 6).alias("scaled"))


def f16_filter_report(spark, d):
    return op.filter_report(_part(spark, d), F.col("p_size") > 20, ["p_brand"])


QUERIES = {k: f for k, f in globals().items() if k[:1] == "f" and k[1:2].isdigit()}

_MELT = "cells AS (SELECT p_partkey, 'p_name' AS \"column\", 0 AS ord, p_name AS value FROM part UNION ALL SELECT p_partkey, 'p_brand', 1, p_brand FROM part UNION ALL SELECT p_partkey, 'p_type', 2, p_type FROM part UNION ALL SELECT p_partkey, 'p_size', 3, CAST(p_size AS VARCHAR) FROM part UNION ALL SELECT p_partkey, 'p_retailprice', 4, CAST(p_retailprice AS VARCHAR) FROM part)"
_SPEC = "spec AS (SELECT \"column\", min(ord) AS ord, count(*) AS n, count(TRY_CAST(value AS DOUBLE)) AS numeric, count(DISTINCT value) AS cardinality, min(TRY_CAST(value AS DOUBLE)) AS lo, max(TRY_CAST(value AS DOUBLE)) AS hi FROM cells GROUP BY 1), specs AS (SELECT *, CASE WHEN n = numeric AND cardinality > 8 THEN 'continuous' WHEN cardinality <= 65 THEN 'categorical' ELSE 'text' END AS kind FROM spec)"
_LEAF = "leaves AS (SELECT c_name, c_custkey, c_mktsegment, CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN upper(c_name) WHEN 2 THEN replace(c_name, '#', '-') WHEN 3 THEN c_name || '|chain A' ELSE 'x' || c_name END AS leaf FROM customer)"

SQL = {
    "f1_find_id_column": "SELECT 'p_partkey' AS \"column\", count(*) AS records, count(*) FILTER (p_size > 20) AS hits, count(DISTINCT p_partkey) AS distinct FROM part",
    "f2_classify_columns": f"WITH {_MELT}, {_SPEC} SELECT \"column\", kind, cardinality, CASE WHEN kind = 'continuous' THEN round(lo, 4) END AS min, CASE WHEN kind = 'continuous' THEN round(hi, 4) END AS max FROM specs",
    "f3_assign_palette": f"WITH {_MELT}, v AS (SELECT DISTINCT \"column\", value FROM cells WHERE \"column\" IN ('p_brand', 'p_type')) SELECT \"column\", value, CASE WHEN \"column\" = 'p_brand' THEN length(value) ELSE (row_number() OVER (PARTITION BY \"column\" ORDER BY value) - 1) % 40 END AS slot FROM v",
    "f4_default_colour_column": f"WITH {_MELT}, {_SPEC} SELECT \"column\" FROM specs WHERE kind <> 'text' ORDER BY CASE WHEN kind = 'continuous' THEN 9 WHEN regexp_matches(lower(\"column\"), 'family|taxon|lineage|clade') THEN 0 WHEN regexp_matches(lower(\"column\"), 'class|fold|struct|cluster') THEN 1 WHEN regexp_matches(lower(\"column\"), 'bind|affinity|host|phenotype') THEN 2 WHEN cardinality BETWEEN 2 AND 30 THEN 7 ELSE 8 END, ord LIMIT 1",
    "f5_normalise_values": f"WITH {_MELT} SELECT p_partkey, \"column\", CASE WHEN TRY_CAST(value AS DOUBLE) = floor(TRY_CAST(value AS DOUBLE)) THEN TRY_CAST(value AS DOUBLE) ELSE round(TRY_CAST(value AS DOUBLE), 3) END AS number, CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS text FROM cells",
    "f6_enrich_missing": "SELECT p_partkey, CASE WHEN p_size > 10 THEN p_brand ELSE p_type END AS p_brand FROM part",
    "f7_from_structures": "SELECT l_orderkey AS taxon, coalesce(nullif(count(*) FILTER (l_linenumber > 1), 0), 300) AS length, coalesce(round(avg(l_quantity) FILTER (l_linenumber > 2), 2), 75.0) AS mean_confidence FROM lineitem GROUP BY 1",
    "f8_match_to_leaves": f"WITH {_LEAF} SELECT DISTINCT leaf, c_name AS meta_id, CAST(CASE c_custkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 4 END AS INT) AS rule FROM leaves WHERE c_custkey % 5 < 4",
    "f9_leaf_metadata": f"WITH {_LEAF} SELECT leaf, CASE WHEN c_custkey % 5 < 4 THEN c_mktsegment ELSE 'Unclassified' END AS c_mktsegment, c_custkey % 5 < 4 AS matched FROM leaves",
    "f10_filter_taxa": "SELECT p_partkey, CASE WHEN p_size > 5 THEN p_brand END AS p_brand FROM part WHERE (p_size <= 5 OR p_brand IN ('Brand#11', 'Brand#23')) AND p_retailprice BETWEEN 950 AND 1500",
    "f11_search_taxa": "SELECT p_partkey FROM part WHERE contains(lower(concat_ws(chr(10), p_partkey, p_name, p_brand, p_type, p_size)), 'red')",
    "f12_coverage_column": f"WITH {ad.PART_ALIGNMENT} SELECT taxon_id, round(100 * round(length(replace(row, '-', '')) / length(row), 4), 1) AS coverage_pct FROM part_alignment",
    "f13_project": "SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size > 25 THEN p_type ELSE p_brand END AS family, CASE WHEN p_size > 25 THEN 'Unknown' ELSE p_brand END AS host FROM part",
    "f14_category_summary": "SELECT p_brand, count(*) AS taxa, round(avg(CASE WHEN p_size > 5 THEN p_size ELSE 0 END), 4) AS mean_confidence FROM part GROUP BY 1",
    "f15_scale": "SELECT p_partkey, round((p_retailprice - min(p_retailprice) OVER w) / CASE WHEN max(p_retailprice) OVER w > min(p_retailprice) OVER w THEN max(p_retailprice) OVER w - min(p_retailprice) OVER w ELSE 1 END, 6) AS scaled FROM part WINDOW w AS (PARTITION BY p_brand)",
    "f16_filter_report": "SELECT p_brand, count(*) FILTER (p_size > 20) AS matching, count(*) AS total, round(100 * count(*) FILTER (p_size > 20) / count(*), 1) AS percent FROM part GROUP BY 1",
}
