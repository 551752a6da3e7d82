"""Queries E: search cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import hits as op
from taxaloom.plans import adapters as ad
from taxaloom.session import table

TIE = ["pos", "tie", "aln_length", "db"]


def e1_gate(spark, d):
    return op.gate(ad.hits(spark, d), 0.002, 10, 0.4).groupBy("query", "db").agg(F.count("*").alias("n"), F.sum("aln_length").alias("aligned"))


def _targets(spark, d):
    """Names as the databases write them; a few of each kind stand in the database of another."""
    h = table(spark, d, "lineitem")
    pdb = F.format_string("%dabc-assembly%d.cif.gz_%s Crystal structure", F.col("l_linenumber"), F.col("l_linenumber"), F.col("l_linestatus"))
    plain = F.when(F.col("l_linenumber") == 1, F.format_string("%dxyz_ some", F.col("l_linenumber"))).when(F.col("l_linenumber") == 2, F.format_string("entry%d x", F.col("l_linenumber"))).otherwise(pdb)
    t = F.when(F.col("l_returnflag") == "R", plain).when(F.col("l_returnflag") == "A", F.format_string("AF-Q%d-F1-model_v4", F.col("l_partkey"))).otherwise(F.format_string("af_P%d_%d_%d_3.40", F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_orderkey")))
    db = F.when(F.col("l_returnflag") == "R", F.when(F.col("l_linenumber") == 7, "bfvd_v3").otherwise("pdb100")).when(F.col("l_returnflag") == "A", F.when(F.col("l_linenumber") == 7, "bfvd_v3").otherwise("afdb50")).otherwise("cath50")
    return h.select(t.alias("target"), db.alias("db"))


def e2_accession(spark, d):
    return _targets(spark, d).select(op.accession(F.col("target"), F.col("db")).alias("accession")).groupBy("accession").agg(F.count("*").alias("n"))


def e3_cath_parent(spark, d):
    t = _targets(spark, d).where("db = 'cath50'").select(op.accession(F.col("target"), F.col("db")).alias("a"))
    return t.select(*op.cath_parent(F.col("a"))).groupBy("parent", "start").agg(F.count("*").alias("n"), F.max("end").alias("last"))


def e4_best_per_accession(spark, d):
    return op.best_per_accession(ad.hits(spark, d), TIE).select("query", "accession", F.round("evalue", 6).alias("evalue"), "pos")


def e5_exclude_self(spark, d):
    return op.exclude_self(ad.hits(spark, d)).groupBy("query").agg(F.count("*").alias("n"))


def e6_cap(spark, d):
    return op.cap(op.best_per_accession(ad.hits(spark, d), TIE), 50, ["accession"]).select("query", "accession", "short")


def e7_per_db(spark, d):
    h = ad.hits(spark, d)
    return op.per_db(h, op.gate(h, 0.002))


def e8_structure_kind(spark, d):
    dbs = F.array(*[F.lit(x) for x in ("pdb100", "bfvd_v3", "cath50", "BFVD", "afdb-proteome_folddisco")])
    return table(spark, d, "lineitem").select(op.structure_kind(F.get(dbs, (F.col("l_orderkey") % 5).cast("int"))).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def e9_confidence_plan(spark, d):
    return ad.hits(spark, d).select("db", op.confidence_plan(F.col("db")).alias("plan")).groupBy("db", "plan").agg(F.count("*").alias("n"))


def e10_cohort_counts(spark, d):
    return op.cohort_counts(ad.hits(spark, d).select("db", (F.col("aln_length") > 5).alias("ok"), op.confidence_plan(F.col("db")).alias("confidence")))


def e11_lddt_track(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", op.lddt_track(F.col("embedding").cast("array<double>"), (F.col("label") + 3).cast("int"), F.lit(80)).alias("t"))
    return e.select("vec_id", F.posexplode("t").alias("i", "v")).select("vec_id", "i", (F.round("v", 5) + 0.0).alias("v"))


def _taxonomy(spark, d):
    n, r, s = table(spark, d, "nation"), table(spark, d, "region"), table(spark, d, "supplier")
    hosts = s.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.array_sort(F.collect_list("s_name")).alias("hosts"))
    level = lambda rank, c: F.struct(F.lit(rank).alias("rank"), F.col(c).alias("name"))
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).join(hosts, "n_nationkey", "left").select(F.col("n_nationkey").alias("tax_id"), F.array(F.struct(F.lit("subgenus").alias("rank"), F.lower("n_name").alias("name")), level("family", "n_name"), level("clade", "n_name"), level("order", "r_name"), level("realm", "r_name")).alias("lineage"), "hosts")


def e12_normalise_taxonomy(spark, d):
    return op.normalise_taxonomy(_taxonomy(spark, d)).select("tax_id", F.col("ranks")["family"].alias("family"), F.col("ranks")["order"].alias("ord"), F.col("ranks")["subgenus"].alias("subgenus"), "lineage_text", F.array_join("hosts", ",").alias("hosts"))


def e13_enrich_taxonomy(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("tax_id"))
    return op.enrich_taxonomy(c, op.normalise_taxonomy(_taxonomy(spark, d)), ["family", "order"]).select("c_custkey", "lineage_text", "tax_family", "tax_order", "primary_host", "n_hosts")


def e14_sidecar(spark, d):
    p = table(spark, d, "part")
    return op.sidecar(p.select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_size")).alias("size"), "p_brand"), "p_partkey", ["size", "p_brand"])


def e15_classify_query(spark, d):
    c = F.col("c_custkey")
    q = F.when(c % 5 == 0, F.concat("c_name", F.lit(".pdb"))).when(c % 5 == 1, F.format_string(" P%05d", c % 100000)).when(c % 5 == 2, F.format_string("NC_%06d.1", c)).when(c % 5 == 3, F.format_string("AAB%05d.2", c % 100000)).otherwise(F.format_string("NC_%06d", c))
    return table(spark, d, "customer").select(op.classify_query(q).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def e16_accession_list(spark, d):
    o = table(spark, d, "orders")
    return op.accession_list(o.select(F.col("o_orderkey").alias("ord"), F.concat_ws(" , ", F.lower("o_orderpriority"), F.col("o_custkey").cast("string")).alias("line")))


def e17_canonical_entry(spark, d):
    li = table(spark, d, "lineitem")
    return op.canonical_entry(li.select(F.col("l_suppkey").alias("query"), F.col("l_partkey").alias("entry"), F.col("l_quantity").alias("end")))


def e18_plddt_category(spark, d):
    return table(spark, d, "events").select(op.plddt_category(F.col("value")).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


def e19_entry_metadata(spark, d):
    p = table(spark, d, "part")
    return op.entry_metadata(p.select(F.col("p_partkey").alias("accession"), F.when(F.col("p_size") > 5, F.col("p_type")).otherwise(" ").alias("description"), F.when(F.col("p_size") > 3, F.col("p_brand")).alias("organism"), F.when(F.col("p_size") < 48, F.col("p_size") * 2.0).alias("plddt")))


def e20_residue_band(spark, d):
    """Residues with a native scale by return flag (none told for N, none for a seventh of the lines) and LDDT in some."""
    li = table(spark, d, "lineitem")
    kind = F.when(F.col("l_linenumber") == 7, "none").when(F.col("l_returnflag") == "A", "plddt").when(F.col("l_returnflag") == "R", "bfactor")
    want = F.get(F.array(F.lit("auto"), F.lit("lddt"), F.lit("native")), (F.col("l_orderkey") % 3).cast("int"))
    mode = op.residue_mode(want, F.col("l_linestatus") == "O", kind)
    rows = li.select(want.alias("want"), mode.alias("mode"), F.when(mode == "lddt", F.col("l_discount") * 10).otherwise(F.col("l_quantity") * 2).alias("x"))
    return rows.select("want", "mode", op.residue_band(F.col("x"), F.col("mode")).alias("band")).groupBy("want", "mode", "band").agg(F.count("*").alias("n"))


QUERIES = {k: f for k, f in globals().items() if k[:1] == "e" and k[1:2].isdigit()}

_BEST = f"WITH {ad.HITS}, best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY query, accession ORDER BY evalue, pos, tie, aln_length, db) = 1)"
_TAX = "tax AS (SELECT n_nationkey AS tax_id, n_name AS family, r_name AS ord, r_name || ' > ' || n_name || ' > ' || lower(n_name) AS lineage_text, lower(n_name) AS subgenus, hosts FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT s_nationkey, list_sort(list(s_name)) AS hosts FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey)"
_ACC = "CASE l_returnflag WHEN 'R' THEN CASE l_linenumber WHEN 1 THEN '1XYZ' WHEN 2 THEN 'entry2' WHEN 7 THEN '7abc-assembly7.cif.gz_' || l_linestatus ELSE l_linenumber || 'ABC_' || l_linestatus END WHEN 'A' THEN 'Q' || l_partkey ELSE 'P' || l_suppkey || '_' || l_linenumber || '-' || l_orderkey END"
_PLDDT = "CASE WHEN {0} IS NULL THEN 'Unknown' WHEN {0} >= 90 THEN 'Very high (>90)' WHEN {0} >= 70 THEN 'Confident (70-90)' WHEN {0} >= 50 THEN 'Low (50-70)' ELSE 'Disordered (<50)' END"

SQL = {
    "e1_gate": f"WITH {ad.HITS} SELECT query, db, count(*) AS n, CAST(sum(aln_length) AS BIGINT) AS aligned FROM hits WHERE evalue <= 0.002 AND aln_length >= 10 AND aln_length / q_len >= 0.4 GROUP BY ALL",
    "e2_accession": f"SELECT {_ACC} AS accession, count(*) AS n FROM lineitem GROUP BY 1",
    "e3_cath_parent": "SELECT 'P' || l_suppkey AS parent, l_linenumber AS start, count(*) AS n, CAST(max(l_orderkey) AS INT) AS last FROM lineitem WHERE l_returnflag NOT IN ('R', 'A') GROUP BY ALL",
    "e4_best_per_accession": f"{_BEST} SELECT query, accession, round(evalue, 6) AS evalue, pos FROM best",
    "e5_exclude_self": f"WITH {ad.HITS} SELECT query, count(*) AS n FROM hits WHERE coalesce(seq_id, 0) < 99.9 GROUP BY 1",
    "e6_cap": f"{_BEST} SELECT query, accession, count(*) OVER (PARTITION BY query) < 50 AS short FROM best QUALIFY row_number() OVER (PARTITION BY query ORDER BY evalue, accession) <= 50",
    "e7_per_db": f"WITH {ad.HITS} SELECT db, count(*) AS returned, count(*) FILTER (evalue <= 0.002) AS passed FROM hits GROUP BY 1",
    "e8_structure_kind": "SELECT CASE WHEN l_orderkey % 5 IN (1, 2, 4) THEN 'predicted' ELSE 'experimental' END AS kind, count(*) AS n FROM lineitem GROUP BY 1",
    "e9_confidence_plan": f"WITH {ad.HITS} SELECT db, CASE WHEN db = 'pdb100' THEN 'none' ELSE 'plddt' END AS plan, count(*) AS n FROM hits GROUP BY ALL",
    "e10_cohort_counts": f"WITH {ad.HITS} SELECT db, count(*) FILTER (aln_length > 5) AS written, count(*) FILTER (aln_length <= 5) AS failed, count(*) FILTER (aln_length > 5 AND db <> 'pdb100') AS with_confidence FROM hits GROUP BY 1",
    "e11_lddt_track": "SELECT vec_id, CAST(i - 1 AS INT) AS i, round(CASE WHEN i >= label + 3 AND i < label + 3 + len(embedding) THEN CAST(embedding[i - label - 2] AS DOUBLE) END, 5) + 0.0 AS v FROM (SELECT *, unnest(range(1, 81)) AS i FROM embeddings)",
    "e12_normalise_taxonomy": f"WITH {_TAX} SELECT tax_id, family, ord, subgenus, lineage_text, array_to_string(hosts, ',') AS hosts FROM tax",
    "e13_enrich_taxonomy": f"WITH {_TAX} SELECT c_custkey, lineage_text, family AS tax_family, ord AS tax_order, hosts[1] AS primary_host, CAST(coalesce(len(hosts), 0) AS INT) AS n_hosts FROM customer LEFT JOIN tax ON c_nationkey = tax_id",
    "e14_sidecar": """SELECT p_partkey, '{' || CASE WHEN p_size > 10 THEN '"size":' || p_size || ',' ELSE '' END || '"p_brand":"' || p_brand || '"}' AS sidecar FROM part""",
    "e15_classify_query": "SELECT ['file', 'uniprot', 'ncbi', 'ncbi', 'uniprot'][c_custkey % 5 + 1] AS kind, count(*) AS n FROM customer GROUP BY 1",
    "e16_accession_list": "WITH e AS (SELECT o_orderkey AS ord, 0 AS pos, upper(o_orderpriority) AS a FROM orders UNION ALL SELECT o_orderkey, 1, CAST(o_custkey AS VARCHAR) FROM orders) SELECT a AS accession, ord, pos FROM e QUALIFY row_number() OVER (PARTITION BY a ORDER BY ord, pos) = 1",
    "e17_canonical_entry": "SELECT l_suppkey AS query, l_partkey AS entry FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY (l_partkey = l_suppkey) DESC, l_quantity DESC, l_partkey DESC) = 1",
    "e18_plddt_category": f"SELECT {_PLDDT.format('value')} AS category, count(*) AS n FROM events GROUP BY 1",
    "e19_entry_metadata": f"SELECT p_partkey AS accession, CASE WHEN p_size > 5 THEN p_type ELSE 'Unknown' END AS protein, CASE WHEN p_size > 3 THEN p_brand ELSE 'Unknown' END AS organism, CASE WHEN p_size < 48 THEN p_size * 2.0 ELSE 0 END AS plddt, {_PLDDT.format('(CASE WHEN p_size < 48 THEN p_size * 2.0 END)')} AS category FROM part",
    "e20_residue_band": """WITH r AS (SELECT ['auto', 'lddt', 'native'][l_orderkey % 3 + 1] AS want, l_linestatus = 'O' AS has, CASE WHEN l_linenumber = 7 THEN 'none' WHEN l_returnflag = 'R' THEN 'bfactor' ELSE 'plddt' END AS native, l_discount * 10 AS l, l_quantity * 2 AS q FROM lineitem),
m AS (SELECT *, CASE WHEN want <> 'native' AND has THEN 'lddt' WHEN want = 'lddt' THEN 'none' ELSE native END AS mode FROM r)
SELECT want, mode, CASE mode WHEN 'lddt' THEN CASE WHEN l >= 0.8 THEN 'very high' WHEN l >= 0.6 THEN 'high' WHEN l >= 0.4 THEN 'low' ELSE 'very low' END
  WHEN 'plddt' THEN CASE WHEN q >= 90 THEN 'very high' WHEN q >= 70 THEN 'high' WHEN q >= 50 THEN 'low' ELSE 'very low' END
  WHEN 'bfactor' THEN CASE WHEN q <= 20 THEN 'very high' WHEN q <= 40 THEN 'high' WHEN q <= 60 THEN 'low' ELSE 'very low' END ELSE 'none' END AS band, count(*) AS n FROM m GROUP BY ALL""",
}
