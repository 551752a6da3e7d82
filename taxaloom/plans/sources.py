"""Queries A: sources and sinks. Files are written by Spark from the given tables into the shared folder, then read."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from taxaloom.operators import trees
from taxaloom.plans import adapters as ad, trees as tree_plans
from taxaloom.session import shared_folder, table
from taxaloom.sources import readers as op, writers


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/files-{uuid4().hex}"


def _fasta(spark, d):
    writers.write_fasta(ad.sequences(spark, d), path := _folder(spark), ["dataset"])
    return path


def a1_read_fasta(spark, d):
    return op.read_fasta(spark, f"{_fasta(spark, d)}/*").select("taxon_id", "seq")


def a2_read_plm_sequences(spark, d):
    writers.write_fasta(ad.part_alignment(spark, d).withColumnRenamed("row", "seq"), path := _folder(spark), strip_gaps=False)
    return op.read_plm_sequences(spark, path).select("taxon_id", "seq")


def a3_count_fasta(spark, d):
    c = op.count_fasta(spark, f"{_fasta(spark, d)}/*")
    return c.select(F.regexp_extract("path", "dataset=([^/]+)", 1).alias("dataset"), "records").groupBy("dataset").agg(F.sum("records").alias("records"))


def a4_write_fasta(spark, d):
    lines = spark.read.text(f"{_fasta(spark, d)}/*")
    return lines.agg(F.count_if(F.col("value").startswith(">")).alias("records"), F.sum(F.when(~F.col("value").startswith(">"), F.length("value"))).alias("letters"), F.max(F.when(~F.col("value").startswith(">"), F.length("value"))).alias("longest"))


def _pdb(spark, d):
    """Orders as structures, lines as CA atoms."""
    li = table(spark, d, "lineitem")
    name = F.element_at(F.array(*[F.lit(x) for x in ("ALA", "GLY", "MSE", "XXX", "LEU", "SER", "VAL")]), F.col("l_linenumber"))
    line = F.format_string("ATOM  %5d  CA  %3s A%4d    %8.3f%8.3f%8.3f%6.2f%6.2f", "l_linenumber", name, "l_linenumber", "l_quantity", (F.col("l_discount") * 100), (F.col("l_tax") * 100), F.lit(1.0), "l_quantity")
    return li.groupBy(F.col("l_orderkey").cast("string").alias("path")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", line.alias("line")))), lambda x: x["line"]), "\n").alias("text"))


def a5_parse_pdb(spark, d):
    return op.parse_pdb(_pdb(spark, d)).groupBy("path").agg(F.count("*").alias("atoms"), F.round(F.sum("x"), 1).alias("x"), F.max("resnum").alias("last"))


def a6_parse_mmcif(spark, d):
    """The same structures as mmCIF text give the same atoms."""
    head = "\n".join(["loop_", *[f"_atom_site.{c}" for c in ("group_PDB", "label_atom_id", "label_comp_id", "label_seq_id", "Cartn_x", "Cartn_y", "Cartn_z", "occupancy", "B_iso_or_equiv")]])
    rows = op.parse_pdb(_pdb(spark, d))
    line = F.format_string("ATOM CA %s %d %.1f %.1f %.1f %.2f %.2f", "resname", "resnum", "x", "y", "z", "occupancy", "bfactor")
    cif = rows.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", line.alias("line")))), lambda x: x["line"]), "\n").alias("t")).select("path", F.concat(F.lit(head + "\n"), "t").alias("text"))
    return op.parse_mmcif(cif).groupBy("path").agg(F.count("*").alias("atoms"), F.round(F.sum("x"), 1).alias("x"), F.max("resnum").alias("last"))


def a7_select_confidence(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("path"), F.when(F.col("l_orderkey") % 2 == 0, 1.0).otherwise(F.col("l_quantity")).alias("bfactor"), F.col("l_tax").alias("occupancy"))
    return op.select_confidence(li).groupBy("path").agg(F.round(F.sum("confidence"), 4).alias("confidence"))


def a8_structure_yield(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("path"))
    y = op.structure_yield(o, table(spark, d, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("path")))
    return y.groupBy("parsed").agg(F.count("*").alias("n"))


def a9_structure_sequences(spark, d):
    return op.structure_sequences(op.parse_pdb(_pdb(spark, d)))


def a10_ca_residues(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.array_join(F.transform("embedding", lambda x: F.round(x.cast("double"), 3).cast("string")), ",").alias("t_ca"), F.lit("ARNDCXQ").alias("t_seq"))
    return op.ca_string_to_residues(e, "vec_id").groupBy("vec_id").agg(F.count("*").alias("residues"), F.count_if(F.col("resname") == "GLY").alias("gly"))


def a11_bfactor_profile(spark, d):
    return op.bfactor_profile(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("path"), F.col("l_quantity").alias("bfactor")))


def a12_read_metadata_delimited(spark, d):
    table(spark, d, "part").write.csv(path := _folder(spark), sep=";", header=True)
    return op.read_metadata_delimited(spark, path).select("p_partkey", "p_name", "p_size")


def a13_read_metadata_json(spark, d):
    part = table(spark, d, "part").select(F.col("p_brand").alias("b"), F.to_json(F.create_map(F.lit("id"), F.col("p_partkey").cast("string"), F.lit("name"), F.col("p_name"))).alias("j"))
    part.groupBy("b").agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]")).alias("value")).select("value").repartition(25, "value").write.option("lineSep", "\n").text(path := _folder(spark))
    rows = op.whole_files(spark, path).select("path", F.explode(F.split("text", "\n")).alias("text")).where("text <> ''")
    return rows.select(F.explode(F.from_json("text", "array<map<string,string>>")).alias("f")).select(F.col("f")["id"].alias("id"), F.col("f")["name"].alias("name"))


def _results(spark, d):
    """Orders in files of results: lines with a discount in one block, others in a second, whose list is nested for odd files; every
    seventh file is no JSON."""
    li = table(spark, d, "lineitem").select(F.floor(F.col("l_orderkey") / 700).alias("file"), F.when(F.col("l_discount") > 0.05, "pdb100").otherwise("afdb50").alias("db"), "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_suppkey")
    hit = F.to_json(F.struct(F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("target"), F.col("l_tax").alias("eval"), F.col("l_quantity").cast("int").alias("alnLength"), F.lit(50).alias("qLen"), F.when(F.col("l_linenumber") > 2, F.col("l_suppkey")).alias("taxId")))
    rows = li.groupBy("file", "db").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_suppkey", hit.alias("j")))), lambda x: x["j"]), ",").alias("j"))
    nested = (F.col("file") % 2 == 1) & (F.col("db") == "afdb50")
    block = F.concat(F.lit('{"db":"'), "db", F.lit('","alignments":['), F.when(nested, F.concat(F.lit("["), "j", F.lit("]"))).otherwise(F.col("j")), F.lit("]}"))
    whole = rows.groupBy("file").agg(F.array_join(F.collect_list(block), ",").alias("b"))
    text = F.when(F.col("file") % 7 == 6, "{cut off").otherwise(F.concat(F.lit('{"results":['), "b", F.lit("]}")))
    whole.select("file", text.alias("value")).repartition("file").write.partitionBy("file").text(path := _folder(spark))
    return f"{path}/*"


def a14_read_hits(spark, d):
    hits = op.read_hits(spark, _results(spark, d))
    return hits.select(F.regexp_extract("path", "file=([0-9]+)", 1).cast("long").alias("file"), "db", "pos", "target", "evalue", "aln_length", F.coalesce("tax_id", F.lit(-1)).alias("tax_id"))


def a14_unread_hits(spark, d):
    return op.unread_hits(spark, _results(spark, d)).select(F.regexp_extract("path", "file=([0-9]+)", 1).cast("long").alias("file"))


def a15_read_cluster_tsv(spark, d):
    table(spark, d, "part").select("p_brand", F.concat("p_partkey", F.lit(".pdb.gz"))).write.csv(path := _folder(spark), sep="\t")
    return op.read_cluster_tsv(spark, path)


def a16_read_pair_scores(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string"), (F.col("l_partkey") % 120).cast("string"), F.when(F.col("l_linenumber") == 3, "bad").otherwise(F.col("l_discount").cast("string")))
    li.write.csv(path := _folder(spark), sep="\t")
    taxa = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("taxon_id"))
    return op.read_pair_scores(spark, path, taxa).groupBy("a").agg(F.count("*").alias("n"), F.round(F.sum("score"), 4).alias("score"))


def a17_read_lddt_hits(spark, d):
    li = table(spark, d, "lineitem")
    target = F.concat(F.lit("/db/o"), "l_orderkey", F.lit("_"), "l_linenumber", F.lit("_"), "l_partkey", F.lit("_"), "l_suppkey", F.lit("_"), F.round(F.col("l_discount") * 100).cast("int"), F.lit(".pdb.gz"))
    values = F.array_join(F.transform(F.sequence(F.lit(1), F.col("l_linenumber")), lambda i: (i / 8).cast("string")), ",")
    values = F.when(F.col("l_linenumber") == 6, F.concat(values, F.lit(",x"))).otherwise(values)
    size = F.when(F.col("l_linenumber") == 5, F.lit(None)).otherwise(F.lit(9))
    li.select(F.lit("q"), target, F.col("l_discount"), F.col("l_tax"), values, F.lit(3), F.col("l_linenumber") + 2, F.lit(1), "l_linenumber", size).write.csv(path := _folder(spark), sep="\t")
    r = op.read_lddt_hits(spark, path)
    return r.select("target", "tm_to_query", "t_end", F.size("lddt_aligned").alias("values"), F.array_join(F.transform("track", lambda x: F.coalesce(F.round(x * 8).cast("int").cast("string"), F.lit("-"))), "").alias("track"))


def a18_read_trees(spark, d):
    trees.write_newick(tree_plans._a(spark, d)).select("newick").write.text(path := _folder(spark))
    n = op.tree_nodes(spark, path)
    return n.groupBy("depth", "is_leaf").agg(F.count("*").alias("n"), F.round(F.sum("length"), 4).alias("length"))


def a19_write_newick(spark, d):
    return trees.write_newick(tree_plans._a(spark, d)).select("tree_id", F.length(F.regexp_replace("newick", "[^,]", "")).alias("commas"), F.length(F.regexp_replace("newick", "[^(]", "")).alias("opened"))


def a20_read_embeddings(spark, d):
    ad.vectors(spark, d).drop("ord").write.parquet(path := _folder(spark))
    taxa = ad.vectors(spark, d).where("label < 4").select("taxon_id", "ord")
    return op.read_embeddings(spark, path, taxa).select("taxon_id", F.round(F.get("vec", F.lit(0)), 5).alias("first"))


def a23_save_partition(spark, d):
    writers.save_partition(table(spark, d, "part").select(F.col("p_brand").alias("rep"), F.col("p_partkey").cast("string").alias("taxon_id")), path := _folder(spark))
    return spark.read.schema("rep string, members array<string>, size long").json(path).select("rep", "size", F.get("members", F.lit(0)).alias("first"))


def _files(spark, d):
    """Paths of result files: a brand is a cluster of a run, a type a kind of file."""
    p = table(spark, d, "part").select((F.col("p_size") % 5).alias("r"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("_")).alias("c"), F.col("p_type").alias("t")).distinct()
    run, cluster = F.concat(F.lit("/results/run"), "r"), F.concat(F.lit("cluster_"), "c")
    name = F.create_map(*[F.lit(x) for k, v in {"ECONOMY": "foldmason.fasta_3di.fa", "LARGE": "mafft.fasta_3di.fa", "MEDIUM": "mafft.fasta_aa.fa", "PROMO": "foldmason.fasta_aa.fa", "SMALL": "x_3di.treefile", "STANDARD": "x_both.treefile"}.items() for x in (k, v)])[F.col("t")]
    tree = F.col("t").isin("SMALL", "STANDARD")
    return p.select(F.concat(run, F.when(tree, F.concat(F.lit("/phylogeny/"), cluster)).otherwise(F.concat(F.lit("/clusters/"), cluster)), F.lit("/"), name).alias("path"))


def a21_dataset_catalog(spark, d):
    return op.dataset_catalog(_files(spark, d).where("path not like '%phylogeny%'")).select("run", "cluster", "kind", "alphabet", "path")


def a22_paired_alignment(spark, d):
    return op.paired_alignment(_files(spark, d))


def a24_export_subset(spark, d):
    """The export of the customers with an even key, read back."""
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("taxon_id"), F.concat_ws("\t", "c_name", "c_mktsegment").alias("note"), "c_acctbal", "c_custkey")
    aln = c.select("taxon_id", F.lit("aa").alias("alphabet"), F.lit("AC-GT").alias("row"))
    residues = c.select("taxon_id", F.explode(F.sequence(F.lit(1), (F.col("c_custkey") % 3 + 1).cast("int"))).alias("idx"))
    writers.export_subset(path := _folder(spark), c.where("c_custkey % 2 = 0"), aln, tree_plans._a(spark, d), c.drop("c_custkey"), residues)
    at = writers.exported(spark, path)
    rows = spark.read.csv(f"{at}/metadata_tsv", sep="\t", header=True).select("taxon_id", "note")
    seqs = op.read_fasta(spark, f"{at}/alignment/*").select("taxon_id", "seq")
    tips = trees.tips(trees.parse_newick(spark.read.schema("tree_id int, newick string").json(f"{at}/trees"))).select(F.col("name").alias("taxon_id"), "tree_id")
    n = spark.read.parquet(f"{at}/residues").groupBy("taxon_id").agg(F.count("*").alias("residues"))
    return rows.join(seqs, "taxon_id", "full").join(tips, "taxon_id", "full").join(n, "taxon_id", "full")


def a25_input_inventory(spark, d):
    """A digest is that of the same files listed in another order, and of other content another one."""
    path, other = _fasta(spark, d), _folder(spark)
    writers.write_fasta(ad.part_alignment(spark, d).withColumnRenamed("row", "seq"), other, strip_gaps=False)
    one, two = op.input_inventory(spark, path), op.input_inventory(spark, other)
    again = op.input_inventory(spark, f"{path}/*").select(F.col("digest").alias("again"))
    return one.crossJoin(again).crossJoin(two.select(F.col("digest").alias("other"))).select("bytes", F.array_join("extensions", ",").alias("extensions"), F.length("digest").alias("digits"), (F.col("digest") == F.col("again")).alias("same"), (F.col("digest") == F.col("other")).alias("mixed_up"))


def a26_provenance(spark, d):
    p = table(spark, d, "part").select(F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("/data/"), "p_partkey")).otherwise(F.concat(F.lit("/c/huggingface/hub/datasets--lab--set-"), F.col("p_size") % 4, F.lit("/snapshots/"), F.lower(F.hex("p_partkey")), F.when(F.col("p_size") % 3 == 1, F.lit("/a/b")).otherwise(""), F.lit("/x.pdb"))).alias("path"))
    return op.provenance(p)


def d26_tree_catalog(spark, d):
    return trees.tree_catalog(_files(spark, d))


def g10_artifact_inventory(spark, d):
    """Files of brands that were written, of those declared some are missing."""
    p = table(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list("p_name")), "\n").alias("value"))
    p.select(F.regexp_replace("p_brand", "#", "-").alias("brand"), "value").repartition("brand").write.partitionBy("brand").text(path := _folder(spark))
    found = op.listing(spark, path, "*.txt").select("path", F.regexp_extract("path", "brand=([^/]+)/", 1).alias("brand"))
    gone = found.select(F.concat("path", F.lit(".gone")).alias("path"), "brand")
    return op.artifact_inventory(found.unionByName(gone), path).select("brand", "bytes")


def a27_residue_bundle(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("dataset"), F.col("l_orderkey").alias("taxon"), F.col("l_linenumber").alias("idx"))
    tracks = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("dataset"), F.col("l_orderkey").alias("taxon")).agg(F.transform(F.array_sort(F.collect_list("l_quantity")), lambda x: x / 50).alias("track"))
    return op.residue_bundle(li, tracks).select("dataset", "taxon", "idx", F.round("lddt", 4).alias("lddt"))


QUERIES = {k: f for k, f in globals().items() if k[:1] in "adg" and k[1:2].isdigit()}

_ATOMS = "SELECT CAST(l_orderkey AS VARCHAR) AS path, count(*) AS atoms, round(sum(l_quantity), 1) AS x, max(l_linenumber) AS last FROM lineitem GROUP BY 1"

_FILES = """WITH files AS (SELECT *, '/results/run' || r || CASE WHEN t IN ('SMALL', 'STANDARD') THEN '/phylogeny/' ELSE '/clusters/' END || 'cluster_' || c || '/' || CASE t WHEN 'ECONOMY' THEN 'foldmason.fasta_3di.fa' WHEN 'LARGE' THEN 'mafft.fasta_3di.fa' WHEN 'MEDIUM' THEN 'mafft.fasta_aa.fa' WHEN 'PROMO' THEN 'foldmason.fasta_aa.fa' WHEN 'SMALL' THEN 'x_3di.treefile' ELSE 'x_both.treefile' END AS path
  FROM (SELECT DISTINCT p_size % 5 AS r, replace(lower(p_brand), '#', '_') AS c, p_type AS t FROM part))"""

SQL = {
    "a1_read_fasta": f"WITH {ad.SEQUENCES} SELECT taxon_id, seq FROM sequences",
    "a2_read_plm_sequences": f"WITH {ad.PART_ALIGNMENT} SELECT taxon_id, upper(replace(row, '-', '')) AS seq FROM part_alignment WHERE replace(row, '-', '') <> ''",
    "a3_count_fasta": "SELECT lang AS dataset, count(*) AS records FROM documents GROUP BY 1",
    "a4_write_fasta": f"WITH {ad.SEQUENCES} SELECT count(*) AS records, CAST(sum(length(seq)) AS BIGINT) AS letters, CAST(least(60, max(length(seq))) AS INT) AS longest FROM sequences",
    "a5_parse_pdb": _ATOMS,
    "a6_parse_mmcif": _ATOMS,
    "a7_select_confidence": "SELECT l_orderkey AS path, round(CASE WHEN l_orderkey % 2 = 1 AND min(l_quantity) <> max(l_quantity) THEN sum(l_quantity) WHEN min(l_tax) <> max(l_tax) THEN sum(l_tax) WHEN l_orderkey % 2 = 0 THEN count(*) ELSE sum(l_quantity) END, 4) AS confidence FROM lineitem GROUP BY 1",
    "a8_structure_yield": "SELECT o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25) AS parsed, count(*) AS n FROM orders GROUP BY 1",
    "a9_structure_sequences": "SELECT CAST(l_orderkey AS VARCHAR) AS path, string_agg(['A', 'G', 'M', 'X', 'L', 'S', 'V'][l_linenumber], '' ORDER BY l_linenumber) AS seq FROM lineitem GROUP BY 1",
    "a10_ca_residues": "SELECT vec_id, CAST(len(embedding) // 3 AS BIGINT) AS residues, CAST(len(embedding) // 3 - 6 AS BIGINT) AS gly FROM embeddings",
    "a11_bfactor_profile": "SELECT l_suppkey AS path, count(*) AS n, list_sort(list(l_quantity))[count(*) // 2 + 1] AS median_bfactor FROM lineitem GROUP BY 1",
    "a12_read_metadata_delimited": "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size FROM part",
    "a13_read_metadata_json": "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part",
    "a14_read_hits": """WITH l AS (SELECT l_orderkey // 700 AS file, CASE WHEN l_discount > 0.05 THEN 'pdb100' ELSE 'afdb50' END AS db, * FROM lineitem)
SELECT file, db, (row_number() OVER (PARTITION BY file, db ORDER BY l_orderkey, l_linenumber, l_quantity, l_tax, l_suppkey) - 1)::INT AS pos, l_orderkey || '-' || l_linenumber AS target, l_tax AS evalue, trunc(l_quantity)::INT AS aln_length, CASE WHEN l_linenumber > 2 THEN l_suppkey ELSE -1 END::INT AS tax_id FROM l WHERE file % 7 <> 6""",
    "a14_unread_hits": "SELECT DISTINCT l_orderkey // 700 AS file FROM lineitem WHERE l_orderkey // 700 % 7 = 6",
    "a17_read_lddt_hits": """SELECT DISTINCT 'o' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_' || round(l_discount * 100)::INT || '.pdb' AS target, l_discount AS tm_to_query, (l_linenumber + 2)::INT AS t_end, l_linenumber::INT AS values,
  '--' || list_aggregate(range(1, l_linenumber + 1), 'string_agg', '') || CASE WHEN l_linenumber = 5 THEN '' ELSE repeat('-', 7 - l_linenumber) END AS track FROM lineitem WHERE l_linenumber <> 6""",
    "a15_read_cluster_tsv": "SELECT p_brand AS rep, CAST(p_partkey AS VARCHAR) AS taxon_id FROM part",
    "a16_read_pair_scores": "SELECT CAST(l_suppkey AS VARCHAR) AS a, count(*) AS n, round(sum(l_discount), 4) AS score FROM lineitem WHERE l_linenumber <> 3 AND l_partkey % 120 IN (SELECT s_suppkey FROM supplier) AND l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY 1",
    "a18_read_trees": f"{tree_plans._W} SELECT depth, is_leaf, count(*) AS n, round(sum(length), 4) AS length FROM a GROUP BY ALL",
    "a19_write_newick": f"{tree_plans._W} SELECT tree_id, CAST(count(*) FILTER (depth > 0) - count(*) FILTER (NOT is_leaf) AS INT) AS commas, CAST(count(*) FILTER (NOT is_leaf) AS INT) AS opened FROM a GROUP BY 1",
    "a20_read_embeddings": f"WITH {ad.VECTORS} SELECT taxon_id, round(vec[1], 5) AS first FROM vectors WHERE label < 4",
    "a23_save_partition": "SELECT p_brand AS rep, count(*) AS size, min(CAST(p_partkey AS VARCHAR)) AS first FROM part GROUP BY 1",
    "a21_dataset_catalog": f"{_FILES}, k AS (SELECT *, CASE WHEN path LIKE '%3di%' THEN '3di' ELSE 'aa' END AS alphabet FROM files WHERE path NOT LIKE '%phylogeny%') SELECT 'run' || r AS run, 'cluster_' || c AS cluster, 'alignment' AS kind, alphabet, min(path) AS path FROM k GROUP BY ALL",
    "a22_paired_alignment": f"{_FILES}, t AS (SELECT path, r, c, split_part(path, '/', 6) AS name FROM files) SELECT path, (SELECT max(o.path) FROM t o WHERE o.r = t.r AND o.c = t.c AND o.name IN ('mafft.fasta_aa.fa', 'foldmason.fasta_aa.fa') AND split_part(o.path, '/', 4) = split_part(t.path, '/', 4)) AS aa_path FROM t WHERE name LIKE '%3di%' AND path NOT LIKE '%phylogeny%' UNION ALL SELECT path, NULL FROM t WHERE name LIKE '%3di%' AND path LIKE '%phylogeny%'",
    "a24_export_subset": "SELECT 'c' || c_custkey AS taxon_id, c_name || ' ' || c_mktsegment AS note, 'AC-GT' AS seq, c_nationkey::INT AS tree_id, c_custkey % 3 + 1 AS residues FROM customer WHERE c_custkey % 2 = 0",
    "a25_input_inventory": f"WITH {ad.SEQUENCES} SELECT sum(length(taxon_id) + 2 + length(seq) + greatest(length(seq) - 1, 0) // 60 + 1)::BIGINT AS bytes, '.txt' AS extensions, 64 AS digits, true AS same, false AS mixed_up FROM sequences",
    "a26_provenance": "SELECT CASE WHEN p_size % 3 = 0 THEN '/data/' || p_partkey ELSE '/c/huggingface/hub/datasets--lab--set-' || p_size % 4 || '/snapshots/' || printf('%x', p_partkey) || CASE WHEN p_size % 3 = 1 THEN '/a/b' ELSE '' END || '/x.pdb' END AS path, CASE WHEN p_size % 3 > 0 THEN 'lab/set-' || p_size % 4 END AS dataset, CASE WHEN p_size % 3 > 0 THEN printf('%x', p_partkey) END AS revision, CASE WHEN p_size % 3 = 1 THEN 'a/b' END AS subdir FROM part",
    "d26_tree_catalog": f"{_FILES} SELECT 'run' || r AS run, 'cluster_' || c AS cluster, '3di' AS alphabet, coalesce(min(path) FILTER (path LIKE '%both%'), min(path)) AS path FROM files WHERE path LIKE '%phylogeny%' GROUP BY ALL",
    "g10_artifact_inventory": "SELECT replace(p_brand, '#', '-') AS brand, sum(length(p_name) + 1)::BIGINT AS bytes FROM part GROUP BY 1",
    "a27_residue_bundle": "WITH t AS (SELECT l_returnflag AS dataset, l_orderkey AS taxon, list_sort(list(l_quantity)) AS q FROM lineitem GROUP BY ALL) SELECT dataset, taxon, l_linenumber AS idx, round(q[l_linenumber] / 50, 4) AS lddt FROM lineitem JOIN t ON dataset = l_returnflag AND taxon = l_orderkey",
}
