"""Result files, tracks, catalogues and exports on made folders; projections, user models and callbacks."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.operators import clusters, trees
from taxaloom.sources import readers, writers


def test_hits_flat_nested_and_broken(spark, tmp_path):
    one = {"target": "1abc_A", "eval": 1e-5, "prob": "high", "seqId": 30, "alnLength": 70, "taxName": "x"}
    for name, text in {"flat": json.dumps({"results": [{"db": "pdb100", "alignments": [one, {"target": "b"}]}, {"db": "empty", "alignments": []}, {"db": "none"}]}), "nested": json.dumps({"results": [{"db": "afdb50", "alignments": [[one]]}]}), "broken": "{not json", "other": "[1, 2]"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = sorted((r["path"].rsplit("/", 1)[-1], r["db"], r["pos"], r["target"], r["evalue"], r["prob"], r["seq_id"], r["aln_length"], r["tax_name"]) for r in readers.read_hits(spark, f"file://{tmp_path}/*.json").collect())
    assert got == [("flat.json", "pdb100", 0, "1abc_A", 1e-5, None, 30.0, 70, "x"), ("flat.json", "pdb100", 1, "b", None, None, None, None, None), ("nested.json", "afdb50", 0, "1abc_A", 1e-5, None, 30.0, 70, "x")]
    assert [r["path"].rsplit("/", 1)[-1] for r in readers.unread_hits(spark, f"file://{tmp_path}/*.json").collect()] == ["broken.json"]


def test_tracks_lie_on_the_whole_chain(spark, tmp_path):
    rows = [("q", "/a/b/one.pdb", "0.5", "0.7", "0.1,0.2, ,0.3", "2", "4", "1", "3", "6"), ("q", "two.cif.gz", "0.5", "0.7", "0.9", "3", "3", "1", "1", ""), ("q", "bad.pdb", "0.5", "0.7", "0.9,x", "3", "3", "1", "1", "5"), ("q", "short", "0.5"), ("q", "one.pdb", "0.6", "0.8", "1", "1", "1", "1", "1", "2")]
    (tmp_path / "hits.tsv").write_text("\n".join("\t".join(r) for r in rows) + "\n")
    got = {r["target"]: (r["tm_to_query"], r["lddt_aligned"], r["track"]) for r in readers.read_lddt_hits(spark, f"file://{tmp_path}/hits.tsv").collect()}
    assert got == {"one": (0.6, [1.0], [1.0, None]), "two.cif": (0.5, [0.9], [None, None, 0.9])}


def test_catalogues_of_a_made_folder(spark, tmp_path):
    names = ["run1/phylogeny/cluster_1_e1/x_3di.treefile", "run1/phylogeny/cluster_1_e1/x_both.treefile", "run1/phylogeny/cluster_1_e1/x_aa.treefile", "run1/phylogeny/cluster_2_e1/y_foldmason.nwk", "run1/phylogeny/other/z_3di.treefile", "run1/clusters/cluster_1_e1/foldmason.fasta_3di.fa", "run1/clusters/cluster_1_e1/mafft.fasta_aa.fa", "run1/clusters/cluster_1_e1/foldmason.fasta_aa.fa", "run1/clusters/cluster_2_e1/own_3di.fa", "run1/clusters/cluster_2_e1/own_aa.fa", "run1/clusters/cluster_3_e1/mafft.fasta_3di.fa"]
    for n in names:
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_text("x")
    files = readers.listing(spark, f"file://{tmp_path}")
    tail = lambda p: p and "/".join(p.split("/")[-2:])
    assert sorted((r["run"], r["cluster"], r["alphabet"], tail(r["path"])) for r in trees.tree_catalog(files).collect()) == [("run1", "cluster_1_e1", "3di", "cluster_1_e1/x_both.treefile"), ("run1", "cluster_1_e1", "aa", "cluster_1_e1/x_aa.treefile"), ("run1", "cluster_2_e1", "3di", "cluster_2_e1/y_foldmason.nwk")]
    paired = {tail(r["path"]): tail(r["aa_path"]) for r in readers.paired_alignment(files.where("path like '%.fa'")).collect()}
    assert paired == {"cluster_1_e1/foldmason.fasta_3di.fa": "cluster_1_e1/mafft.fasta_aa.fa", "cluster_2_e1/own_3di.fa": "cluster_2_e1/own_aa.fa", "cluster_3_e1/mafft.fasta_3di.fa": None}
    assert {tail(r["path"]) for r in readers.dataset_catalog(files).where("kind = 'alignment' and cluster = 'cluster_1_e1'").collect()} == {"cluster_1_e1/foldmason.fasta_3di.fa", "cluster_1_e1/foldmason.fasta_aa.fa"}
    p = spark.createDataFrame([("/h/huggingface/hub/datasets--a--b-c/snapshots/0f1/s/t/x.pdb",), ("/h/huggingface/hub/datasets--a--b/snapshots/0f1/x.pdb",), ("/h/x.pdb",)], "path string")
    assert [tuple(r)[1:] for r in readers.provenance(p).collect()] == [("a/b-c", "0f1", "s/t"), ("a/b", "0f1", None), (None, None, None)]


@pytest.fixture
def cohort(spark):
    taxa = spark.createDataFrame([("a",), ("c",), ("a",)], "taxon_id string")
    aln = spark.createDataFrame([("a", "aa", "A-C"), ("b", "aa", "AAC"), ("c", "3di", "--d")], "taxon_id string, alphabet string, row string")
    nodes = trees.parse_newick(spark.createDataFrame([(1, "((a:1,b:1):1,c:2);")], "tree_id int, newick string"))
    meta = spark.createDataFrame([("a", "x\ty\nz", 1), ("b", "q", 2), ("c", None, 3)], "taxon_id string, note string, n int")
    return taxa, aln, nodes, meta, meta.select("taxon_id", F.col("n").alias("idx"))


def test_an_export_is_whole_or_not_there(spark, tmp_path, cohort):
    path = f"file://{tmp_path}/out"
    broken = list(cohort)
    broken[4] = cohort[4].withColumn("idx", F.raise_error(F.lit("stopped")))
    with pytest.raises(Exception, match="stopped"):
        writers.export_subset(path, *broken)
    with pytest.raises(Exception, match="no whole export|PATH_NOT_FOUND|does not exist"):
        writers.exported(spark, path)
    first = writers.export_subset(path, *cohort)
    with pytest.raises(Exception, match="stopped"):
        writers.export_subset(path, *broken)
    at = writers.exported(spark, path)
    assert at.endswith(first)
    assert {(r["taxon_id"], r["seq"]) for r in readers.read_fasta(spark, f"{at}/alignment/*").collect()} == {("a", "A-C"), ("c", "--d")}
    assert [r["newick"] for r in spark.read.json(f"{at}/trees").collect()] == ["(a:2.000000,c:2.000000);"]
    assert {(r["taxon_id"], r["note"]) for r in spark.read.csv(f"{at}/metadata_tsv", sep="\t", header=True).collect()} == {("a", "x y z"), ("c", None)}
    assert spark.read.parquet(f"{at}/residues").count() == 2
    second = writers.export_subset(path, *cohort)
    assert writers.exported(spark, path).endswith(second)


def test_delimiters(spark, tmp_path):
    for i, (text, want) in enumerate({"id;a,b\n1;x,y\n2;z,w;\n": "id", "id\ta b\n1\tx\n": "id", "id|x\n1|2\n": "id", "id\n1\n": "id"}.items()):
        (tmp_path / f"{i}.txt").write_text(text)
        assert readers.read_metadata_delimited(spark, f"file://{tmp_path}/{i}.txt").columns[0] == want
    (tmp_path / "m.csv").write_text('id,t\n1,"two\nlines"\n')
    assert readers.read_metadata_delimited(spark, f"file://{tmp_path}/m.csv", multi_line=True).first()["t"] == "two\nlines"


def test_projection_equals_singular_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 5)) * [5, 3, 1, 0.5, 0.1]
    got = {r["taxon_id"]: (r["x"], r["y"]) for r in clusters.project_2d(spark.createDataFrame([(f"t{i}", [float(v) for v in r]) for i, r in enumerate(x)], "taxon_id string, vec array<double>")).collect()}
    c = x - x.mean(0)
    p = c @ np.linalg.svd(c, full_matrices=False)[2][:2].T
    for axis in (0, 1):
        own, want = np.array([got[f"t{i}"][axis] for i in range(60)]), p[:, axis]
        want = (want - want.min()) / (want.max() - want.min()) * 1000 - 500
        assert np.allclose(own, want, atol=1e-6) or np.allclose(own, -want, atol=1e-6)


def test_user_models_pool_their_tokens(spark):
    made = lambda: lambda texts: [[(float(ord(c)), float(len(t))) for c in t] for t in texts]
    seqs = spark.createDataFrame([("a", "ABCD"), ("b", "AB"), ("c", "A"), ("d", ""), ("e", None), ("f", "ABCDEFGHIJ")], "taxon_id string, seq string")
    got = {r["taxon_id"]: r["vec"] for r in clusters.embed_with(seqs, made, max_length=6, batch=2).collect()}
    assert got == {"a": [66.5, 4.0], "b": [65.5, 2.0], "c": [65.0, 1.0], "f": [67.5, 6.0]}  # f is cut to ABCDEF


def test_callbacks_that_fail_are_listed(spark):
    v = spark.createDataFrame([(f"t{i}", [float(i < 6), 1.0]) for i in range(12)], "taxon_id string, vec array<double>")

    def by_side(table, threshold, coverage):
        if coverage > 0.5:
            raise RuntimeError("no tool")
        side = F.col("vec")[0] > threshold
        return table.join(table.groupBy(side.alias("s")).agg(F.min("taxon_id").alias("rep")), side == F.col("s")).select("taxon_id", "rep")

    found, failed = clusters.sweep_with(v, by_side, [(0.5, 0.1), (0.5, 0.9), (2.0, 0.1)], {"v": v}, 3)
    assert {r["candidate_id"]: r["n_clusters"] for r in found.collect()} == {"g0": 2, "g2": 1}
    assert [(r["candidate_id"], r["error"]) for r in failed.collect()] == [("g1", "RuntimeError: no tool")]
