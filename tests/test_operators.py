"""Operators on small literals with results worked out by hand."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.operators import alignment, clusters, hits, metadata, partitions, trees
from taxaloom.operators.rounds import greedy_representatives
from taxaloom.session import cut
from taxaloom.sources import readers


def test_gap_columns_and_coverage(spark):
    aln = spark.createDataFrame([("p", "a", "M-K--L-V", 1), ("p", "b", "A-K--I-V", 2), ("p", "c", "V-R--L-I", 3)], "partition string, taxon_id string, row string, ord int")
    assert [r["row"] for r in alignment.strip_gap_columns(aln, ["partition"]).orderBy("taxon_id").collect()] == ["MKLV", "AKIV", "VRLI"]
    cov = spark.createDataFrame([("p", "a", "ABCD----"), ("p", "b", "ABCDEF--"), ("p", "c", "ABCDEFGH")], "partition string, taxon_id string, row string")
    assert [r["sequence_coverage"] for r in alignment.sequence_coverage(cov, ["partition"]).orderBy("taxon_id").collect()] == [0.5, 0.75, 1.0]


def test_qc_floor(spark):
    s = spark.createDataFrame([("d", str(n), "A" * n) for n in (9, 35, 120, 259)], "dataset string, taxon_id string, seq string")
    assert alignment.qc_filter(s).where("kept").count() == 2


def test_gate(spark):
    s = spark.createDataFrame([(0.916, 12.15), (0.1, 1.2), (0.5, 1.0), (0.2, 1.5)], "gap_fraction double, expansion double")
    assert [r["usable"] for r in alignment.full_set_gate(s).collect()] == [False, True, False, True]


def test_greedy_rounds_equal_the_sequential_choice(spark):
    random.seed(1)
    for _ in range(3):
        n = 25
        near = {(a, b) for a in range(n) for b in range(a) if random.random() < 0.15}
        reps, want = [], {}
        for i in range(n):
            r = next((r for r in reps if (i, r) in near or (r, i) in near), None)
            want[str(i)] = str(i if r is None else r)
            if r is None:
                reps.append(i)
        ranked = spark.createDataFrame([("g", str(i), i) for i in range(n)], "g string, taxon_id string, rank int")
        pairs = spark.createDataFrame([("g", str(a), str(b)) for a, b in near], "g string, a string, b string")
        assert {r["taxon_id"]: r["rep"] for r in greedy_representatives(ranked, pairs, ["g"]).collect()} == want


def test_shape_and_unassigned(spark):
    labels = [i for i, n in enumerate((50, 30, 5, 1, 1)) for _ in range(n)] + [-1, -1]
    s = partitions.shape(spark.createDataFrame([("c", x) for x in labels], "candidate_id string, label int"), 10).first()
    assert (s["taxa_retained"], s["n_clusters"], s["singletons"], s["usable"], s["unassigned"]) == (80, 5, 2, 2, 2)


def test_schedules(spark):
    s = {r["kind"]: r["schedule"] for r in partitions.schedule(spark.createDataFrame([("evalue", 1.0), ("tmscore", 0.5)], "kind string, threshold double")).collect()}
    assert s == {"evalue": [1.0, 0.3, 0.1], "tmscore": [0.6, 0.7]}


NEWICK = [(1, "((a:1,b:2)90/95:0.5,(c:1,(d:1,e:2)0.8:0.3):1,f:3);"), (2, "(('x y':1,'it''s':2)[note]:3,z);"), (3, "((a,b);")]


def test_newick(spark):
    n = trees.parse_newick(spark.createDataFrame(NEWICK, "tree_id int, newick string"))
    assert {r["tree_id"] for r in n.collect()} == {1, 2}
    assert [(r["name"], r["length"]) for r in n.where("is_leaf and tree_id = 1").orderBy("lo").collect()] == [("a", 1.0), ("b", 2.0), ("c", 1.0), ("d", 1.0), ("e", 2.0), ("f", 3.0)]
    assert [r["name"] for r in n.where("is_leaf and tree_id = 2").orderBy("lo").collect()] == ["x_y", "it's", "z"]
    s = {r["label"]: r for r in trees.support_values(n.where("label is not null")).collect()}
    assert (s["90/95"]["alrt"], s["90/95"]["ufboot"], s["90/95"]["support"], s["0.8"]["support"]) == (90.0, 95.0, 95.0, 80.0)
    assert trees.write_newick(n.where("tree_id = 1")).first()["newick"].startswith("((a:1.000000,b:2.000000):0.500000,(c:1.000000,(d:")
    p = {(r["a"], r["b"]): round(r["d"], 6) for r in trees.patristic(n.where("tree_id = 1")).collect()}
    assert p["a", "b"] == 3.0 and p["a", "f"] == 4.5 and p["d", "e"] == 3.0 and p["a", "c"] == 3.5


def test_inventory_of_outputs(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.nwk").write_text("(a,b);")
    declared = spark.createDataFrame([("r", f"{tmp_path}/a/x.nwk"), ("s", f"file://{tmp_path}/a/x.nwk"), ("r", f"{tmp_path}/gone"), ("r", None)], "run string, path string")
    assert sorted((r["run"], r["path"], r["bytes"]) for r in readers.artifact_inventory(declared, str(tmp_path)).collect()) == [("r", f"{tmp_path}/a/x.nwk", 6), ("s", f"{tmp_path}/a/x.nwk", 6)]


def test_polytomies_are_resolved(spark):
    given = [("x", "((a:1,b:1,c:0,d:1,e:2)p:1,(f:1,(g:1)u:2):3,h:1,i:1);"), ("two", "((a:1,b:2):0.5,(c:1,d:1,e:1):0.25);"), ("pair", "(a:1,b:1);"), ("bin", "(a:1,b:1,(c:1,d:1):1);")]
    n = trees.parse_newick(spark.createDataFrame(given, "tree_id string, newick string"))
    out = cut(trees.resolve_polytomies(n, 3))
    text = {r["tree_id"]: r["newick"] for r in trees.write_newick(out).collect()}
    again = trees.parse_newick(spark.createDataFrame(sorted(text.items()), "tree_id string, newick string"))
    kids = {}
    for r in again.where("parent_id is not null").groupBy("tree_id", "parent_id").count().join(again.select("tree_id", F.col("node_id").alias("parent_id"), "depth"), ["tree_id", "parent_id"]).collect():
        kids.setdefault(r["tree_id"], set()).add((r["depth"] == 0, r["count"]))
    assert kids == {"x": {(True, 3), (False, 2)}, "two": {(True, 3), (False, 2)}, "pair": {(True, 2)}, "bin": {(True, 3), (False, 2)}}
    # numbering is that of the text
    shape = lambda t: sorted((r["tree_id"], r["depth"], r["lo"], r["hi"], r["name"] or "", round(r["length"], 6)) for r in t.collect())
    assert shape(out) == shape(again)
    resolved = {r["tree_id"]: r["n"] for r in out.groupBy("tree_id").agg(F.count_distinct("resolves").alias("n")).collect()}
    assert resolved == {"x": 2, "two": 1, "pair": 0, "bin": 0}
    lengths = {r["name"]: r["length"] for r in out.where("tree_id = 'x' and is_leaf").collect()}
    assert lengths["g"] == 3.0 and lengths["c"] == 1e-6 and lengths["e"] == 2.0
    sides = lambda t: {r["tree_id"] + "".join(sorted(r["tips"])) for r in trees.below(t).where("not is_leaf").collect()}
    assert {"xabcde", "xfg"} <= sides(out) and ({"twoab"} <= sides(out) or {"twocde"} <= sides(out))
    assert shape(out) == shape(trees.resolve_polytomies(n, 3))


def test_prune_merges_single_children(spark):
    n = trees.parse_newick(spark.createDataFrame(NEWICK[:1], "tree_id int, newick string"))
    keep = spark.createDataFrame([(1, "a"), (1, "d"), (1, "e")], "tree_id int, name string")
    assert trees.write_newick(trees.prune(n, keep)).first()["newick"] == "(a:1.500000,(d:1.000000,e:2.000000):1.300000);"


def test_fasta_last_header_wins(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a one\nMK\n LV \n>b\r\nAA\r\n>a\nQQ\n>\nZZ\n")
    got = readers.read_fasta(spark, f"file://{tmp_path}/x.fa")
    assert {(r["taxon_id"], r["seq"]) for r in got.collect()} == {("a", "QQ"), ("b", "AA")}
    assert readers.read_fasta(spark, f"file://{tmp_path}/x.fa", corrupt=True).count() == 1


def test_nexus(spark, tmp_path):
    (tmp_path / "t.nex").write_text("#NEXUS\nbegin trees;\n translate\n 1 Alpha,\n 2 'Beta x',\n 3 Gamma;\n tree one = [&R] ((1:1,2:2):1,3:3);\nend;\n")
    n = readers.tree_nodes(spark, f"file://{tmp_path}/t.nex")
    assert [r["name"] for r in n.where("is_leaf").orderBy("lo").collect()] == ["Alpha", "Beta_x", "Gamma"]


def test_metadata_json_shapes(spark, tmp_path):
    for i, t in enumerate(['[{"id": "a", "x": 1}]', '{"a": {"x": 1}}', '{"taxa": {"a": {"x": 1}}}']):
        (tmp_path / f"{i}.json").write_text(t)
        assert [(r["id"], r["fields"]["x"]) for r in readers.read_metadata_json(spark, f"file://{tmp_path}/{i}.json").collect()] == [("a", "1")]
    (tmp_path / "s.json").write_text('{"a": "v"}')
    assert readers.read_metadata_json(spark, f"file://{tmp_path}/s.json").select(F.col("fields")["value"]).first()[0] == "v"


def test_rerooting_keeps_path_lengths(spark):
    n = cut(trees.parse_newick(spark.createDataFrame(NEWICK[:1], "tree_id int, newick string")))
    before = {(r["a"], r["b"]): round(r["d"], 6) for r in trees.patristic(n).collect()}
    out = cut(trees.outgroup_root(n, spark.createDataFrame([(1, "d")], "tree_id int, name string")))
    assert {(r["a"], r["b"]): round(r["d"], 6) for r in trees.patristic(out).collect()} == before
    mid = cut(trees.node_depths(trees.midpoint_root(n)))
    deepest = [round(r["dist"], 6) for r in mid.where("is_leaf").orderBy(F.desc("dist")).limit(2).collect()]
    assert deepest == [max(before.values()) / 2] * 2


@pytest.mark.parametrize("method", ["average", "ward"])
def test_linkage_of_groups_over_the_limit(spark, monkeypatch, method):
    rng = random.Random(3)
    points = spark.createDataFrame([(g, f"t{i:02}", [rng.gauss(0, 1) for _ in range(3)]) for g, n in (("x", 9), ("y", 4)) for i in range(n)], "dataset string, taxon_id string, vec array<double>").cache()
    listed = lambda: sorted((r["dataset"], r["step"], r["a"], r["b"], round(r["height"], 9), r["size"]) for r in clusters.linkage(points, method).collect())
    want = listed()
    monkeypatch.setattr(clusters, "GROUP_LIMIT", 5)
    assert len(want) == 11 and listed() == want


def test_neighbor_joining_finds_additive_trees(spark, monkeypatch):
    rng = random.Random(2)
    edges, n = {}, 8  # a random tree over n leaves
    top, new = list(range(n)), n
    while len(top) > 3:
        a, b = (top.pop(rng.randrange(len(top))) for _ in range(2))
        edges[a], edges[b] = (new, rng.uniform(0.5, 2)), (new, rng.uniform(0.5, 2))
        top, new = [*top, new], new + 1
    edges |= {x: (new, rng.uniform(0.5, 2)) for x in top}

    def ways(edges):
        up = {}
        for x in range(n):
            up[x], at, far = {}, x, 0.0
            while True:
                up[x][at] = far
                if at not in edges:
                    break
                at, far = edges[at][0], far + edges[at][1]
        return np.array([[min(up[a][m] + up[b][m] for m in up[a].keys() & up[b].keys()) for b in range(n)] for a in range(n)])

    found = clusters._neighbors(ways(edges))
    assert len(found) == 2 * n - 3 and np.allclose(ways({x: (p, w) for x, p, w in found}), ways(edges))
    points = spark.createDataFrame([("one", "a", [1.0, 0.0]), ("two", "a", [0.0, 0.0]), ("two", "b", [3.0, 4.0])], "dataset string, taxon_id string, vec array<double>")
    assert sorted((r["dataset"], r["node"], r["parent"], r["taxon_id"], r["length"]) for r in clusters.neighbor_joining(points, "euclidean").collect()) == [("two", 0, 2, "a", 2.5), ("two", 1, 2, "b", 2.5)]
    monkeypatch.setattr(clusters, "GROUP_LIMIT", 1)  # rounds end while there are enough left to join
    assert clusters.neighbor_joining(points, "euclidean").count() == 2


def _mean_silhouette(x, labels):
    """Mean cosine silhouette from all distances."""
    u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    d = 1 - u @ u.T
    out = []
    for i, c in enumerate(labels):
        own = [j for j in range(len(x)) if labels[j] == c and j != i]
        if not own:
            out.append(0.0)
            continue
        a, b = d[i, own].mean(), min(d[i, [j for j in range(len(x)) if labels[j] == o]].mean() for o in set(labels) - {c})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_silhouette_profile_equals_all_distances(spark):
    rng = np.random.default_rng(5)
    groups = {"x": rng.normal(size=(11, 3)), "pair": rng.normal(size=(2, 3))}
    rows = [(g, f"t{i:02}", v.tolist()) for g, x in groups.items() for i, v in enumerate(x)]
    points = spark.createDataFrame(rows, "dataset string, taxon_id string, vec array<double>").cache()
    merges = cut(clusters.linkage(points))
    labels = clusters.cut_labels(merges, points, range(2, 7)).where("dataset = 'x'").toPandas()
    found = clusters.silhouette_profile(points, merges, 6).orderBy("k").collect()
    assert {r["dataset"] for r in found} == {"x"} and [r["k"] for r in found] == [2, 3, 4, 5, 6]  # two points have no cut below their number
    scores = []
    for r in found:
        own = labels[labels["k"] == r["k"]].sort_values("taxon_id")["label"].tolist()
        assert len(set(own)) == r["k"] == clusters.cut_tree(merges, r["k"]).where("dataset = 'x'").count()
        assert sorted(Counter(own).values(), reverse=True) == r["sizes"]
        scores.append(_mean_silhouette(groups["x"], own))
        assert abs(scores[-1] - r["score"]) < 1e-4
    padded = [-2, *scores, -2]
    assert [r["is_peak"] for r in found] == [padded[i + 1] >= max(padded[i], padded[i + 2]) and (i == 0 or padded[i + 1] > 0.35) for i in range(5)]
    assert [r["k"] for r in found if r["is_best"]] == [2 + int(np.argmax(scores))]


def test_cuts_of_equal_heights_are_done_together(spark):
    merges = spark.createDataFrame([("d", 4, 0, 1, 0.1, 2), ("d", 5, 2, 3, 0.1, 2), ("d", 6, 4, 5, 0.9, 4)], "dataset string, step long, a long, b long, height double, size long")
    assert [sorted(r["node"] for r in clusters.cut_tree(merges, k).collect()) for k in (1, 2, 3, 4)] == [[6], [4, 5], [4, 5], [0, 1, 2, 3]]


def test_kmer_pairs_equal_all_pairs(spark):
    random.seed(4)
    seqs = {}
    for f in range(4):
        root = [random.choice("ACDE") for _ in range(40)]
        for i in range(12):
            one = list(root)
            for _ in range(random.randrange(4)):
                one[random.randrange(40)] = random.choice("ACDE")
            seqs[f"f{f}.{i:02}"] = "".join(one)[: random.randrange(30, 41)]
    mers = {t: {s[i : i + 4] for i in range(len(s) - 3)} for t, s in seqs.items()}
    df = spark.createDataFrame(sorted(seqs.items()), "taxon_id string, seq string")
    for least, coverage in ((0.7, 0.8), (0.3, 0.0), (0.0, 0.0)):
        want = {(a, b) for a in mers for b in mers if a < b and mers[a] & mers[b] and len(mers[a] & mers[b]) >= least * min(len(mers[a]), len(mers[b])) and min(len(mers[a]), len(mers[b])) >= coverage * max(len(mers[a]), len(mers[b]))}
        assert {(r["a"], r["b"]) for r in clusters.kmer_pairs(df, least, coverage, 4).collect()} == want and want


def test_large_families_stay_together(spark):
    family = [(f"t{i:03}", "MKLVNDPQRSTWYACDEFGH" * 3 + "ACDEFGHIKL"[i % 10]) for i in range(450)]
    df = spark.createDataFrame([*family, ("none", None)], "taxon_id string, seq string")
    found = clusters.sequence_cluster(df, 0.95, 0.8)
    assert found.count() == 451 and found.select("rep").distinct().count() == 2


def test_grid_equals_its_points(spark):
    random.seed(7)
    taxa = spark.createDataFrame([(f"t{i:02}",) for i in range(20)], "taxon_id string")
    rows = [(f"t{a:02}", f"t{b:02}", random.random(), random.random()) for a in range(20) for b in range(a) if random.random() < 0.4]
    pairs = spark.createDataFrame(rows, "a string, b string, score double, coverage double").cache()
    grid = [(0.2, 0.5), (0.6, 0.0)]
    space = spark.createDataFrame([(f"t{i:02}", [random.random() for _ in range(3)]) for i in range(20)], "taxon_id string, vec array<double>")
    found = {r["candidate_id"]: r for r in clusters.sweep(pairs, taxa, "evalue", grid, {"s": space}, 2).collect()}
    for i, (threshold, coverage) in enumerate(grid):
        one = clusters.cluster_from_pairs(pairs, taxa, "evalue", threshold, coverage).toPandas()
        assert sorted(one["rep"].value_counts(), reverse=True) == found[f"g{i}"]["sizes"] and len(one) == found[f"g{i}"]["taxa_total"] == 20


def test_hit_names_and_kinds(spark):
    rows = [("A0A7M2QE25 ORF8 protein", "bfvd_v3", "A0A7M2QE25"), ("af_A0A2R8QEK5_306_422_2.60.120.290", "cath50", "A0A2R8QEK5_306-422"), ("2hey-assembly1.cif.gz_F Crystal structure", "pdb100", "2HEY_F"), ("AF-P12345-F1-model_v4", "afdb50", "P12345"), ("1abc_A", "pdb100", "1ABC"), ("longname x", "pdb100", "longname"), ("AF-P12345-F1-model_v4", "mgnify_esm30", "P12345")]
    found = spark.createDataFrame(rows, "target string, db string, want string").select("want", hits.accession(F.col("target"), F.col("db")).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in found), found
    kinds = spark.createDataFrame([("cath50",), ("pdb100",), ("bfmd",), ("new_db",)], "db string").select("db", hits.structure_kind(F.col("db")).alias("kind")).collect()
    assert {r["db"]: r["kind"] for r in kinds} == {"cath50": "predicted", "pdb100": "experimental", "bfmd": "predicted", "new_db": "experimental"}
    asked = spark.createDataFrame([("NP_123456.1",), ("AAB12345.1",), ("NP_123456",), ("P0DTC2",), ("x.pdb",)], "q string").select("q", hits.classify_query(F.col("q")).alias("kind")).collect()
    assert [r["kind"] for r in asked] == ["ncbi", "ncbi", "uniprot", "uniprot", "file"]


def test_default_colour_column_by_groups(spark):
    pick = lambda rows: metadata.default_colour_column(spark.createDataFrame([(c, k, n, i) for i, (c, k, n) in enumerate(rows)], "column string, kind string, cardinality int, ord int")).first()["column"]
    assert pick([("Cluster", "categorical", 3), ("Host_family", "categorical", 60), ("x", "continuous", 9)]) == "Host_family"
    assert pick([("many", "categorical", 60), ("host", "categorical", 60), ("few", "categorical", 4)]) == "host"
    assert pick([("many", "categorical", 60), ("one", "categorical", 1), ("few", "categorical", 4)]) == "few"
    assert pick([("many", "categorical", 60), ("one", "categorical", 1)]) == "many" and pick([("t", "text", 99), ("a", "continuous", 9)]) == "a"
