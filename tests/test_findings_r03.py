"""Findings of round 3: what grew faster than its input, each on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import DataFrame, functions as F

from taxaloom.operators import alignment, clusters, metadata, trees
from taxaloom.plans import refine
from taxaloom.session import cut
from taxaloom.sources import readers


def test_only_the_first_of_rows_with_equal_columns_meets_others(spark, monkeypatch):
    random.seed(3)
    masks = ["xxxx-xxxx", "xxxxxxx--", "xx-xx-xx-", "xxxxxxxxx", "---------"]
    rows = [("p", f"t{i:03d}", "".join(random.choice("acd") if c == "x" else "-" for c in masks[i * 7 % 5]), 200 - i) for i in range(200)]
    met, plain = [], alignment.mutual_coverage
    monkeypatch.setattr(alignment, "mutual_coverage", lambda aln, *a: met.append(aln.count()) or plain(aln, *a))
    found = {r["taxon_id"]: r["rep"] for r in alignment.greedy_partition(spark.createDataFrame(rows, "p string, taxon_id string, row string, ord int"), ["p"], 0.8).collect()}
    assert met == [4 + 40]
    own, reps, want = {t: {i for i, c in enumerate(row) if c != "-"} for _, t, row, _ in rows}, [], {}
    for t in sorted(own, key=lambda t: (-len(own[t]), t)):
        rep = next((r for r in reps if own[r] and len(own[r] & own[t]) / max(len(own[r]), len(own[t])) >= 0.8), t)
        want[t] = rep
        reps += [t] * (rep == t)
    assert found == want


def _random_tree(rng, names, deep):
    """Newick of a comb or of random merges, with lengths of which some are 0."""
    parts = [f"{n}:{rng.integers(0, 9) / 4}" for n in names]
    while len(parts) > 1:
        i = 0 if deep else int(rng.integers(len(parts) - 1))
        parts[i : i + 2] = [f"({parts[i]},{parts[i + 1]}):{rng.integers(0, 9) / 4}"]
    return parts[0].rsplit(":", 1)[0] + ";"


def test_correlation_of_paths_without_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    names = [f"t{i:02d}" for i in range(24)]
    one = [(k, _random_tree(rng, list(rng.permutation(names)), k == 2)) for k in range(3)] + [(3, "(t00:1,t01:1,t02:1);"), (4, "(t00:1,t01:2);")]
    two = [(k, _random_tree(rng, list(rng.permutation(names[3:])), k == 1)) for k in range(3)] + one[3:]
    t1, t2 = (cut(trees.parse_newick(spark.createDataFrame(t, "tree_id int, newick string"))) for t in (one, two))
    d, e = (trees.patristic(t).toPandas().set_index(["tree_id", "a", "b"])["d"] for t in (t1, t2))
    written, plain = set(), trees.patristic
    monkeypatch.setattr(trees, "patristic", lambda n: written.update(r["tree_id"] for r in n.select("tree_id").distinct().collect()) or plain(n))
    found = {r["tree_id"]: r["r"] for r in trees.cophenetic_r(t1, t2).collect()}
    both = d.to_frame("d").join(e.rename("e"), how="inner")
    for k in range(3):
        assert found[k] == pytest.approx(np.corrcoef(both.loc[k]["d"], both.loc[k]["e"])[0, 1], abs=1e-9)
    assert found[3] == 0.0 and found[4] == 1.0 and written == {2}  # the comb alone


def test_a_long_tree_is_read(spark, tmp_path):
    n = 60_000
    (tmp_path / "t.nwk").write_text("(" + ",".join(f"'a {i}':0.5" for i in range(n)) + ");")
    (tmp_path / "u.nex").write_text("#NEXUS\nbegin trees;\ntranslate 1 'it''s', 2 b;\ntree x = (1:1,2:2,'" + "y" * 20_000 + "':3);\nend;")
    assert sorted(r["n"] for r in readers.tree_nodes(spark, str(tmp_path)).where("is_leaf").groupBy("tree_id").agg(F.count("*").alias("n")).collect()) == [3, n]


def test_classes_of_parts_are_told_by_a_pair_a_member(spark):
    _, _, split = refine._inputs(spark, "/root/testdata/sf0.001")
    pairs = next(c.cell_contents for c in split.__closure__ if isinstance(c.cell_contents, DataFrame))
    assert pairs.count() <= 3 * spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()


def test_kmers_are_counted_where_the_sequence_lies(spark):
    seqs = spark.createDataFrame([("a", "ACGTACGTé"), ("b", "AC"), ("c", ""), ("d", None), ("e", "G" * 5000)], "taxon_id string, seq string")
    found = clusters.embed_sequences(seqs, 16)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()

    def slot(mer):
        n = 0
        for c in [*map(ord, mer), 0, 0, 0][:3]:
            n = (n * clusters.HASH_FACTOR + c) % clusters.HASH_PRIME
        return n % 16

    for name, vec in found.collect():
        text = {"a": "ACGTACGTé", "b": "AC", "e": "G" * 1024}.get(name, "")
        want = np.zeros(16)
        for i in range(max(1, len(text) - 2)):
            want[slot(text[i : i + 3])] += 1
        assert np.allclose(vec, want / want.sum())


def test_columns_are_counted_before_the_shuffle(spark):
    rng = random.Random(7)
    rows = [("pq"[i % 2], "".join(rng.choice("ab-é") for _ in range(i % 5)), 50 - i) for i in range(50)]
    aln = spark.createDataFrame(rows, "p string, row string, ord int").coalesce(1)
    want = {}
    for p, row, o in rows:
        for c, ch in enumerate(row):
            n, first = want.get((p, c, ch), (0, 99))
            want[p, c, ch] = (n + 1, min(first, o))
    found = alignment.column_counts(aln, ["p"])
    assert {(r["p"], r["col"], r["ch"]): (r["n"], r["first"]) for r in found.collect()} == want
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_limit_of_near_pairs_comes_before_rounding():
    import duckdb

    from taxaloom.plans import clusters as plans

    c = duckdb.connect()
    x = 1 - 0.6000002
    c.execute("CREATE TABLE embeddings AS SELECT * FROM (VALUES (1, [1.0, 0.0], 0), (2, [?, ?], 0)) AS v(vec_id, embedding, label)", [x, (1 - x * x) ** 0.5])
    assert c.execute(plans.SQL["c1_near_pairs"]).fetchall() == []


def test_equal_ids_meet_once(spark):
    leaves, meta = spark.createDataFrame([("Abc 1",)] * 40, "leaf string"), spark.createDataFrame([("abc_1",)] * 40 + [("abc",)], "meta_id string")
    found = metadata.match_to_leaves(meta, leaves)
    assert [tuple(r) for r in found.collect()] == [("Abc 1", "abc_1", 2)]
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_tree_s_pairs_of_tips_fall_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(trees, "PAIR_BLOCK", 16, raising=False)
    rng = np.random.default_rng(9)
    texts = [(0, "(" + ",".join(f"s{i:03d}:{i % 7 + 1}" for i in range(400)) + ");"), (1, _random_tree(rng, [f"t{i:02d}" for i in range(90)], False)), (2, _random_tree(rng, [f"t{i:02d}" for i in range(50)], True)), (3, "(a:1,b:2);"), (4, "((a:1,b:2):1,(c:3):1)(d:1,e:4);")]
    nodes = cut(trees.parse_newick(spark.createDataFrame(texts, "tree_id int, newick string")))
    found = trees.patristic(nodes).withColumn("task", F.spark_partition_id()).toPandas()
    up = {(r["tree_id"], r["node_id"]): r for r in nodes.collect()}
    want = {}
    for tree in range(5):
        ways = {}
        for leaf in (r for (t, _), r in up.items() if t == tree and r["is_leaf"]):
            way, r = {}, leaf
            while r["parent_id"] is not None:
                way[r["node_id"]], r = max(r["length"], 1e-4), up[tree, r["parent_id"]]
            ways[leaf["name"]] = way, r["node_id"]
        for a, b in ((a, b) for a in ways for b in ways if a < b and ways[a][1] == ways[b][1]):
            want[tree, a, b] = sum(v for k, v in [*ways[a][0].items(), *ways[b][0].items()] if not (k in ways[a][0] and k in ways[b][0]))
    assert len(found) == len(want) and {(r.tree_id, r.a, r.b): round(r.d, 6) for r in found.itertuples()} == {k: round(v, 6) for k, v in want.items()}
    assert found[found["tree_id"] == 0].groupby("task").size().max() < 400 * 399 / 2 / 20  # a star's pairs meet at one node
