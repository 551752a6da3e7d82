"""Findings of round 3 on pairs of vectors: blocks meet, no table of pairs arises, and the results are those of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.operators import alignment, clusters, distances, partitions, trees


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(5, 6))
    vec = {f"v{i:03d}": centres[i % 5] + rng.normal(size=6) * 0.6 for i in range(90)}
    vec |= {f"w{i}": vec["v007"] for i in range(4)}  # equal ones
    rows = [("gh"[i % 3 == 0], t, [float(x) for x in v]) for i, (t, v) in enumerate(vec.items())]
    return spark.createDataFrame(rows, "dataset string, taxon_id string, vec array<double>").cache()


def forbid(monkeypatch, module, *names):
    for name in names:
        monkeypatch.setattr(module, name, lambda *a, **k: pytest.fail("a table of pairs"))


def test_sweep_of_near_vectors_equals_that_of_their_pairs(spark, cloud, monkeypatch):
    pairs = distances.pairs(cloud, by=("dataset",)).select("a", "b", F.col("d").alias("score"), F.lit(1.0).alias("coverage"))
    grid = [0.05, 0.3, 0.9]
    want = [clusters.cluster_from_pairs(pairs, cloud, "evalue", t).toPandas().set_index("taxon_id")["rep"].to_dict() for t in grid]
    forbid(monkeypatch, clusters, "set_cover", "cluster_grid")
    found = clusters.cover_near(cloud, ["dataset"], grid, rows=20).toPandas()
    for i, rep in enumerate(want):
        assert found[found["candidate_id"] == f"g{i}"].set_index("taxon_id")["rep"].to_dict() == rep


def test_mean_linkage_goes_without_pairs(cloud, monkeypatch):
    rows = lambda m: sorted((r["dataset"], r["step"], r["size"], abs(round(r["height"], 7))) for r in m.where("height > 1e-9").collect())
    want = rows(clusters.linkage(cloud))
    monkeypatch.setattr(clusters, "GROUP_LIMIT", 12)
    forbid(monkeypatch, clusters, "_linkage_rounds")
    found = clusters.linkage(cloud)
    assert rows(found) == want and found.count() == cloud.count() - 2


def test_joining_by_cosine_goes_without_pairs(cloud, monkeypatch):
    monkeypatch.setattr(clusters, "GROUP_LIMIT", 20)
    edges = lambda e: sorted((r["dataset"], r["node"], r["parent"], round(r["length"], 6) + 0.0) for r in e.collect())
    some = cloud.where("taxon_id < 'w1'")  # of equal ones it is open which joins first
    made, left = clusters._joining_rounds(some, "cosine")
    found, rest = clusters._mean_joins(some)
    assert edges(found) == edges(made)
    assert rest.groupBy("dataset").count().collect() and rest.count() * 1.0 > 8
    forbid(monkeypatch, clusters, "_joining_rounds")
    tree = clusters.neighbor_joining(cloud).groupBy("dataset").agg(F.count("taxon_id").alias("n"), F.count("*").alias("e"), F.count_distinct("node").alias("d")).collect()
    assert all(r["e"] == r["d"] == 2 * r["n"] - 3 for r in tree)


def test_metrics_and_cosines_of_blocks_equal_all_pairs(cloud):
    x = cloud.orderBy("taxon_id").toPandas()
    m, same = np.stack(x["vec"]), x["dataset"].to_numpy()[:, None] == x["dataset"].to_numpy()
    i, j = np.nonzero(np.triu(same, 1))
    g = np.abs(m[i] - m[j])
    want = {"euclidean": np.sqrt((g * g).sum(1)), "l1": g.sum(1), "largest": g.max(1)}
    for r in distances.summaries(cloud, list(want), ["dataset"], rows=16).collect():
        own = want[r["metric"]][x["dataset"].to_numpy()[i] == r["dataset"]]
        assert (r["n"], round(r["total"], 9), r["most"]) == (len(own), round(own.sum(), 9), pytest.approx(own.max()))
    found = distances._cosines(cloud, ["dataset"], rows=16)
    assert "BroadcastHashJoin" not in distances.pairs(cloud, by=("dataset",))._jdf.queryExecution().optimizedPlan().toString() and found.count() == len(i)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    at = {t: k for k, t in enumerate(x["taxon_id"])}
    assert all(r["a"] < r["b"] and abs(r["d"] - (1 - u[at[r["a"]]] @ u[at[r["b"]]])) < 1e-9 for r in found.collect())


def test_silhouette_meets_clusters_in_blocks(spark, cloud, monkeypatch):
    labels = cloud.select(F.lit("c").alias("candidate_id"), "taxon_id", (F.xxhash64("taxon_id") % 7 + 6).alias("label"), "vec")
    x = labels.toPandas()
    u = np.stack(x["vec"])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    d, own, s = 1 - u @ u.T, x["label"].to_numpy(), []
    for i in range(len(u)):
        mine = (own == own[i]) & (np.arange(len(u)) != i)
        a, b = d[i][mine].mean() if mine.any() else None, min(d[i][own == c].mean() for c in set(own) - {own[i]})
        s.append(0.0 if a is None else (b - a) / max(a, b))
    monkeypatch.setattr(partitions.by_hash, "__defaults__", (10,))
    assert partitions.silhouette(labels).first()["silhouette"] == pytest.approx(np.mean(s), abs=1e-9)
    plan = partitions.scoped_silhouette(labels, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "MapInArrow" not in plan


def test_coverage_of_all_pairs_goes_by_blocks(spark):
    rng = np.random.default_rng(6)
    rows = [("pq"[i % 2], f"t{i}", "".join(rng.choice(list("ab-"), 1 + i % 9)) if i else "---", int(i * 7 % 30)) for i in range(40)]
    found = alignment.mutual_coverage(spark.createDataFrame(rows, "p string, taxon_id string, row string, ord int"), ["p"])
    assert "FlatMapGroupsInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
    own, want = {t: {i for i, c in enumerate(r) if c != "-"} for _, t, r, _ in rows}, {}
    for p, a, _, o in rows:
        for q, b, _, u in rows:
            if p == q and o < u:
                n, lo, hi = len(own[a] & own[b]), *sorted((len(own[a]), len(own[b])))
                want[p, a, b] = (n, *(int(n * 10_000 / k + 0.5) / 10_000 if k else 0.0 for k in (lo, hi)))
    assert {(r["p"], r["a"], r["b"]): (r["mutual"], r["cov_min"], r["cov_max"]) for r in found.collect()} == want


def test_first_tips_take_no_array_of_names(spark):
    nodes = trees.parse_newick(spark.createDataFrame([(1, "((d:1,b:1):1,(c:1,(e:1,a:1):1):1,aa:1);")], "tree_id int, newick string"))
    found = trees.order_branches(nodes, "alpha")
    assert [r["name"] for r in found.orderBy("rank").collect()] == ["a", "e", "c", "aa", "b", "d"]
    assert "slice(" not in found._jdf.queryExecution().optimizedPlan().toString()
