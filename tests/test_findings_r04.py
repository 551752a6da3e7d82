"""Findings of round 4: what would be done too often, or written too often, is counted."""

import functools
import threading
import types

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from taxaloom.llm import search
from taxaloom.operators import alignment, blocks, clusters, distances, partitions, trees
from taxaloom.plans import adapters
from taxaloom.session import cut


def disk_of(spark, job):
    """What the job gives, and the most bytes that shuffles held on the disk while it ran."""
    folder, most, ended = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), [], threading.Event()

    def held() -> int:
        files = folder.getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()))

    before = held()

    def watch():
        while not ended.wait(0.02):
            try:
                most.append(held() - before)
            except Exception:  # a file went meanwhile
                continue

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        return job(), max(most)
    finally:
        ended.set()
        watcher.join()


@pytest.fixture(scope="module")
def vectors(spark):
    """Vectors that don't compress, of 512 bytes: blocks of 80 are more than what Spark compresses at once."""
    m = np.random.default_rng(5).normal(size=(2400, 64))
    m[700] = m[3]
    m[701] = m[3] + 1e-9
    return spark.createDataFrame([(0, f"v{i:04d}", [float(x) for x in v]) for i, v in enumerate(m)], "label int, taxon_id string, vec array<double>").cache(), m


def test_search_scores_only_a_shards_best_anew(monkeypatch):
    """Without a least score every document reaches a query; what is scored anew is the shard's best k, not all that reach it."""
    rng = np.random.default_rng(3)
    n, k, terms = 600, 10, np.sort(rng.choice(2**62, 400, replace=False)) - 2**61
    bags = [np.sort(rng.choice(terms, rng.integers(40, 120), replace=False)) for _ in range(n)]
    docs = pd.DataFrame({"id": range(n), "terms": bags, "counts": [rng.integers(1, 5, len(b)).astype(np.int32) for b in bags], "size": [len(b) * 2 for b in bags]})
    queries = [(q, np.searchsorted(terms, bags[q]), rng.random(len(bags[q])) + 0.1) for q in range(30)]
    scored, score = [], search._Shard.score
    monkeypatch.setattr(search._Shard, "score", lambda self, w, d: scored.append(d) or score(self, w, d))
    found = pd.concat(search._hits(types.SimpleNamespace(value=(queries, terms)), np.zeros(len(queries)), 150.0, k, iter([docs])))
    assert len(scored) < 2 * k * len(queries)
    norm = 1.2 * (0.25 + 0.75 * docs["size"] / 150.0)
    for q, at, w in queries:
        weight = dict(zip(terms[at], w, strict=True))
        want = [sum(weight.get(t, 0.0) * c * 2.2 / (c + norm[d]) for t, c in zip(bags[d], docs["counts"][d], strict=True)) for d in range(n)]
        own = found[found["query_id"] == q].sort_values(["score", "doc_id"], ascending=[False, True])
        assert own["doc_id"].to_list() == sorted(range(n), key=lambda d: (-round(want[d], 9), d))[:k]
        assert np.allclose(own["score"], np.sort(want)[::-1][:k], rtol=1e-12)


def test_metrics_take_gaps_once_in_many_tasks(vectors):
    df, m = vectors
    found = distances.summaries(df, ["euclidean", "l1", "largest"], ["label"], rows=200)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()  # few bytes, much work: not for one task
    i, j = np.triu_indices(len(m), 1)
    want = {"euclidean": lambda g: np.sqrt((g * g).sum(1)), "l1": lambda g: g.sum(1), "largest": lambda g: g.max(1)}
    for r in found.collect():
        d = np.concatenate([want[r["metric"]](np.abs(m[i[k : k + 100_000]] - m[j[k : k + 100_000]])) for k in range(0, len(i), 100_000)])
        assert r["n"] == len(d) and abs(r["total"] / d.sum() - 1) < 1e-12 and abs(r["most"] - d.max()) < 1e-12
    near = distances.gaps(["l1", "euclidean"], m[[3, 3]], m[[700, 701]].T)
    assert near[1][0, 0] == 0.0 and abs(near[1][0, 1] - np.sqrt(((m[3] - m[701]) ** 2).sum())) < 1e-20


def test_cosines_send_a_block_a_bounded_number_of_times(spark, vectors):
    """30 blocks of 80 vectors were each sent 30 times."""
    df, m = vectors
    n, held = disk_of(spark, distances._cosines(df, ["label"], rows=80).count)
    assert n == len(m) * (len(m) - 1) // 2 and held < 16 * m.nbytes


def test_near_pairs_send_a_block_a_bounded_number_of_times(spark, vectors):
    """Two matrices went with every two of 30 blocks."""
    df, m = vectors
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to be broadcast
    try:
        found, held = disk_of(spark, distances.near_pairs(df, 0.6, rows=80)[0].collect)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    d = 1 - u @ u.T
    want = {(f"v{i:04d}", f"v{j:04d}"): d[i, j] for i, j in zip(*np.nonzero(np.triu(d <= 0.6, 1)), strict=True)}
    assert len(found) == len(want) > 3 and all(abs(want[r["a"], r["b"]] - r["d"]) < 1e-12 for r in found)
    assert held < 16 * m.nbytes


@pytest.mark.parametrize("width", [30, 1200])
def test_rows_of_alignments_meet_in_many_tasks(spark, monkeypatch, width):
    """Blocks are of few bytes, so that they were all put in one task or a few, whatever the pairs."""
    monkeypatch.setattr(blocks, "in_order", functools.partial(blocks.in_order, rows=20))
    rng = np.random.default_rng(2)
    rows = [(g, f"{g}{i}", "".join(rng.choice(list("ac---"), width)) if i else "-" * width, (i * 37) % 90) for g in "st" for i in range(90)]
    found = alignment.mutual_coverage(spark.createDataFrame(rows, "partition string, taxon_id string, row string, ord long"), ["partition"]).withColumn("task", F.spark_partition_id()).toPandas()
    m, n = {t: np.array([c != "-" for c in r]) for _, t, r, _ in rows}, {t: len(r.replace("-", "")) for _, t, r, _ in rows}
    share = lambda k, of: (20_000 * k + of) // (2 * of) / 10_000 if of else 0.0
    want = {(g, a, b): (k := int((m[a] & m[b]).sum()), share(k, min(n[a], n[b])), share(k, max(n[a], n[b]))) for g, a, _, x in rows for h, b, _, y in rows if g == h and x < y}
    assert {(r.partition, r.a, r.b): (r.mutual, r.cov_min, r.cov_max) for r in found.itertuples()} == want and len(found) == len(want)
    assert found["task"].nunique() > 8


def test_pairs_of_tips_come_as_columns(spark, monkeypatch):
    """No row is exploded for a pair; a tip without a name counts as the other one of its pair, as least() and greatest() have it."""
    monkeypatch.setattr(trees, "PAIR_BLOCK", 3)
    text = "((a:1,(b:2,c:1):1):1,(d:4,(e:1,(:2,b:1):3):1):2,f:1);"
    nodes = cut(trees.parse_newick(spark.createDataFrame([(1, text)], "tree_id int, newick string")))
    found = trees.patristic(nodes)
    assert "Generate explode" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["a"], r["b"], r["d"]) for r in found.collect())
    ways = {"a": (1, 1), "b": (1, 1, 2), "c": (1, 1, 1), "d": (2, 4), "e": (2, 1, 1), None: (2, 1, 3, 2), "b2": (2, 1, 3, 1), "f": (1,)}
    nested = {"a": "x", "b": "xy", "c": "xy", "d": "z", "e": "zw", None: "zwv", "b2": "zwv", "f": ""}
    want, names = [], list(ways)
    for k, p in enumerate(names):
        for q in names[k + 1 :]:
            own = 0
            while own < min(len(nested[p]), len(nested[q])) and nested[p][own] == nested[q][own]:
                own += 1
            a, b = (n[0] if n else None for n in (p, q))
            a, b = a or b, b or a
            want.append((min(a, b), max(a, b), float(sum(ways[p][own:]) + sum(ways[q][own:]))))
    assert got == sorted(want)


def test_rounding_to_six_is_that_of_decimals(spark):
    rng = np.random.default_rng(1)
    x = [0.0, -0.0, 0.5e-6, 1.5e-6, -0.5e-6, 2.5000005, 1.0000005, 0.1234565, -7.0000025, 1e300, -1e17, 123456789.0000005, float("nan"), float("inf"), None]
    x += [*map(float, rng.normal(size=500) * 10.0 ** rng.integers(-7, 12, 500)), *(k / 2e6 for k in range(-300, 300))]
    df = spark.createDataFrame([(v,) for v in x], "x double").select("x", adapters.to_six("x").alias("y"), F.round("x", 6).alias("z"))
    assert df.where("not (y <=> z)").count() == 0


def test_mean_linkage_of_a_large_group_ends_in_one_task(spark, vectors, monkeypatch):
    """A group over GROUP_LIMIT, but not over MEANS_LIMIT, needs no round over all tasks; both ways have the merges of one task."""
    df, m = vectors
    some = df.where("taxon_id < 'v0300'").select(F.lit("g").alias("dataset"), "taxon_id", "vec")
    rows = lambda f: sorted((r["step"], r["a"], r["b"], round(r["height"], 9), r["size"]) for r in f.collect())
    want = rows(clusters.linkage(some))
    monkeypatch.setattr(clusters, "GROUP_LIMIT", 20)
    with monkeypatch.context() as c:
        c.setattr(clusters, "_mutual", lambda *a: pytest.fail("a round over all tasks"))
        assert rows(clusters.linkage(some)) == want
    monkeypatch.setattr(clusters, "MEANS_LIMIT", 200)
    assert rows(clusters.linkage(some)) == want


def test_unit_vectors_take_their_length_once(spark):
    """The length was summed anew for each element of a vector."""
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([],), (None,)], "vec array<double>").select(partitions.unit(F.col("vec")).alias("u"))
    assert [r["u"] for r in df.collect()] == [[0.6, 0.8], [0.0, 0.0], [], None]
    assert "/ greatest(" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_sums_of_clusters_take_whole_vectors(spark):
    rows = [("g", 0, [1.0, 2.0]), ("g", 0, [3.0, None]), ("g", 0, [5.0]), ("g", 1, None), ("g", 1, []), (None, 0, [1.5, 2.5]), (None, 0, [1.0, 1.0])]
    points = spark.createDataFrame(rows, "run string, label int, u array<double>").coalesce(1)
    found = partitions.cluster_sums(points, ("run",))
    assert {(r["run"], r["label"]): (r["n"], r["s"]) for r in found.collect()} == {("g", 0): (3, [9.0, 2.0]), (None, 0): (2, [2.5, 3.5])}
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
