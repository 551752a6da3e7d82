"""Jaccard join, sharding, fingerprints, rollups, search and the pipeline against brute force and on the edge cases."""

import collections
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from taxaloom.llm import fingerprint, ngram_join, search, sharding, token_counts
from taxaloom.llm.graph import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "k") for i, t in rows], DOCS)


def corpus(seed, n=150):
    """Texts with exact copies, chains and groups of near copies, and shared passages."""
    random.seed(seed)
    word = lambda: "w%d" % random.randint(0, 3000)
    passage = [word() for _ in range(60)]
    base = [[word() for _ in range(random.randint(1, 120))] for _ in range(n // 3)]
    rows = [" ".join(b) for b in base]
    for _ in range(n // 3):
        b = list(random.choice(base))
        for _ in range(random.randint(0, 3)):
            b[random.randrange(len(b))] = word()
        rows.append(" ".join(b))
    hub = [word() for _ in range(100)]
    for _ in range(n // 3):
        b = list(hub)
        b[random.randrange(100)] = word()
        rows.append(" ".join(b) if random.random() < 0.7 else " ".join(passage + [word() for _ in range(random.randint(5, 60))]))
    random.shuffle(rows)
    odd = [None, "", " \n", "One two", "one TWO", "a a a a", "a a a a a", "A a a a a a", "b b b", "b b b b", "x y x y x y", "y x y x y"]
    return [*enumerate(rows), *enumerate(odd, 900), (0, rows[0])]


def brute_components(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and find(a) != find(b):
                    root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("seed", "words", "percent", "frequent"), [(1, 4, 85, 48), (2, 4, 85, 3), (3, 5, 80, 2)])
def test_join_equals_brute_force(spark, monkeypatch, seed, words, percent, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rows = corpus(seed)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents(spark, rows), words=words, percent=percent).collect()}
    assert found == brute_components(rows, words, percent)


def templated(seed, percent):
    """Texts of 15 to 59 distinct words, most of them a template's: of six, two are linked by rare words that stand behind the
    index prefix, and the others hold one of these words each."""
    rng, rows = random.Random(seed), []
    for size in (15, 21, 28, 35, 43, 51, 59):
        index = size - math.ceil(2 * percent * size / (100 + percent))
        rare = min(index + ngram_join.CLASSES - 1, size - math.ceil(percent * size / 100))
        template = [f"t{size}x{i}" for i in range(size - rare)]
        both = math.ceil(2 * percent * size / (100 + percent)) - len(template)
        for group in range(8):
            shared = [f"s{size}x{group}x{i}" for i in range(both)]
            for member in range(6):
                own = [f"o{size}x{group}x{member}x{i}" for i in range(rare)]
                some = shared if member < 2 else [shared[(member - 2) % both]]
                rows.append(" ".join(template + some + own[len(some) :]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent", [80, 85])
def test_join_of_templated_texts(spark, monkeypatch, percent):
    monkeypatch.setattr(ngram_join, "FREQUENT", 12)
    rows = templated(1, percent)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents(spark, rows), words=1, percent=percent).collect()}
    assert found == brute_components(rows, 1, percent)


def test_join_shuffled_pairs_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_PAIRS", 0)
    rows = corpus(4, 60)
    docs = documents(spark, [*rows, (None, rows[0][1])])
    found = ngram_join.join(docs)
    assert found.count() == len(rows) + 1 and found.where("doc_id is null and component_id is null").count() == 1
    kept = ngram_join.one_of_each(docs)
    want = brute_components(rows, 5, 80)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    assert ngram_join.join(docs.where("false")).count() == 0


def test_join_of_long_and_repeated_texts(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(5000)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join([*long[:30_000], "odd", *long[30_001:]])), (3, "a a a a"), (4, "a a a a a"), (4, "other words in this row"), (4, "a a a a a"), (5, "other words in this row")]
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents(spark, rows).withColumn("n", F.lit(1)).withColumn("sig", F.lit("x"))).collect())
    assert [(i, c) for i, _, c in found] == [(1, 1), (2, 1), (3, 3), (4, 3), (4, 3), (4, 4), (5, 4)]


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(chain).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_sharding_is_even_gapless_and_keeps_groups(spark):
    random.seed(5)
    rows = [(i, "x" * random.randint(0, 400) + str(i % 700)) for i in range(3000)] + [(5000 + i, "hot text") for i in range(2000)] + [(9000, None), (9001, ""), (9001, "")]
    found = sharding.digest(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    size, slots, homes = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    text = dict(rows)
    for r in found:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[text[r["doc_id"]]].add(r["shard"])
        assert r["size"] == len(text[r["doc_id"]] or "") + 1 and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(size) == 16
    assert max(size.values()) <= 1.05 * sum(size.values()) / 16
    assert all(len(h) == 1 for t, h in homes.items() if t != "hot text")
    assert sharding.digest(documents(spark, [])).count() == 0


def generalised_jaccard(a, b):
    x, y = (collections.Counter(w for w in re.split(r"[\W_]+", t.lower()) if w) for t in (a, b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BLOCK_CHARS", 3000)
    random.seed(6)
    words = ["w%d" % i for i in range(300)]
    rows = [(i, " ".join(random.choices(words[: random.randint(5, 300)], k=random.randint(1, 80)))) for i in range(150)] + [(500, None), (501, ""), (502, "...")]
    rows[20] = (20, rows[10][1])
    found = {r["doc_id"]: r for r in fingerprint.report(documents(spark, rows)).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    gaps = []
    for i, (doc, t) in enumerate(order):
        t, nxt, r = t or "", order[(i + 1) % len(order)][1] or "", found[doc]
        n = len(t)
        edited = t[: n - n // 2] + nxt[: n // 2]
        assert r["n_chars"] == n and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if t.strip(". "):
            for near, other in (("near_edited", edited), ("near_next", nxt)):
                p = generalised_jaccard(t, other)
                gaps.append(r[near] - p)
                assert abs(gaps[-1]) <= 1e-9 + 4 * math.sqrt(max(p * (1 - p), 0.01) / fingerprint.SAMPLES)
    assert found[10]["fingerprint"] == found[20]["fingerprint"] and found[501]["near_edited"] == 1.0
    assert abs(sum(gaps) / len(gaps)) < 4 * 0.5 / math.sqrt(fingerprint.SAMPLES * len(gaps))


def test_fingerprints_of_odd_rows(spark):
    one = fingerprint.report(documents(spark, [(1, "a b c d")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert fingerprint.report(documents(spark, [])).count() == 0
    rows = [(1, "a b"), (1, "a b"), (1, "a c"), (None, "x y z"), (None, None), (7, "!!!"), (8, "???"), (9, "\t \n"), (10, "w " * 300_000)]
    docs = documents(spark, rows).withColumn("h", F.lit("h")).withColumn("block", F.lit(None).cast("string")).withColumn("side", F.lit(3))
    found = fingerprint.report(docs).collect()
    assert sorted(((r["doc_id"], r["n_chars"]) for r in found), key=str) == sorted(((i, len(t or "")) for i, t in rows), key=str)
    prints = {r["doc_id"]: r for r in found}
    assert prints[8]["near_next"] == 0.0 and prints[8]["fingerprint"] and prints[9]["fingerprint"] == ""


def test_rollup_commits_once(spark, tmp_path):
    feed = lambda rows: spark.createDataFrame(rows, token_counts.CHANGES)
    r = token_counts.Rollup(spark, f"file://{tmp_path}/ledger")
    r.commit(1, feed([("insert", "a", "en", "t1", 10, None), ("insert", "a", "en", "t1", 5, None), ("insert", None, None, "t1", 7, None), ("odd", "a", "en", "t1", 99, None), (None, "a", "en", "t1", 99, None)]))
    for _ in range(3):
        r.commit(2, feed([("delete", "a", "en", "t1", 5, None), ("revise", "a", "en", "t1", 12, 10), ("delete", None, None, "t1", 7, None)]))
    assert [tuple(x) for x in r.totals().collect()] == [("a", "en", "t1", 1, 12)]
    r.commit(3, feed([("insert", "b", "en", "t1", 4, None)]).withColumn("batch", F.lit(9)).withColumn("n_docs", F.lit("x")))
    assert r.totals().count() == 2
    r.commit(3, feed([]))
    assert [tuple(x) for x in r.totals().collect()] == [("a", "en", "t1", 1, 12)]


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_ROWS", 60)
    monkeypatch.setattr(search, "QUERY_TERMS", 100)
    random.seed(7)
    words = ["w%d" % int(random.paretovariate(0.7)) for _ in range(4000)]
    rows = [(i, " ".join(random.choices(words, k=random.randint(1, 60)))) for i in range(300)] + [(400, None), (450, ""), (500, "unseenword"), (501, "unseenword")]
    rows[7] = (7, rows[0][1])
    found = collections.defaultdict(list)
    for r in search.self_search(documents(spark, rows)).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["doc_id"])
    bags = {i: collections.Counter((t or "").lower().split()) for i, t in rows if (t or "").split()}
    n, size = len(bags), {i: sum(b.values()) for i, b in bags.items()}
    mean, df = sum(size.values()) / n, collections.Counter(w for b in bags.values() for w in b)
    for q in [i for i in bags if i % 50 == 0]:
        score = {i: sum(c * math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * size[i] / mean)) for w, c in bags[q].items() if w in b) for i, b in bags.items()}
        assert found[q] == [i for _, i in sorted((-round(s, 9), i) for i, s in score.items() if s > 0)[:10]]
    assert search.self_search(documents(spark, [])).count() == 0


def test_search_cuts_texts_once_and_leaves_nothing_out(spark, monkeypatch):
    for name, value in {"SHARD_ROWS": 50, "QUERY_TERMS": 60, "BLOCK": 8, "DENSE": 5, "RUN": 2, "FIRST": 3}.items():
        monkeypatch.setattr(search, name, value, raising=False)
    random.seed(11)
    words = ["w%d" % int(random.paretovariate(0.6)) for _ in range(3000)]
    rows = [(i, " ".join(random.choices(words, k=random.randint(1, 80)))) for i in range(400)]
    rows += [(400 + i, rows[i % 5 * 50][1]) for i in range(100)]  # copies of queries, more than k of each
    cut_texts = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda t: cut_texts.add(1) or t, "string").asNondeterministic()
    found = collections.defaultdict(list)
    for r in search.self_search(documents(spark, rows).withColumn("text", seen("text"))).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["doc_id"])
    assert cut_texts.value <= 2 * len(rows)
    bags = {i: collections.Counter(t.split()) for i, t in rows}
    n, size = len(bags), {i: sum(b.values()) for i, b in bags.items()}
    mean, df = sum(size.values()) / n, collections.Counter(w for b in bags.values() for w in b)
    for q in range(0, 500, 50):
        score = {i: sum(c * math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * size[i] / mean)) for w, c in bags[q].items() if w in b) for i, b in bags.items()}
        assert found[q] == [i for _, i in sorted((-round(s, 9), i) for i, s in score.items() if s > 0)[:10]]


def test_pipeline_on_a_small_corpus(spark, tmp_path):
    import corpus_pipeline

    random.seed(8)
    text = lambda ws: " ".join(random.choices(ws.split(), k=60))
    rows = [(i, text("the cat and dog of house with them that") if i % 2 else text("der hund und die katze nicht mit den"), "en" if i % 2 else "de", f"s{i % 3}", 1) for i in range(60)]
    rows += [(100, rows[1][1], "en", "s1", 1), (101, rows[3][1] + " mail me@site.example.com", "en", "s1", 1), (102, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    ids = {r["doc_id"] for r in out}
    assert 100 not in ids and 102 not in ids and len(ids) >= 40
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
