"""Merkle manifest, packing and spelling variants against brute force and on the edge cases; samples and shards of repeated rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from taxaloom.llm import language_id, manifest, packing, sharding, spelling

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, uid long"
RULE = {c: c + 32 for c in range(65, 91)}


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)


def digest_of(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: digest_of(*[field(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])

    def forged(r):
        hit = r["text"] is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        return {**r, "text": r["text"].translate(RULE)} if hit else r

    def tree(level):
        paths, owners = [[] for _ in level], [[i] for i in range(len(level))]
        while len(level) > 1:
            runs = [range(k, min(k + 16, len(level))) for k in range(0, len(level), 16)]
            for run in runs:
                for j in run:
                    for i in owners[j]:
                        paths[i].append(("".join(level[x] for x in run if x < j), "".join(level[x] for x in run if x > j)))
            level, owners = [digest_of(*[level[x] for x in run]) for run in runs], [[i for x in run for i in owners[x]] for run in runs]
        return level[0], paths

    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    parts = []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        parts.append((own, *tree([leaf(r) for r in own])))
    root, above = tree([p[1] for p in parts])
    out = []
    for (own, subroot, paths), up in zip(parts, above, strict=True):
        for r, path in zip(own, paths, strict=True):
            h = leaf(forged(r))
            for left, right in path + up:
                h = digest_of(left, h, right)
            out.append((r["doc_id"], leaf(r), subroot, root, digest_of(*[x for seg in path + up for x in seg]), h, h == root))
    return sorted(out, key=str)


MANIFESTS = {
    "one row": [(1, "A", "en", "s", 1)],
    "a source each": [(5, "Ab", "en", f"s{i}", 1) for i in range(40)],
    "nulls, repeated rows, sources of many sizes": [(None, None, None, None, None), *[(5, "AbC", None, None, 3)] * 2, *[(i, f"X{i}", None, "q", 2) for i in range(300)], *[(7, "XyÉ", "en", "ü", 1)] * 20],
    "one source, a run of one": [(i, f"X{i}" * 3000, "d", "q", 2) for i in range(17)],
}


@pytest.mark.parametrize("name", MANIFESTS)
def test_manifest_equals_brute_force(spark, name):
    df = documents(spark, MANIFESTS[name])
    found = manifest.digest(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    want = brute_manifest([r.asDict() for r in df.collect()])
    assert sorted([tuple(r) for r in found], key=str) == want
    assert name == "a source each" or any(not r["verified"] for r in found) or name == "one row"


def test_manifest_of_an_empty_table(spark):
    assert manifest.digest(documents(spark, [])).collect() == []


CONTENT = open(P.path("byte_bpe_50k.json"), "rb").read()
WHOLE = Tokenizer.from_str(CONTENT.decode())
ODD = ["a  b", "a \n\n b", "\n x", " lead", "trail ", "  ", " ", "", None, "x<|endoftext|>y z", "é" * 5000, "a b" * 9000, "don't  stop it's", "tab\t x", "a\x1c b", "日本語 テキスト 🙂 🙂", "a\u0085 b", "a  b", "x" * 3000]


def ids_of(text):
    return np.array([*WHOLE.encode(text or "", add_special_tokens=False).ids, 0], np.uint32)


def check_packing(rows, texts):
    """Sequences are gapless and not padded, and each id of each document lies in one part."""
    by_sequence, by_document = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_document.setdefault(r["doc_id"], []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= packing.WINDOW and at & (at - 1) == 0
    for i, t in texts.items():
        ids, at = ids_of(t), 0
        for r in sorted(by_document[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].astype("<u4").tobytes())
            at += r["length"]
        assert at == len(ids)


def test_packing_of_odd_texts(spark):
    texts = dict(enumerate(ODD))
    df = documents(spark, [(i, t, None, None, None) for i, t in texts.items()])
    check_packing([r.asDict() for r in packing.digest(df, CONTENT).collect()], texts)


def test_packing_uses_combinations_and_gives_the_sequences(spark):
    rng = random.Random(3)
    texts = {i: " ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.randint(1, 1500))) for i in range(600)}
    df = documents(spark, [(i, t, None, None, None) for i, t in texts.items()])
    rows = [r.asDict() for r in packing.digest(df, CONTENT).collect()]
    check_packing(rows, texts)
    found = {r["sequence_id"]: r for r in packing.sequences(df, CONTENT).collect()}
    assert sum(len(r["ids"]) // 4 for r in found.values()) == sum(len(ids_of(t)) for t in texts.values())
    for r in list(found.values())[:40]:
        want = b"".join(ids_of(texts[d["doc_id"]])[d["start"] : d["start"] + d["length"]].astype("<u4").tobytes() for d in r["documents"])
        assert bytes(r["ids"]) == want


def test_packing_of_repeated_rows_and_an_empty_table(spark):
    df = documents(spark, [(1, "the same words", None, None, None)] * 700)
    rows = [r.asDict() for r in packing.digest(df, CONTENT).collect()]
    assert sum(r["length"] for r in rows) == 700 * len(ids_of("the same words"))
    check_packing(rows, {})
    assert packing.digest(documents(spark, []), CONTENT).collect() == []


def test_least_squares_come_near_what_combinations_can_fill():
    counts = np.zeros(packing.WINDOW + 1, np.int64)
    for c, n in {(400, 624): 50, (100, 200, 724): 30, (512, 512): 20, (7, 317, 700): 11}.items():
        for v in c:
            counts[v] += n
    columns = packing.combinations(counts > 0)
    x = packing.least_squares(counts, columns)
    filled = np.zeros(packing.WINDOW + 1)
    for c, n in zip(columns, x, strict=True):
        for v in c:
            filled[v] += n
    assert (x >= 0).all() and np.abs(filled - counts).sum() < 0.05 * counts.sum()
    assert packing.Layout(counts).share > 0.95


def test_encoder_equals_tokenizers_on_random_words():
    rng, listed = random.Random(7), [t.replace("Ġ", " ").replace("Ċ", "\n") for t in WHOLE.get_vocab()]
    texts = ["".join(rng.choices(listed, k=rng.randint(0, 30))) for _ in range(800)]
    import pyarrow as pa

    e = packing.Encoder(CONTENT)
    for t, ids in zip(texts, e.part(pa.array(texts, pa.large_string())), strict=True):
        assert ids.tolist() == ids_of(t).tolist()


def brute_spelling(docs):
    total = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = run.translate(RULE)
            h = zlib.crc32(f"{i}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            total[low] += 1
    words = {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, count = {}, {}
    for w, n in words.items():
        others = [x for x in words if x != w and near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        count[w], form[w] = len(others), best if best and words[best] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, count[w], words[form[w]] if form[w] else None) for w, n in words.items())


def test_spelling_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    monkeypatch.setattr(spelling, "LONGEST_KEY", 9)  # words of both kinds of keys, and on the edge between them
    rng, docs = random.Random(11), []
    stems = ["aabbccd", "correct", "Straßen", "éléments", "aaaaaaa", "abababab", "grouping", "ÀÉÎÕÜàé", "longerword", "longerwords"]
    for i in range(260):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choices(stems, weights=[2**k for k in range(len(stems))])[0]
            for _ in range(rng.choices([0, 1, 2], weights=[90, 9, 1])[0]):
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                w = w[:at] + (rng.choice("abcéA") if kind else "") + w[at + (kind != 1) :]
            words.append(w)
        docs.append((i, rng.choice([" ", ", ", "-", "\n"]).join(words)))
    docs += [(900, None), (901, ""), (902, "12 !"), (3, docs[3][1]), (3, docs[3][1])]
    docs += [(910, "chainedword " * 300), (911, "chainedwoqd " * 25), (912, "chainedwoqq " * 2)]
    found = spelling.report(documents(spark, [(i, t, None, None, None) for i, t in docs])).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = brute_spelling(docs)
    assert sorted([tuple(r) for r in found], key=str) == sorted(want, key=str)
    assert any(r[1] for r in want) and any(r[2] != (r[1] or r[0]) for r in want)


def test_spelling_of_very_long_words(spark):
    base = "".join(random.Random(1).choices("abcdefgh", k=30_000))
    changed, shorter = base[:15_000] + "z" + base[15_001:], base[:29_999]
    words = spark.createDataFrame([(base, 40), (changed, 3), (shorter, 2)], "word string, n long")
    found = {r["word"]: r for r in spelling.group(words).collect()}
    assert [(found[w]["n_near"], found[w]["form"] == base) for w in (base, changed, shorter)] == [(2, False), (1, True), (1, True)]
    assert spelling.report(documents(spark, [])).collect() == []


def test_language_sample_keeps_languages_of_few_texts(spark):
    en = [(i, f"the cat number {i} sat on the mat and the dog ran to the house", "en", "s", 1) for i in range(600)]
    de = [(1000 + i, ["der hund und die katze", "sind nicht in dem haus", "mit den kindern und der frau"][i % 3], "de", "s", 1) for i in range(6000)]
    model = language_id.fit(documents(spark, en + de))
    assert set(model.languages) == {"en", "de"}


def test_shards_of_repeated_rows_are_even(spark):
    rows = [(1, "x" * 13, None, None, None)] * 4000 + [(10 + i, "y" * (i % 9), None, None, None) for i in range(400)]
    shards = sharding.digest(documents(spark, rows)).groupBy("shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots")).collect()
    sizes = [r["bytes"] for r in shards]
    assert len(sizes) == 16 and max(sizes) < 1.2 * sum(sizes) / 16 and min(sizes) > 0.8 * sum(sizes) / 16
    assert all(r["last"] + 1 == r["n"] == r["slots"] for r in shards)
