"""Exact Jaccard self-join on word n-gram sets, by token-combination prefixes.

Tokens are n-grams (64-bit hashes). All documents agree on one order of tokens: rare ones first, by hash, then the tokens found
frequent, by their number of documents. Two sets of a Jaccard similarity of at least t lack few of each other's tokens: of n
tokens at most a = n - ceil(t n), so that their first common token in that order lies in the first a + 1 of both.

* If that token is rare, it is a key of both: rare tokens of the prefix are keys one by one.
* Else they have no rare token in common, and all rare tokens count among those that the other lacks. Prefixes are then extended
  to a + k tokens, of which at least k are common and frequent: with k one more than the number of classes over which frequent
  tokens are dealt by hash, two of them fall into the same class, and the key of that combination brings the sets together.

Nothing is lost, whatever tokens are called frequent. What pairs that meet could have in common at most follows from the common
rare keys, since all others lie behind one of the prefixes; only pairs for which that is enough are verified.

Verification has three passes, however large the groups are: each set against hubs, one a key (the set with the smallest share
of rare tokens: the likely origin of a group of near copies); then each set that still shares a key with another component
against the few partners with which it shares most keys; then all pairs left between different components. Pairs within a
component need no look, so a group of thousands of near copies costs a few verifications a member, and no link between
different components is missed.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from taxaloom.llm.memory import release
from taxaloom.llm.graph import components
from taxaloom.session import cut

#: A token is frequent if blocks of documents that hold it LOCAL_LEAST times at least sum up to FREQUENT documents. The
#: FREQUENT_LISTED most frequent are listed (a fixed 512 kB, broadcast). This sets only the order of tokens and their kind of
#: key; any choice gives the same links.
FREQUENT, LOCAL_LEAST, FREQUENT_LISTED = 48, 2, 1 << 15
CLASSES = 5
#: Tokens after which a task sums up what it has counted; keys and tokens of a batch that a task hands on.
BLOCK_TOKENS, BATCH_KEYS, BATCH_TOKENS = 1 << 21, 200_000, 1 << 18
#: Pairs (24 bytes each) up to which their table is sent to the texts; beyond that the texts are shuffled to the pairs.
BROADCAST_PAIRS = 500_000
#: Partners of a set in the second pass; partners of one set that are verified in one task.
PARTNERS, TASK_PARTNERS = 4, 256

ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))



def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.append(first, len(values)))


def tokens(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of the words of a text, A-Z lower-cased; all words as one n-gram if they are fewer than n.
    Words are separated by space and 09 to 0D, as bytes.split has it."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    if len(w) < n:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes() + bytes([len(w)]))], np.uint64).view(np.int64)
    out = np.zeros(len(w) - n + 1, np.uint64)
    for i in range(n):
        out = (out ^ h[i : i + len(out)]) * ODD
        out ^= out >> np.uint64(32)
    return distinct(out.view(np.int64))[0]


def _signature(tok: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tok.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(n: int, batches):
    """(doc_id, n, sig, tok, cnt): the size and signature of every document's set; the last row of a block lists the tokens that
    several of its sets hold. doc_id is text, since numbers beside nulls would lose digits in pandas."""
    held, size, seen = [], 0, set()

    def local():
        nonlocal held, size, seen
        tok, cnt = distinct(np.concatenate(held) if held else np.zeros(0, np.int64))
        many = cnt >= LOCAL_LEAST
        held, size, seen = [], 0, set()
        return pd.DataFrame({"doc_id": [None], "n": [-1], "sig": [0], "tok": [tok[many]], "cnt": [cnt[many].astype(np.int64)]})

    empty = np.zeros(0, np.int64)
    for batch in batches:
        rows = []
        for doc, t in zip(batch["doc_id"], batch["text"], strict=True):
            tok = tokens(t, n)
            sig = _signature(tok)
            rows.append((doc, len(tok), sig, empty, empty))
            if sig not in seen:
                seen.add(sig)
                held.append(tok)
                size += len(tok)
            if size >= BLOCK_TOKENS:
                yield local()
        yield pd.DataFrame(rows, columns=["doc_id", "n", "sig", "tok", "cnt"])
    if held:
        yield local()
    held, seen = [], set()
    release()


def _ceil(share: Fraction, x: int) -> int:
    return -(-share.numerator * x // share.denominator)


def _combinations(hot: np.ndarray) -> np.ndarray:
    """Keys of the pairs of frequent tokens that fall into the same class."""
    out = []
    cls = (hot.view(np.uint64) >> np.uint64(7)) % np.uint64(CLASSES)
    for c in range(CLASSES):
        own = hot[cls == c].view(np.uint64)
        if len(own) > 1:
            i, j = np.triu_indices(len(own), 1)
            out.append(_mix((np.minimum(own[i], own[j]) * ODD) ^ (np.maximum(own[i], own[j]) + ODD)).view(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _emit(n: int, t: Fraction, frequent: tuple, batches):
    """(key, sig, n, p, single): the keys of each set of n tokens, p of them rare ones of its own (single)."""
    f_tok, f_cnt = frequent
    k = CLASSES + 1
    # sets so small that k common tokens aren't sure, and their partners, give frequent tokens as keys too
    small = int(max(s for s in range(4 * k) if _ceil(2 * t / (1 + t), s) < k) / t)
    done: set[int] = set()
    cols: list[list[np.ndarray]] = [[] for _ in range(5)]
    held = 0
    for batch in batches:
        for text in batch["text"]:
            tok = tokens(text, n)
            size = len(tok)
            if not size or (sig := _signature(tok)) in done:
                continue
            if len(done) < 1 << 20:
                done.add(sig)
            often = np.zeros(size, np.int64)
            if len(f_tok):
                place = np.minimum(np.searchsorted(f_tok, tok), len(f_tok) - 1)
                often = np.where(f_tok[place] == tok, f_cnt[place], 0)
            rare = tok[often == 0]
            lack = size - _ceil(t, size)
            keys = single = rare[: lack + 1]
            if len(rare) <= lack:
                in_order = tok[np.lexsort((tok, often))]
                extra = in_order[len(rare) : lack + 1] if size <= small else in_order[:0]
                keys = np.concatenate((single, extra, _combinations(in_order[len(rare) : lack + k])))
            m = len(keys)
            for col, x in zip(cols, (keys, np.full(m, sig), np.full(m, size, np.int32), np.full(m, len(single), np.int32), np.arange(m) < len(single)), strict=True):
                col.append(x)
            held += m
            if held > BATCH_KEYS:
                yield _frame(cols)
                cols, held = [[] for _ in range(5)], 0
    if held:
        yield _frame(cols)
    cols = []
    release()


def _frame(cols: list) -> pd.DataFrame:
    return pd.DataFrame({name: np.concatenate(c) for name, c in zip(("key", "sig", "n", "p", "single"), cols, strict=True)})


def _held(n: int, batches):
    """(a, b, salt, tok): the sets of those texts whose set has the wanted signature, in small batches."""
    names = ["a", "b", "salt", "tok"]
    for batch in batches:
        rows, size = [], 0
        for a, b, salt, want, text in zip(batch["a"], batch["b"], batch["salt"], batch["want"], batch["text"], strict=True):
            tok = tokens(text, n)
            if _signature(tok) == want:
                rows.append((a, b, salt, tok))
                size += len(tok)
            if size >= BATCH_TOKENS:
                yield pd.DataFrame(rows, columns=names)
                rows, size = [], 0
        yield pd.DataFrame(rows, columns=names)
    release()


def _verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, n: int, t: Fraction) -> DataFrame:
    """Those of ``pairs`` (a, b: signatures) whose sets have a Jaccard similarity of at least t. b's set goes to a's; an a with
    many partners meets them in several tasks."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / TASK_PARTNERS).cast("int").alias("salts"))
    of_b = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.col("b").alias("want"))
    of_a = many.select("a", F.lit(0).cast("long").alias("b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("want"))
    of_a, of_b = (x.join(reps.select(F.col("sig").alias("want"), F.col("doc_id").alias("rep")), "want") for x in (of_a, of_b))
    if pairs.count() <= BROADCAST_PAIRS:
        of_a, of_b = F.broadcast(of_a), F.broadcast(of_b)

    def sets(of: DataFrame) -> DataFrame:
        found = docs.join(of, F.col("doc_id") == F.col("rep")).select("a", "b", "salt", "want", "text")
        return found.mapInPandas(partial(_held, n), "a long, b long, salt int, tok array<long>")

    there = sets(of_a).select("a", "salt", F.col("tok").alias("ta")).dropDuplicates(["a", "salt"])
    both = sets(of_b).withColumnRenamed("tok", "tb").join(there, ["a", "salt"])
    both = both.select("a", "b", (F.size("ta") + F.size("tb")).alias("sum"), F.size(F.array_intersect("ta", "tb")).alias("common"))
    return both.where(F.col("common") * F.lit(t.denominator) >= F.lit(t.numerator) * (F.col("sum") - F.col("common"))).select("a", "b").distinct()


def _met(keyed: DataFrame) -> DataFrame:
    """The keys that several sets have. Rare keys are counted where they are sorted; combinations, which may be as frequent as
    the largest group of near copies, are summed in every task first."""
    rare = keyed.where("single").withColumn("sets", F.count("*").over(Window.partitionBy("key"))).where("sets > 1").drop("sets")
    hot = keyed.where("not single").dropDuplicates(["key", "sig"])
    shared = hot.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1").select("key")
    return rare.unionByName(hot.join(shared, "key").select(*rare.columns)).dropDuplicates(["key", "sig"])


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Two documents link when 100 * common >= percent * union of their sets of ``words``-word n-grams. component_id is the
    least doc_id reachable. Null, empty and wordless texts have the empty set and are linked with nothing; so are rows with a
    null doc_id, whose component_id is null. Repeated rows share a component; several texts of one doc_id are sets of their own,
    each row being listed with its own. Other columns are left out.
    """
    t = Fraction(percent, 100)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    named = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    sized = cut(named.mapInPandas(partial(_sets, words), "doc_id string, n int, sig long, tok array<long>, cnt array<long>"))
    counted = sized.where("n = -1").select(F.explode(F.arrays_zip("tok", "cnt")).alias("x")).groupBy("x.tok").agg(F.sum("x.cnt").alias("cnt"))
    often = counted.where(F.col("cnt") >= FREQUENT).orderBy(F.desc("cnt"), "tok").limit(FREQUENT_LISTED).toPandas().sort_values("tok")
    frequent = (often["tok"].to_numpy(np.int64), often["cnt"].to_numpy(np.int64))
    docs_sets = sized.where("n >= 0").select(F.col("doc_id").cast("long").alias("doc_id"), "n", "sig")
    reps = docs_sets.where("n > 0 and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))

    listed = rows.where("text is not null and doc_id is not null").select("text")
    met = cut(_met(cut(listed.mapInPandas(partial(_emit, words, t, frequent), "key long, sig long, n int, p int, single boolean"))))
    links = _hub_links(met, lambda pairs: _verified(rows, reps, pairs, words, t), percent)
    left = _still_apart(met, components(links), percent)
    # each set meets the partners it shares most keys with; pairs that are connected by then need no look
    ends = left.select("a", "b", "keys", F.explode(F.array("a", "b")).alias("end"))
    best = Window.partitionBy("end").orderBy(F.desc("keys"), "a", "b")
    near = ends.withColumn("place", F.row_number().over(best)).where(F.col("place") <= PARTNERS).select("a", "b").distinct()
    links = links.union(cut(_verified(rows, reps, cut(near), words, t)))
    part = components(links)
    of = lambda c: part.select(F.col("node").alias(c), F.col("component").alias(f"component_{c}"))
    apart = F.coalesce("component_a", "a") != F.coalesce("component_b", "b")
    rest = left.join(of("a"), "a", "left").join(of("b"), "b", "left").where(apart).select("a", "b")
    links = links.union(cut(_verified(rows, reps, cut(rest.exceptAll(near)), words, t)))
    every = components(links)

    own = reps.join(every.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = own.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of = own.join(least, "component").select("sig", "component_id")
    linked = docs_sets.where("n > 0 and doc_id is not null").join(of, "sig").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    alone = docs_sets.where("n = 0 or doc_id is null").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.union(alone)


def _possible(m: Column, combined: Column, n: tuple, p: tuple, percent: int) -> Column:
    """Whether two sets that share m rare keys, or a combination, can reach the limit. With a rare token in common, what they
    share beside the m lies behind the prefix of one of them; without, each one's rare tokens are all lacking in the other."""
    needed = (n[0] + n[1]) * percent
    behind = F.greatest(n[0] - p[0], n[1] - p[1])
    sizes = F.least(*n) * 100 >= F.greatest(*n) * percent
    return sizes & (((m > 0) & ((m + behind) * (100 + percent) >= needed)) | (combined & (F.least(n[0] - p[0], n[1] - p[1]) * (100 + percent) >= needed)))


def _hub_links(met: DataFrame, verified, percent: int) -> DataFrame:
    """Links of sets with the hubs of their keys."""
    hub = F.min_by(F.struct("sig", "n", "p"), F.struct((F.col("p") / F.col("n")).alias("share"), "sig")).alias("hub")
    star = met.join(met.groupBy("key").agg(hub), "key").where("sig <> hub.sig")
    star = star.groupBy("sig", F.col("hub.sig").alias("hub_sig")).agg(*[F.first(c).alias(c) for c in ("n", "p")], *[F.first(f"hub.{c}").alias(f"hub_{c}") for c in ("n", "p")], F.count_if("single").alias("m"), F.bool_or(~F.col("single")).alias("combined"))
    fits = _possible(F.col("m"), F.col("combined"), (F.col("n"), F.col("hub_n")), (F.col("p"), F.col("hub_p")), percent)
    return cut(verified(cut(star.where(fits).select(F.col("hub_sig").alias("a"), F.col("sig").alias("b")))))


def _still_apart(met: DataFrame, part: DataFrame, percent: int) -> DataFrame:
    """(a, b, keys): pairs of sets of different components that share keys and can reach the limit. Of a key's sets, those of
    its largest component meet only the others."""
    named = met.join(part.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    largest = named.groupBy("key", "component").agg(F.count("*").alias("sets")).groupBy("key").agg(F.max_by("component", F.struct("sets", "component")).alias("largest"), F.count("*").alias("parts"))
    left = cut(named.join(largest.where("parts > 1").drop("parts"), "key"))
    x = left.where("component <> largest").select("key", *[F.col(c).alias(f"{c}_x") for c in ("sig", "n", "p", "component")])
    y = left.select("key", "single", F.col("component").eqNullSafe(F.col("largest")).alias("main"), *[F.col(c).alias(f"{c}_y") for c in ("sig", "n", "p", "component")])
    n, p = (F.col("n_x"), F.col("n_y")), (F.col("p_x"), F.col("p_y"))
    once = F.col("main") | (F.struct("n_x", "sig_x") < F.struct("n_y", "sig_y"))
    alike = F.when(F.col("single"), F.least(*n) * 100 >= F.greatest(*n) * percent).otherwise(_possible(F.lit(0), F.lit(True), n, p, percent))
    pairs = x.join(y, "key").where((F.col("component_x") != F.col("component_y")) & once & alike)
    shared = pairs.groupBy(F.least("sig_x", "sig_y").alias("a"), F.greatest("sig_x", "sig_y").alias("b")).agg(*[F.first(c).alias(c) for c in ("n_x", "n_y", "p_x", "p_y")], F.count("*").alias("keys"), F.count_if("single").alias("m"), F.bool_or(~F.col("single")).alias("combined"))
    return cut(shared.where(_possible(F.col("m"), F.col("combined"), n, p, percent)).select("a", "b", "keys"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of each group of near copies (five-word n-grams, similarity 0.8) the document with the least doc_id
    stays; documents without words or without a doc_id stay; of repeated rows with one doc_id one stays."""
    groups = join(docs, words=5, percent=80)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    names = docs.columns
    unique = docs.where("doc_id is not null").join(kept, F.col("doc_id") == F.col("__kept"), "left_semi").dropDuplicates(["doc_id"])
    return unique.select(*names).unionByName(docs.where("doc_id is null"))
