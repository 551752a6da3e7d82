"""Document fingerprints by consistent weighted sampling, with DataFrame and SQL functions only.

A document is a set of words weighted by their counts. Each of SAMPLES samples picks one word: with r and c drawn from
Gamma(2, 1) and b from U(0, 1), all three functions of the word and the sample alone, and q = floor(ln w / r + b), the word with
the least ln c - r (q - b + 1) wins, and (word, q) is the sample. Two documents agree in a sample with a probability equal to
their generalised Jaccard similarity, sum of min / sum of max of the weights; with 32 samples likeness has a standard deviation
of at most 0.09 (the README says why not more).

All samples are taken in the row of a word: each is a minimum of longs, the upper half of which is the word's place in the order
of the sample and the lower half a hash of (word, q). So words are not multiplied by samples, and documents, which lie in blocks
of the order in which they follow each other, are shuffled once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from taxaloom.session import cut

SAMPLES = 32
#: Characters of a block of documents, about; blocks at most (their bounds, 24 bytes each, are sent to every task).
BLOCK_CHARS, MAX_BLOCKS = 4 << 20, 1 << 14
NOT_WORD, SPACE = r"[^\p{L}\p{N}]+", r"[\x20\x09-\x0D]+"


def _unit(h: Column, at: int, bits: int) -> Column:
    """A number between 0 and 1 from some bits of a hash."""
    return (F.shiftrightunsigned(h, at).bitwiseAND(F.lit(2**bits - 1).cast("long")) + 0.5) / float(2**bits)


def _gamma(h: Column, at: int, bits: int) -> Column:
    return -F.ln(_unit(h, at, bits) * _unit(h, at + bits, bits))


def _sample(t: Column, lw: Column, k: int) -> Column:
    """The place of a word in the order of sample k, with the hash of (word, q) in the lower half. The order's key, between about
    -2500 and 4, is scaled to whole numbers of 31 bits."""
    h = F.xxhash64(t, F.lit(k))
    r, b, lc = _gamma(h, 0, 12), _unit(h, 24, 14), F.ln(_gamma(h, 38, 13))
    q = F.floor(lw / r + b)
    place = ((lc - r * (q - b + 1)) * float(1 << 19)).cast("long")
    return F.shiftleft(place, 32).bitwiseOR(F.xxhash64(h, q).bitwiseAND(F.lit(0xFFFFFFFF)))


def weighted_words(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """key, t, lw: the hash of each distinct word (letters and digits, lower case; in texts without such, whatever white space
    separates) and the logarithm of its count."""
    words = F.when(F.col(text).rlike(r"[\p{L}\p{N}]"), F.split(F.lower(text), NOT_WORD)).otherwise(F.split(F.lower(text), SPACE))
    each = texts.select(*key, F.explode(words).alias("__word")).where("__word <> ''")
    return each.groupBy(*key, F.xxhash64("__word").alias("t")).agg(F.ln(F.count("*").cast("double")).alias("lw"))


def fingerprints(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """key and fp, an array of SAMPLES hashes, of each row of ``texts``; texts without a word give no row. Rows need a key of
    their own. Where rows lie by a part of the key, nothing is shuffled."""
    words = weighted_words(texts, key, text)
    least = words.groupBy(*key).agg(*[F.min(_sample(F.col("t"), F.col("lw"), k)).alias(f"s{k}") for k in range(SAMPLES)])
    return least.select(*key, F.transform(F.array(*[F.col(f"s{k}") for k in range(SAMPLES)]), lambda s: s.bitwiseAND(F.lit(0xFFFFFFFF))).alias("fp"))


def likeness(a: str, b: str) -> Column:
    """Share of samples in which two fingerprints agree; two without words are alike, one without is like no other."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / float(SAMPLES)
    return F.when(F.col(a).isNull() & F.col(b).isNull(), 1.0).when(F.col(a).isNull() | F.col(b).isNull(), 0.0).otherwise(same)


def _place(key: Column, bounds: Column, n: int) -> Column:
    """How many of n sorted bounds lie below or at the key, by bisection."""
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(max(1, n.bit_length())))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= n) & (F.get(bounds, at + s - 1) <= key), at + s).otherwise(at))


def in_blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, text, h, block, ghost): documents in blocks that are ranges of descending doc_id (null last, then by hash of the
    text), and, as a ghost at the end of each block, the first document of the next one, of the last block the first of all."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).cast("long").alias("d"), F.col("h").alias("h"))
    narrow = rows.select(key.alias("key"), F.char_length("text").alias("n"))
    chars = narrow.agg(F.sum("n")).first()[0] or 0
    blocks = min(MAX_BLOCKS, max(1, math.ceil(chars / BLOCK_CHARS)))
    ranged = narrow.select("key").repartitionByRange(blocks, "key")
    firsts = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("first")).select("first.*").orderBy("none", "d", "h").collect()
    if not firsts:
        return rows.select("*", F.lit(0).alias("block"), F.lit(False).alias("ghost"))
    listed = F.array(*[F.struct(F.lit(r["none"]).alias("none"), F.lit(r["d"]).cast("long").alias("d"), F.lit(r["h"]).cast("long").alias("h")) for r in firsts])
    block = F.greatest(F.lit(0), _place(F.col("key"), F.col("bounds"), len(firsts)) - 1)
    # bounds as a one-row table, so that they are made once and not in every row
    bounds = docs.sparkSession.range(1).select(listed.alias("bounds"))
    placed = rows.withColumn("key", key).crossJoin(F.broadcast(bounds)).withColumn("block", block)
    # the first document of a block; of several equal rows one
    ghosts = placed.where(F.array_contains("bounds", F.col("key"))).groupBy("block").agg(F.max(F.struct("doc_id", "text", "h")).alias("g")).select("g.*", "block")
    ghosts = ghosts.withColumn("block", F.pmod(F.col("block") - 1, F.lit(len(firsts))))
    names = ["doc_id", "text", "h", "block"]
    # as many tasks as blocks, so that the words of a task stay few
    return placed.select(*names, F.lit(False).alias("ghost")).unionAll(ghosts.select(*names, F.lit(True))).repartition(len(firsts), "block")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text: the last half (rounded down) of the code points replaced by the first as many of the next document in
    descending doc_id. Null texts are empty; null doc_ids come last, equal doc_ids go by a hash of the text. Repeated rows are
    documents of their own, next to each other; a table of one document is its own next. Other columns are left out.
    """
    order = Window.partitionBy("block").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "h")
    n = F.char_length("text")
    ordered = in_blocks(docs).withColumn("place", F.row_number().over(order)).withColumn("next", F.lead("text").over(order))
    edited = F.when(~F.col("ghost"), F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 2) as int))"), F.expr("left(next, cast(floor(char_length(text) / 2) as int))")))
    both = ordered.select("block", "place", "ghost", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))
    two = both.select("block", "place", F.explode(sides).alias("x")).select("block", "place", "x.side", "x.text").where("text is not null")
    side = lambda i: F.max(F.when(F.col("side") == i, F.col("fp"))).alias(("fp", "efp")[i])
    known = fingerprints(two, ["block", "place", "side"]).groupBy("block", "place").agg(side(0), side(1))
    rest = both.select("block", "place", "ghost", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    found = cut(known.unionByName(rest, allowMissingColumns=True))
    merged = found.groupBy("block", "place").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("ghost", "doc_id", "n_chars", "edited_sha256", "fp", "efp")])
    out = merged.withColumn("nfp", F.lead("fp").over(Window.partitionBy("block").orderBy("place"))).where("not ghost")
    text = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), ""), F.lit(""))
    return out.select("doc_id", "n_chars", "edited_sha256", text("fp").alias("fingerprint"), text("efp").alias("edited_fingerprint"), likeness("fp", "efp").alias("near_edited"), likeness("fp", "nfp").alias("near_next"))
