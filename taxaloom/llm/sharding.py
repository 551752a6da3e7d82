"""Sharding by vector bin packing.

Groups of equal texts are vectors (bytes, tokens, rows). Each goes to the shard where the dot product of its vector with the
shard's residual capacity is highest, among the shards with room in bytes; large groups come first.

Groups of at least 1/LARGE_PARTS of a shard's share are few (at most SHARDS * LARGE_PARTS * 3, whatever the input), so they
are placed one after the other. What they leave free is handed out to blocks of the small groups in proportion to the blocks'
totals, and each block places its groups in its part, all blocks at once. A group larger than SPLIT of a shard is dealt out by
row over so many pieces that each can be placed.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from taxaloom.llm.mixing import words
from taxaloom.session import cut

SHARDS = 16
LARGE_PARTS = 200
SPLIT = 0.5
#: Small groups of a block, about; documents of a block of slots, about.
BLOCK_GROUPS, BLOCK_ROWS = 20_000, 20_000
SIZES = ["size", "tokens", "rows"]


def place(items: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The shard of each vector, in the order given; room is changed. Units: shares of the whole capacity by dimension."""
    out = np.zeros(len(items), np.int32)
    for i, v in enumerate(items):
        score = room @ v
        fits = room[:, 0] >= v[0]
        s = int(np.argmax(np.where(fits, score, -np.inf))) if fits.any() else int(np.argmax(room[:, 0]))
        out[i] = s
        room[s] -= v
    return out


def assign(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1), text_crc32, shard and slot (gapless from 0 in each shard) of every document.

    Equal texts share a shard, unless together they exceed SPLIT of one. Null texts form one group, of size 1 each, with the
    check sum of the empty text; empty texts form another. Repeated rows have a slot each, and are dealt out row by row like other
    copies. Whole texts are hashed and counted where they are read, however long. Other columns are left out, so their names
    can't clash. An empty table gives an empty table.
    """
    t = F.col(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"), words(t).alias("tokens"),
        F.coalesce(F.crc32(t.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), F.when(t.isNotNull(), F.xxhash64(t)).otherwise(-1).alias("h"), F.xxhash64(F.col(doc_id), t, F.monotonically_increasing_id()).alias("own"),  # rows that agree in all differ in this
    )
    rows = cut(rows)
    key = ["h", "text_crc32", "size", "piece"]  # of a null text h is -1
    whole = rows.groupBy("h", "text_crc32", "size").agg(F.first("tokens").alias("tokens"), F.count("*").alias("rows"))
    sums = whole.agg(F.sum(F.col("size") * F.col("rows")), F.sum(F.col("tokens") * F.col("rows")), F.sum("rows")).first()
    total = np.maximum(np.array([float(x or 0) for x in sums]), 1.0)
    share = total / shards
    part = F.greatest(F.col("size") * F.col("rows") / float(share[0]), F.col("tokens") * F.col("rows") / float(share[1]), F.col("rows") / float(share[2]))

    # Groups to split: each holds at least SPLIT of a shard in some dimension, so there are at most 3 * shards / SPLIT.
    heavy = whole.where(part > SPLIT).where("rows > 1").select("h", "text_crc32", "size", F.ceil(part / (SPLIT / 2)).cast("int").alias("pieces"))
    text_key = ["h", "text_crc32", "size"]
    pieces = rows.join(F.broadcast(heavy), text_key, "left").withColumn("piece", F.when(F.col("pieces").isNotNull(), F.pmod(F.col("own"), F.col("pieces"))).otherwise(F.lit(0)).cast("int")).drop("pieces")
    groups = cut(pieces.groupBy(*key).agg(F.sum("size").alias("v0"), F.sum("tokens").alias("v1"), F.count("*").alias("v2")))
    vector = [F.col(f"v{i}") / float(total[i]) for i in range(3)]
    weight = F.greatest(*[v * shards for v in vector])

    large = groups.where(weight >= 1 / LARGE_PARTS).select(*key, *[v.alias(f"w{i}") for i, v in enumerate(vector)]).toPandas()
    large = large.assign(m=large[["w0", "w1", "w2"]].max(axis=1)).sort_values(["m", "text_crc32", "size", "piece"], ascending=[False, True, True, True], kind="stable")
    room = np.full((shards, 3), 1.0 / shards)
    large["shard"] = place(large[["w0", "w1", "w2"]].to_numpy(float), room)
    spark = docs.sparkSession
    schema = "h long, text_crc32 long, size long, piece int, shard int"
    fixed = spark.createDataFrame([tuple(map(int, r)) for r in large[[*key, "shard"]].itertuples(index=False)], schema).withColumnRenamed("shard", "fixed")

    small = groups.where(weight < 1 / LARGE_PARTS)
    blocks = max(1, math.ceil(small.count() / BLOCK_GROUPS))
    free = np.maximum(room, 0)
    free = free / np.maximum(free.sum(0), 1e-12)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        v = group[["w0", "w1", "w2"]].to_numpy(float)
        order = np.lexsort((group["piece"], group["size"], group["text_crc32"], -v.max(axis=1)))
        shard = np.zeros(len(v), np.int32)
        shard[order] = place(v[order] / np.maximum(v.sum(0), 1e-12), free.copy())
        return group[key].assign(shard=shard)

    in_blocks = small.select(*key, *[v.alias(f"w{i}") for i, v in enumerate(vector)], F.pmod(F.xxhash64("h", "text_crc32", "size", "piece"), F.lit(blocks)).alias("block"))
    packed = in_blocks.groupBy("block").applyInPandas(pack, schema)

    marked = pieces.join(F.broadcast(fixed), key, "left")
    put = marked.where("fixed is not null").withColumnRenamed("fixed", "shard")
    other = marked.where("fixed is null").drop("fixed").join(packed, key)
    placed = cut(put.unionByName(other).select("doc_id", "size", "text_crc32", "shard", "own"))

    parts = max(1, math.ceil(total[2] / BLOCK_ROWS / shards))
    spread = placed.withColumn("part", F.pmod(F.shiftright("own", 16), F.lit(parts)))
    before = spread.groupBy("shard", "part").agg(F.count("*").alias("n")).withColumn("base", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).drop("n")
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("own", F.col("doc_id").asc_nulls_last(), "text_crc32")) - 1
    return spread.withColumn("inside", inside).join(before, ["shard", "part"]).select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("inside")).cast("long").alias("slot"))


def digest(docs: DataFrame) -> DataFrame:
    """The shards under the law of near equal bytes."""
    return assign(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
