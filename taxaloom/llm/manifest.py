"""Merkle manifest of a dataset: a tree of digests for each source, one over the sources, and a proof for each row.

A node's link to its parent holds the segment of siblings to its left and right. Links are doubled by joining the table with
itself: a pointer over d levels and one over the next d become one over 2d, their segments one after the other, until all lead
to the root. The leaves of a run of FAN_OUT share their parent's pointer: a run's digests are kept once, in its row, and each
leaf's own segment is read from them, so that leaves never repeat the path.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.llm import oracle
from taxaloom.operators.numbering import numbered
from taxaloom.session import cut

FAN_OUT = 16
#: Columns of a leaf, in the order in which they are hashed.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of the upper end of a jump up to which they are broadcast; a row has at most some 15 digests for each level it spans.
BROADCAST_NODES = 2_000
#: Of the rows whose doc_id has a check sum divisible by this the text is tampered with.
TAMPER_EVERY = 5
LINK = "node struct<tree: long, level: int, idx: long>, to struct<tree: long, level: int, idx: long>, path array<struct<l: string, r: string>>, subroot string"


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    """The digest of a row's columns, each with its length in bytes, some replaced by others."""
    return F.sha2(F.concat(*[_field(replaced.get(c, F.col(c))) for c in COLUMNS]), 256)


def tampered_text() -> Column:
    """The text as a forger leaves it: lower-cased (A-Z) in the rows chosen by doc_id. A null text, or a null doc_id, stays."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0, F.lit(False))
    return F.when(hit, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))


def _node(tree, level, idx) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), idx.cast("long").alias("idx"))


def _climb(nodes: DataFrame, longest: int) -> tuple[list[DataFrame], DataFrame, int]:
    """Links of all levels above ``nodes`` (tree, level, idx, n, node, h), the tops (tree, node, h), and the number of levels."""
    links, tops, depth = [], [], 0
    while True:
        tops.append(nodes.where("n = 1").select("tree", "node", "h"))
        if longest <= 1:
            return links, reduce(DataFrame.unionByName, tops), depth
        run = F.floor(F.col("idx") / FAN_OUT).alias("idx")
        members = F.array_sort(F.collect_list(F.struct("idx", "node", "h"))).alias("members")
        runs = cut(nodes.where("n > 1").groupBy("tree", "level", "n", run).agg(members))
        parent = _node(F.col("tree"), F.col("level") + 1, F.col("idx"))
        digests = F.col("members.h")
        each = runs.select(parent.alias("to"), digests.alias("hs"), F.posexplode("members").alias("i", "m"))
        left, right = F.array_join(F.slice("hs", F.lit(1), F.col("i")), ""), F.array_join(F.slice("hs", F.col("i") + 2, F.lit(FAN_OUT)), "")
        links.append(each.select(F.col("m.node").alias("node"), "to", F.array(F.struct(left.alias("l"), right.alias("r"))).alias("path"), F.col("m.h").alias("h")))
        nodes = runs.select("tree", (F.col("level") + 1).alias("level"), F.col("idx").cast("long").alias("idx"), F.ceil(F.col("n") / FAN_OUT).alias("n"), parent.alias("node"), F.sha2(F.array_join(digests, ""), 256).alias("h"))
        longest, depth = math.ceil(longest / FAN_OUT), depth + 1


def _to_root(links: DataFrame, depth: int) -> DataFrame:
    """links with every pointer at the root: ceil(log2(depth)) rounds, each joining the table with itself."""
    up = cut(links)
    for _ in range(math.ceil(math.log2(depth)) if depth > 1 else 0):
        upper = up.select(F.col("node").alias("to"), F.col("to").alias("to2"), F.col("path").alias("path2"), F.col("subroot").alias("subroot2"))
        upper = upper.join(up.select("to").distinct(), "to", "left_semi")  # a jump ends at few nodes
        if upper.count() <= BROADCAST_NODES:
            upper = F.broadcast(upper)
        both = up.join(upper, "to", "left")
        up = cut(both.select("node", F.coalesce("to2", "to").alias("to"), F.when(F.col("path2").isNull(), F.col("path")).otherwise(F.concat("path", "path2")).alias("path"), F.coalesce("subroot", "subroot2").alias("subroot")))
    return up


def manifest(docs: DataFrame) -> tuple[DataFrame, str | None]:
    """A row for each run of leaves, and the root's digest (None of an empty table).

    A row has members (array of doc_id, leaf, tampered: the digest after tampering), lone (a source's only leaf, which has no
    run), path (segments l, r from the run's parent link up to the root) and subroot (its source's digest). Leaves ascend by
    doc_id in their source, nulls first; rows of equal doc_id ascend by digest, and rows equal in all columns are leaves of
    their own, alike and side by side. A null source is a source, before all others. Columns of other names are left out;
    texts are hashed whole, where they are read, and never shuffled.
    """
    leaves = cut(docs.select("source", "doc_id", leaf_digest().alias("leaf"), leaf_digest(text=tampered_text()).alias("tampered"), F.monotonically_increasing_id().alias("own")))
    placed = numbered(leaves, ["source"], ["doc_id", "leaf", "own"], "idx", "n", "tree")
    run = F.floor(F.col("idx") / FAN_OUT)
    members = F.transform(F.array_sort(F.collect_list(F.struct("idx", "doc_id", "leaf", "tampered"))), lambda m: F.struct(m["doc_id"].alias("doc_id"), m["leaf"].alias("leaf"), m["tampered"].alias("tampered")))
    runs = placed.groupBy("tree", "n", run.cast("long").alias("idx")).agg(members.alias("members"))
    lone = F.col("n") == 1
    digest = F.when(lone, F.col("members")[0]["leaf"]).otherwise(F.sha2(F.array_join("members.leaf", ""), 256))
    runs = cut(runs.select("tree", F.lit(1).alias("level"), "idx", F.ceil(F.col("n") / FAN_OUT).alias("n"), _node(F.col("tree"), F.lit(1), F.col("idx")).alias("node"), digest.alias("h"), lone.alias("lone"), "members"))
    links, tops, depth = _climb(runs.drop("lone", "members"), runs.agg(F.max("n")).first()[0] or 0)
    ranked = numbered(tops, [], ["tree"], "idx", "n").select(F.lit(-1).cast("long").alias("tree"), F.lit(0).alias("level"), "idx", "n", "node", "h")
    sources = ranked.count()
    above, root, more = _climb(ranked, sources)
    top = root.first() if sources else None
    all_links = [x.withColumn("subroot", F.lit(None).cast("string")) for x in links] + [x.withColumn("subroot", F.col("h") if i == 0 else F.lit(None).cast("string")) for i, x in enumerate(above)]
    spark = docs.sparkSession
    joined = reduce(DataFrame.unionByName, [x.drop("h") for x in all_links]) if all_links else spark.createDataFrame([], LINK)
    paths = _to_root(joined, depth + more).select("node", "path", "subroot")
    whole = runs.select("node", "lone", "members").join(paths, "node", "left")
    none = F.array().cast("array<struct<l: string, r: string>>")
    return whole.select("lone", "members", F.coalesce("path", none).alias("path"), F.coalesce("subroot", F.lit(top["h"] if top else None).cast("string")).alias("subroot")), top["h"] if top else None


def folded(leaf: Column, path: Column) -> Column:
    """The digest that a leaf and its path's siblings give at the top."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row; an empty table gives no row."""
    runs, root = manifest(docs)
    above = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    digests = F.col("members.leaf")

    def proof(m: Column, i: Column) -> Column:
        left, right = F.array_join(F.slice(digests, F.lit(1), i), ""), F.array_join(F.slice(digests, i + 2, F.lit(FAN_OUT)), "")
        # a leaf that is its source's only one has no run, and goes up as it is
        first = F.when(F.col("lone"), m["tampered"]).otherwise(F.sha2(F.concat(left, m["tampered"], right), 256))
        siblings = F.concat(F.when(F.col("lone"), F.lit("")).otherwise(F.concat(left, right)), F.col("above"))
        return F.struct(m["doc_id"].alias("doc_id"), m["leaf"].alias("leaf"), F.sha2(siblings, 256).alias("proof_sha256"), folded(first, F.col("path")).alias("folded_root"))

    rows = runs.withColumn("above", above).select("subroot", F.explode(F.transform("members", proof)).alias("p"))
    top = F.lit(root).cast("string")
    return rows.select("p.doc_id", "p.leaf", "subroot", top.alias("root"), "p.proof_sha256", "p.folded_root", (F.col("p.folded_root") == top).alias("verified"))


def _sql_leaf(text: str) -> str:
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    return "sha256(" + " || ".join(field(text if c == "text" else c) for c in COLUMNS) + ")"


_SQL_TAMPERED = f"(CASE WHEN {oracle.crc32("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % {TAMPER_EVERY} = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END)"
#: The manifest level by level, and each proof folded level by level.
SQL = f"""WITH RECURSIVE {oracle.CRC_TABLE},
leaves AS (SELECT doc_id, source, {_sql_leaf("text")} AS leaf, {_sql_leaf(_SQL_TAMPERED)} AS tampered FROM documents, crc_table),
base AS (SELECT doc_id, leaf, tampered, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves),
up(tree, level, idx, n, h) AS (SELECT tree, 0, idx, n, leaf FROM base
  UNION ALL SELECT tree, level + 1, idx // {FAN_OUT}, (n + {FAN_OUT - 1}) // {FAN_OUT}, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY tree, level, n, idx // {FAN_OUT}),
subroots AS (SELECT tree, h FROM up WHERE n = 1),
top(level, idx, n, h) AS (SELECT 0, row_number() OVER (ORDER BY tree) - 1, count(*) OVER (), h FROM subroots
  UNION ALL SELECT level + 1, idx // {FAN_OUT}, (n + {FAN_OUT - 1}) // {FAN_OUT}, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, n, idx // {FAN_OUT}),
near AS (SELECT b.tree, b.idx, u.level AS lev, u.idx AS i, b.idx >> (4 * u.level) AS own, u.h FROM base b JOIN up u ON u.tree = b.tree AND u.n > 1 AND u.idx // {FAN_OUT} = b.idx >> (4 * (u.level + 1))
  UNION ALL SELECT b.tree, b.idx, 1000 + t.level, t.idx, b.tree >> (4 * t.level), t.h FROM base b JOIN top t ON t.n > 1 AND t.idx // {FAN_OUT} = b.tree >> (4 * (t.level + 1))),
segments AS (SELECT tree, idx, row_number() OVER (PARTITION BY tree, idx ORDER BY lev) AS k, coalesce(string_agg(h, '' ORDER BY i) FILTER (i < own), '') AS l, coalesce(string_agg(h, '' ORDER BY i) FILTER (i > own), '') AS r FROM near GROUP BY tree, idx, lev),
fold(tree, idx, k, h) AS (SELECT tree, idx, 0, tampered FROM base
  UNION ALL SELECT f.tree, f.idx, s.k, sha256(s.l || f.h || s.r) FROM fold f JOIN segments s ON s.tree = f.tree AND s.idx = f.idx AND s.k = f.k + 1),
proofs AS (SELECT tree, idx, sha256(coalesce(string_agg(l || r, '' ORDER BY k), '')) AS proof_sha256 FROM base LEFT JOIN segments USING (tree, idx) GROUP BY tree, idx),
ends AS (SELECT tree, idx, arg_max(h, k) AS folded_root FROM fold GROUP BY tree, idx)
SELECT doc_id, leaf, subroots.h AS subroot, top.h AS root, proof_sha256, folded_root, folded_root = top.h AS verified
FROM base JOIN subroots USING (tree) JOIN proofs USING (tree, idx) JOIN ends USING (tree, idx) JOIN top ON top.n = 1"""
