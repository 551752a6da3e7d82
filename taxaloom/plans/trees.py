"""Queries D: trees. A tree per nation; its customers are the tips, in clades by market segment and balance band (tree a) or
by band, then segment (tree b)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from taxaloom.operators import trees as op
from taxaloom.plans import adapters as ad
from taxaloom.session import cut, table


def _leaves(spark, d):
    c = table(spark, d, "customer")
    return c.select(F.col("c_nationkey").alias("tree_id"), F.concat(F.lit("c"), F.col("c_custkey")).alias("name"), (0.1 + (F.col("c_custkey") % 10) / 10.0).alias("length"), F.col("c_mktsegment").alias("seg"), F.floor(F.col("c_acctbal") / 2000).cast("string").alias("band"), F.lower(F.col("c_mktsegment")).alias("value"))


def _a(spark, d):
    return op.from_paths(_leaves(spark, d), ["seg", "band"])


def _b(spark, d):
    return op.from_paths(_leaves(spark, d), ["band", "seg"])


def _values(spark, d):
    return _leaves(spark, d).select("tree_id", "name", "value")


def d1_parse_newick(spark, d):
    n = op.parse_newick(op.write_newick(_a(spark, d)))
    return n.select("tree_id", "depth", "lo", "hi", "is_leaf", "name", F.round("length", 6).alias("length"))


def d2_support_values(spark, d):
    li = table(spark, d, "lineitem")
    label = F.when(F.col("l_linenumber") % 3 == 0, F.concat_ws("/", F.col("l_quantity").cast("int"), F.col("l_linenumber") * 10)).when(F.col("l_linenumber") % 3 == 1, F.col("l_discount").cast("string")).otherwise(F.col("l_returnflag"))
    return op.support_values(li.select("l_orderkey", label.alias("label"))).groupBy("label", "alrt", "ufboot", "support", "clade_name").agg(F.count("*").alias("n"))


def _supported(nodes):
    s = F.when(F.col("is_leaf"), None).otherwise((F.col("lo") * 37 % 101).cast("double"))
    return nodes.withColumn("support", F.when(s > 20, s)).withColumn("ufboot", F.lit(None).cast("double")).withColumn("alrt", F.lit(None).cast("double"))


def d3_support_kind(spark, d):
    return op.support_kind(_supported(_a(spark, d))).groupBy("tree_id", "kind", "absent", "band").agg(F.count("*").alias("n"))


def d4_tip_count(spark, d):
    return op.tip_count(_a(spark, d))


def d5_subtree_stats(spark, d):
    return op.subtree_stats(_a(spark, d))


def d6_node_depths(spark, d):
    return op.node_depths(_a(spark, d)).select("tree_id", "node_id", "depth", F.round("dist", 6).alias("dist"))


def d7_lca(spark, d):
    sets = _leaves(spark, d).select("tree_id", F.concat_ws("/", "seg", "band").alias("set_id"), "name")
    return op.lca(_b(spark, d), sets).select("tree_id", "set_id", "node_id")


def d8_patristic(spark, d):
    return op.patristic(_a(spark, d)).select("tree_id", "a", "b", ad.to_six("d").alias("d"))


def d9_cophenetic_r(spark, d):
    return op.cophenetic_r(_a(spark, d), _b(spark, d)).select("tree_id", F.round("r", 6).alias("r"))


def d10_robinson_foulds(spark, d):
    return op.robinson_foulds(_a(spark, d), _b(spark, d))


def d11_crossings(spark, d):
    return op.crossings(_a(spark, d), _b(spark, d))


def d11_rank_shifts(spark, d):
    return op.rank_shifts(_a(spark, d), _b(spark, d))


def d12_untangle(spark, d):
    return op.untangle(_a(spark, d), _b(spark, d))


def d13_order_branches(spark, d):
    n = _a(spark, d)
    out = [op.order_branches(n, how).withColumn("how", F.lit(how)) for how in ("file", "ladder-asc", "ladder-desc", "alpha")]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def d14_prune(spark, d):
    kept = _leaves(spark, d).where("length > 0.35").select("tree_id", "name")
    return op.prune(_a(spark, d), kept).select("tree_id", "lo", "hi", "is_leaf", "name", F.round("length", 6).alias("length"))


def d15_common_prune(spark, d):
    short = op.prune(_b(spark, d), _leaves(spark, d).where("length < 0.75").select("tree_id", "name"))
    a, b = op.common_prune(_a(spark, d), short)
    return op.tip_count(a).join(op.tip_count(b).withColumnRenamed("tips", "tips_b"), "tree_id")


def d16_midpoint_root(spark, d):
    """The farthest tip of each tree lies half of the longest way from its root, and so does one below another child."""
    n = cut(op.midpoint_root(_a(spark, d)))
    far = op.node_depths(n).where("is_leaf").select("tree_id", F.col("lo").alias("tip"), "dist")
    top = n.where("depth = 1").select("tree_id", "node_id", F.explode(F.sequence("lo", "hi")).alias("tip")).join(far, ["tree_id", "tip"]).groupBy("tree_id", "node_id").agg(F.max("dist").alias("reach"))
    arms = top.groupBy("tree_id").agg(F.sort_array(F.collect_list("reach"), asc=False).alias("r"))
    size = n.groupBy("tree_id").agg(F.count_if("is_leaf").alias("tips"), F.count_if(F.col("parent_id").isNull()).alias("roots"))
    return size.join(arms, "tree_id").select("tree_id", "tips", "roots", F.round(F.col("r")[0], 6).alias("arm"), F.round(F.col("r")[1], 6).alias("other_arm"))


def d17_outgroup_root(spark, d):
    first = _leaves(spark, d).groupBy("tree_id").agg(F.min("name").alias("name"))
    n = op.outgroup_root(_a(spark, d), first)
    return n.where("depth = 1 and is_leaf").select("tree_id", "name", F.round("length", 6).alias("length"))


def d18_clade_info(spark, d):
    return op.clade_info(_b(spark, d), _values(spark, d)).select("tree_id", "node_id", "size", "dominant", "homogeneity")


def d19_collapse_by_category(spark, d):
    return op.collapse_by_category(op.clade_info(_b(spark, d), _values(spark, d)), 75.0, 2).select("tree_id", "node_id", "size", "dominant")


def d20_collapse_depth(spark, d):
    return op.collapse_depth(_a(spark, d), 2).select("tree_id", "node_id")


def d21_cut_clades(spark, d):
    n = cut(_a(spark, d))
    return op.cut_clades(cut(op.prune(n, op.tips(n))), 7).select("tree_id", "lo", "hi", "size")


def d22_clade_roster(spark, d):
    return op.clade_roster(op.collapse_depth(_b(spark, d), 1).withColumn("size", F.col("hi") - F.col("lo") + 1), _b(spark, d), _values(spark, d)).select("tree_id", "node_id", "size", "dominant", "count", "percent", "number")


def d23_validate(spark, d):
    return op.validate(_a(spark, d), _leaves(spark, d).where("length > 0.15").select("tree_id", "name"))


def d24_resolve_polytomies(spark, d):
    n = cut(op.resolve_polytomies(_a(spark, d)))
    kids = n.where("parent_id is not null").groupBy("tree_id", "parent_id").agg(F.count("*").alias("kids")).groupBy("tree_id").agg(F.max("kids").alias("kids"))
    size = n.groupBy("tree_id").agg(F.count_if("is_leaf").alias("tips"), F.count("*").alias("nodes"), F.count_if((F.col("length") <= 0) & F.col("parent_id").isNotNull()).alias("no_length"))
    return size.join(kids, "tree_id", "left").select("tree_id", "tips", "nodes", "no_length", "kids")


def d25_merges_to_newick(spark, d):
    """Each nation's customers merged one after the other, each half higher than the last."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("dataset"), F.concat(F.lit("c"), F.col("c_custkey")).alias("name"), (F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1).cast("long").alias("node"), F.count("*").over(Window.partitionBy("c_nationkey")).alias("n"))
    merges = c.where("node > 0").select("dataset", (F.col("n") + F.col("node") - 1).alias("step"), F.when(F.col("node") == 1, 0).otherwise(F.col("n") + F.col("node") - 2).alias("a"), F.col("node").alias("b"), (F.col("node") * 0.5).cast("double").alias("height"), (F.col("node") + 1).alias("size"))
    return op.merges_to_newick(merges, c.select("dataset", "node", "name"))


def d27_tree_provenance(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("run"), F.col("c_mktsegment").alias("cluster"), "c_acctbal")
    own = c.where("run % 3 > 0").groupBy("run", "cluster").agg(F.max("c_acctbal").alias("top")).where("top > 9000")
    every = c.select("run", "cluster").distinct()
    return op.tree_provenance(every.unionByName(every.select("run", F.lit("all").alias("cluster")).distinct()), own)


def d28_congruence(spark, d):
    a, b = _a(spark, d), _b(spark, d)
    out = op.robinson_foulds(a, b).join(op.cophenetic_r(a, b), "tree_id").join(op.crossings(a, b), "tree_id")
    return out.select("tree_id", "shared", "rf", F.round("r", 6).alias("r"), "crossings")


def d29_inherit_support(spark, d):
    return op.inherit_support(_supported(_a(spark, d)))


def d30_scope_to_clade(spark, d):
    n = _a(spark, d)
    return op.scope_to_clade(_values(spark, d), n.where("node_id like 'r/%' and depth = 1 and lo > 1"), n)


QUERIES = {k: f for k, f in globals().items() if k[:1] == "d" and k[1:2].isdigit()}

_L = """leaves AS (SELECT c_nationkey AS tree_id, 'c' || c_custkey AS name, 0.1 + (c_custkey % 10) / 10.0 AS length, c_mktsegment AS seg, CAST(CAST(floor(c_acctbal / 2000) AS BIGINT) AS VARCHAR) AS band, lower(c_mktsegment) AS value FROM customer),
ra AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY seg, band, name) AS rank FROM leaves), rb AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY band, seg, name) AS rank FROM leaves)"""


def _nodes(name: str, r: str, k1: str, k2: str) -> str:
    return f"""{name} AS (SELECT tree_id, 't/' || name AS node_id, 3 AS depth, rank AS lo, rank AS hi, true AS is_leaf, name, length FROM {r}
UNION ALL SELECT tree_id, 'r', 0, min(rank), max(rank), false, NULL, 0.0 FROM {r} GROUP BY tree_id UNION ALL SELECT tree_id, 'r/' || {k1}, 1, min(rank), max(rank), false, NULL, 0.5 FROM {r} GROUP BY tree_id, {k1}
UNION ALL SELECT tree_id, 'r/' || {k1} || '/' || {k2}, 2, min(rank), max(rank), false, NULL, 0.5 FROM {r} GROUP BY tree_id, {k1}, {k2})"""


_A, _B = _nodes("a", "ra", "seg", "band"), _nodes("b", "rb", "band", "seg")
_W = f"WITH {_L}, {_A}, {_B}"
_PAIR = """x.tree_id, least(x.name, y.name) AS a, greatest(x.name, y.name) AS b, x.length + y.length + CASE WHEN x.{0} <> y.{0} THEN 2.0 WHEN x.{1} <> y.{1} THEN 1.0 ELSE 0.0 END AS d FROM leaves x JOIN leaves y ON x.tree_id = y.tree_id AND x.name < y.name"""
_R = f"coph AS (SELECT p.tree_id, corr(p.d, q.d) AS r FROM (SELECT {_PAIR.format('seg', 'band')}) p JOIN (SELECT {_PAIR.format('band', 'seg')}) q ON p.tree_id = q.tree_id AND p.a = q.a AND p.b = q.b GROUP BY 1)"
_SETS = """allnames AS (SELECT tree_id, list_sort(list(name)) AS names FROM leaves GROUP BY 1),
cl AS (SELECT DISTINCT t, tree_id, CASE WHEN list_contains(s, names[1]) THEN array_to_string(list_filter(names, lambda z: NOT list_contains(s, z)), ',') ELSE array_to_string(s, ',') END AS sp FROM (
  SELECT 1 AS t, tree_id, list_sort(list(name)) AS s FROM leaves GROUP BY tree_id, seg UNION ALL SELECT 1, tree_id, list_sort(list(name)) FROM leaves GROUP BY tree_id, seg, band
  UNION ALL SELECT 2, tree_id, list_sort(list(name)) FROM leaves GROUP BY tree_id, band UNION ALL SELECT 2, tree_id, list_sort(list(name)) FROM leaves GROUP BY tree_id, seg, band) JOIN allnames USING (tree_id) WHERE len(s) > 1 AND len(s) < len(names)),
rfs AS (SELECT tree_id, count(*) FILTER (n = 2) AS shared, sum(n) AS total FROM (SELECT tree_id, sp, count(*) AS n FROM cl GROUP BY ALL) GROUP BY 1),
rf AS (SELECT tree_id, shared, CAST(total - 2 * shared AS BIGINT) AS rf, CAST(total AS BIGINT) AS max_rf, round(100 * (total - 2 * shared) / total, 2) AS percent FROM rfs)"""
_CROSS = "crossing AS (SELECT x.tree_id, count(*) FILTER (x.ra < y.ra AND x.rb > y.rb) AS crossings, count(DISTINCT x.name) AS n FROM (SELECT p.tree_id, p.name, p.rank AS ra, q.rank AS rb FROM ra p JOIN rb q ON p.tree_id = q.tree_id AND p.name = q.name) x JOIN (SELECT p.tree_id, p.name, p.rank AS ra, q.rank AS rb FROM ra p JOIN rb q ON p.tree_id = q.tree_id AND p.name = q.name) y ON x.tree_id = y.tree_id GROUP BY 1)"
_INFO = "cnt AS (SELECT b.tree_id, node_id, depth, lo, hi, value, count(*) AS n FROM b JOIN rb ON b.tree_id = rb.tree_id AND rank BETWEEN lo AND hi WHERE NOT is_leaf GROUP BY ALL), info AS (SELECT tree_id, node_id, depth, lo, hi, hi - lo + 1 AS size, value AS dominant, n, round(100 * n / (hi - lo + 1), 2) AS homogeneity FROM cnt QUALIFY row_number() OVER (PARTITION BY tree_id, node_id ORDER BY n DESC, value DESC) = 1)"
_LABEL = "CASE WHEN l_linenumber % 3 = 0 THEN CAST(trunc(l_quantity) AS INT) || '/' || (l_linenumber * 10) WHEN l_linenumber % 3 = 1 THEN CAST(l_discount AS VARCHAR) ELSE l_returnflag END"

SQL = {
    "d27_tree_provenance": """WITH c AS (SELECT c_nationkey AS run, c_mktsegment AS cluster, max(c_acctbal) AS top FROM customer GROUP BY 1, 2), own AS (SELECT run, cluster FROM c WHERE run % 3 > 0 AND top > 9000)
SELECT run, cluster, CASE WHEN (run, cluster) IN (FROM own) THEN 'cluster' ELSE 'master-pruned' END AS kind, CASE WHEN (run, cluster) IN (FROM own) THEN cluster || ' tree' ELSE 'Whole-set tree, pruned' END AS label,
  CASE WHEN (run, cluster) IN (FROM own) THEN NULL WHEN run IN (SELECT run FROM own) THEN 'this cluster has no tree of its own' ELSE 'no per-cluster trees in this run' END AS reason FROM c
UNION ALL SELECT DISTINCT run, 'all', 'master', 'Whole-set tree', NULL FROM c""",
    "d24_resolve_polytomies": "SELECT c_nationkey AS tree_id, count(*) AS tips, CASE count(*) WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 2 * count(*) - 2 END AS nodes, CAST(0 AS BIGINT) AS no_length, CASE WHEN count(*) > 1 THEN least(3, count(*)) END AS kids FROM customer GROUP BY 1",
    "d1_parse_newick": f"{_W} SELECT tree_id, depth, lo, hi, is_leaf, name, round(length, 6) AS length FROM a",
    "d2_support_values": f"WITH l AS (SELECT {_LABEL} AS label, CASE WHEN l_linenumber % 3 = 0 THEN trunc(l_quantity) END AS alrt, CASE WHEN l_linenumber % 3 = 0 THEN l_linenumber * 10.0 END AS ufboot, CASE WHEN l_linenumber % 3 = 0 THEN l_linenumber * 10.0 WHEN l_linenumber % 3 = 1 THEN CASE WHEN l_discount > 0 THEN l_discount * 100 ELSE l_discount END END AS support, CASE WHEN l_linenumber % 3 = 2 THEN l_returnflag END AS clade_name FROM lineitem) SELECT label, alrt, ufboot, support, clade_name, count(*) AS n FROM l GROUP BY ALL",
    "d3_support_kind": f"""{_W}, kids AS (SELECT tree_id, 'r' AS node_id, count(DISTINCT seg) AS n FROM leaves GROUP BY 1 UNION ALL SELECT tree_id, 'r/' || seg, count(DISTINCT band) FROM leaves GROUP BY tree_id, seg UNION ALL SELECT tree_id, 'r/' || seg || '/' || band, count(*) FROM leaves GROUP BY tree_id, seg, band),
s AS (SELECT a.*, kids.n AS kids, CASE WHEN NOT is_leaf AND lo * 37 % 101 > 20 THEN lo * 37 % 101 END AS support FROM a LEFT JOIN kids USING (tree_id, node_id))
SELECT tree_id, CASE WHEN support IS NOT NULL THEN 'single' END AS kind, CASE WHEN support IS NOT NULL THEN NULL WHEN is_leaf THEN 'terminal' WHEN kids > 2 THEN 'polytomy' WHEN length <= 0 THEN 'zero-length' ELSE 'absent' END AS absent, CASE WHEN support >= 95 THEN 'strong' WHEN support >= 70 THEN 'moderate' WHEN support IS NOT NULL THEN 'weak' END AS band, count(*) AS n FROM s GROUP BY ALL""",
    "d4_tip_count": "SELECT c_nationkey AS tree_id, count(*) AS tips FROM customer GROUP BY 1",
    "d5_subtree_stats": f"{_W} SELECT a.tree_id, node_id, CAST(hi - lo + 1 AS INT) AS n_leaves, min(ra.name) AS first_tip FROM a JOIN ra ON a.tree_id = ra.tree_id AND rank BETWEEN lo AND hi GROUP BY ALL",
    "d6_node_depths": f"{_W} SELECT tree_id, node_id, depth, round(CASE WHEN is_leaf THEN 1 + length ELSE depth * 0.5 END, 6) AS dist FROM a",
    "d7_lca": "WITH " + _L + " SELECT tree_id, seg || '/' || band AS set_id, CASE WHEN count(*) = 1 THEN 't/' || min(name) ELSE 'r/' || band || '/' || seg END AS node_id FROM leaves GROUP BY tree_id, seg, band",
    "d8_patristic": f"WITH {_L} SELECT tree_id, a, b, round(d, 6) AS d FROM (SELECT {_PAIR.format('seg', 'band')})",
    "d9_cophenetic_r": f"WITH {_L}, {_R} SELECT tree_id, round(r, 6) AS r FROM coph",
    "d10_robinson_foulds": f"WITH {_L}, {_SETS} SELECT * FROM rf",
    "d11_crossings": f"WITH {_L}, {_CROSS} SELECT tree_id, n, crossings, round(crossings / (n * (n - 1) / 2), 6) AS share FROM crossing",
    "d11_rank_shifts": f"WITH {_L}, s AS (SELECT ra.tree_id, ra.name, abs(ra.rank - rb.rank) AS shift FROM ra JOIN rb USING (tree_id, name)) SELECT tree_id, name, CAST(shift AS INT) AS shift, CAST(row_number() OVER (PARTITION BY tree_id ORDER BY shift DESC, name) AS INT) AS k FROM s QUALIFY k <= 15",
    "d12_untangle": f"WITH {_L}, m AS (SELECT rb.*, ra.rank AS lr, avg(ra.rank) OVER (PARTITION BY rb.tree_id, rb.band) AS m1, avg(ra.rank) OVER (PARTITION BY rb.tree_id, rb.band, rb.seg) AS m2, min(rb.rank) OVER (PARTITION BY rb.tree_id, rb.band) AS w1, min(rb.rank) OVER (PARTITION BY rb.tree_id, rb.band, rb.seg) AS w2 FROM rb JOIN ra USING (tree_id, name)) SELECT tree_id, name, CAST(row_number() OVER (PARTITION BY tree_id ORDER BY m1, w1, m2, w2, lr) AS INT) AS rank FROM m",
    "d13_order_branches": f"""WITH {_L}, m AS (SELECT *, count(*) OVER s AS n1, count(*) OVER t AS n2, min(rank) OVER s AS w1, min(rank) OVER t AS w2, min(name) OVER s AS f1, min(name) OVER t AS f2 FROM ra WINDOW s AS (PARTITION BY tree_id, seg), t AS (PARTITION BY tree_id, seg, band))
SELECT tree_id, name, rank, 'file' AS how FROM m UNION ALL SELECT tree_id, name, row_number() OVER (PARTITION BY tree_id ORDER BY n1, w1, n2, w2, rank), 'ladder-asc' FROM m UNION ALL SELECT tree_id, name, row_number() OVER (PARTITION BY tree_id ORDER BY -n1, w1, -n2, w2, rank), 'ladder-desc' FROM m UNION ALL SELECT tree_id, name, row_number() OVER (PARTITION BY tree_id ORDER BY f1, f2, name), 'alpha' FROM m""",
    "d15_common_prune": f"WITH {_L} SELECT tree_id, count(*) AS tips, count(*) AS tips_b FROM leaves WHERE length < 0.75 GROUP BY 1",
    "d16_midpoint_root": f"WITH {_L} SELECT tree_id, (SELECT count(*) FROM leaves l WHERE l.tree_id = p.tree_id) AS tips, CAST(1 AS BIGINT) AS roots, round(max(d) / 2, 6) AS arm, round(max(d) / 2, 6) AS other_arm FROM (SELECT {_PAIR.format('seg', 'band')}) p GROUP BY tree_id",
    "d14_prune": f"""{_W}, k AS (SELECT tree_id, rank, row_number() OVER (PARTITION BY tree_id ORDER BY rank) AS new FROM ra WHERE length > 0.35),
c AS (SELECT a.tree_id, node_id, depth, is_leaf, a.name, CASE WHEN is_leaf THEN 1 + length ELSE depth * 0.5 END AS dist, min(new)::INT AS lo, max(new)::INT AS hi FROM a JOIN k ON a.tree_id = k.tree_id AND rank BETWEEN a.lo AND a.hi GROUP BY ALL),
o AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY tree_id, lo, hi ORDER BY depth DESC) = 1),
u AS (SELECT o.tree_id, o.node_id, max(p.dist) AS up FROM o JOIN o p ON o.tree_id = p.tree_id AND p.lo <= o.lo AND p.hi >= o.hi AND p.depth < o.depth GROUP BY ALL)
SELECT tree_id, lo, hi, is_leaf, name, round(CASE WHEN up IS NULL THEN 0 ELSE dist - up END, 6) AS length FROM o LEFT JOIN u USING (tree_id, node_id)""",
    "d21_cut_clades": f"""{_W}, i AS (SELECT DISTINCT tree_id, lo, hi FROM a),
up AS (SELECT x.tree_id, x.lo, x.hi, y.lo AS plo, y.hi AS phi FROM i x JOIN i y ON x.tree_id = y.tree_id AND y.lo <= x.lo AND y.hi >= x.hi AND (y.lo, y.hi) <> (x.lo, x.hi) QUALIFY row_number() OVER (PARTITION BY x.tree_id, x.lo, x.hi ORDER BY y.hi - y.lo) = 1),
kids AS (SELECT tree_id, plo, phi, list([lo, hi]) AS kids FROM up GROUP BY ALL),
walk AS (WITH RECURSIVE w(tree_id, parts, turn) AS (SELECT tree_id, [[min(lo), max(hi)]], 1 FROM i GROUP BY tree_id
  UNION ALL SELECT w.tree_id, list_concat(list_filter(w.parts, lambda x: x <> [k.plo, k.phi]), k.kids), turn + 1
  FROM (SELECT *, list_sort(list_transform(list_filter(parts, lambda x: x[2] > x[1]), lambda x: [x[1] - x[2], x[1], x[2]]))[1] AS p FROM w WHERE len(parts) < 7) w JOIN kids k ON k.tree_id = w.tree_id AND k.plo = p[2] AND k.phi = p[3])
  SELECT tree_id, arg_max(parts, turn) AS parts FROM w GROUP BY tree_id)
SELECT tree_id, x[1]::INT AS lo, x[2]::INT AS hi, (x[2] - x[1] + 1)::INT AS size FROM (SELECT tree_id, unnest(parts) AS x FROM walk)""",
    "d23_validate": f"""WITH {_L}, kids AS (SELECT tree_id, count(DISTINCT band) AS k FROM leaves GROUP BY tree_id, seg UNION ALL SELECT tree_id, count(*) FROM leaves GROUP BY tree_id, seg, band),
odd AS (SELECT tree_id, count(*) FILTER (k <> 2) AS odd FROM kids GROUP BY 1), t AS (SELECT tree_id, count(DISTINCT seg) AS root_degree, count(*) FILTER (length <= 0.15) AS extra FROM leaves GROUP BY 1)
SELECT tree_id, 0::BIGINT AS duplicates, 0::BIGINT AS missing, extra, root_degree, odd, CASE WHEN extra > 0 THEN 'tips differ from the alignment' WHEN root_degree <> 3 THEN 'root is not trifurcating' WHEN odd > 0 THEN 'not binary' ELSE 'ok' END AS verdict FROM t JOIN odd USING (tree_id)""",
    "d25_merges_to_newick": """WITH c AS (SELECT c_nationkey AS tree_id, 'c' || c_custkey AS name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS k FROM customer)
SELECT tree_id, repeat('(', count(*) - 1) || min_by(name, k) || coalesce(string_agg(':0.500000,' || name || ':' || printf('%.6f', k * 0.5) || ')', '' ORDER BY k) FILTER (k > 0), '') || ';' AS newick FROM c GROUP BY tree_id""",
    "d17_outgroup_root": f"WITH {_L} SELECT tree_id, name, round(length / 2, 6) AS length FROM leaves QUALIFY row_number() OVER (PARTITION BY tree_id ORDER BY name) = 1",
    "d18_clade_info": f"{_W}, {_INFO} SELECT tree_id, node_id, CAST(size AS INT) AS size, dominant, homogeneity FROM info",
    "d19_collapse_by_category": f"{_W}, {_INFO}, ok AS (SELECT * FROM info WHERE homogeneity >= 75 AND size >= 2) SELECT tree_id, node_id, size, dominant FROM ok o WHERE NOT EXISTS (SELECT 1 FROM ok u WHERE u.tree_id = o.tree_id AND u.lo <= o.lo AND u.hi >= o.hi AND u.depth < o.depth)",
    "d20_collapse_depth": f"{_W} SELECT tree_id, node_id FROM a WHERE depth = 2",
    "d22_clade_roster": f"{_W}, {_INFO} SELECT tree_id, node_id, size, dominant, n AS count, round(100 * n / size, 1) AS percent, row_number() OVER (PARTITION BY tree_id ORDER BY size DESC, lo) AS number FROM info WHERE depth = 1",
    "d28_congruence": f"WITH {_L}, {_SETS}, {_R}, {_CROSS} SELECT tree_id, shared, rf, round(r, 6) AS r, crossings FROM rf JOIN coph USING (tree_id) JOIN crossing USING (tree_id)",
    "d29_inherit_support": f"{_W}, s AS (SELECT tree_id, lo, hi, depth, CAST(lo * 37 % 101 AS DOUBLE) AS support FROM a WHERE NOT is_leaf AND lo * 37 % 101 > 20) SELECT ra.tree_id, ra.name, arg_max(support, depth) AS support FROM ra LEFT JOIN s ON ra.tree_id = s.tree_id AND rank BETWEEN lo AND hi GROUP BY ALL",
    "d30_scope_to_clade": f"WITH {_L} SELECT tree_id, name, value FROM leaves QUALIFY seg <> min(seg) OVER (PARTITION BY tree_id)",
}
