"""Queries B: sequences and alignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import alignment as op
from taxaloom.plans import adapters as ad

BY, ALPHA = ["partition"], ["partition", "alphabet"]


def b1_ungap(spark, d):
    return ad.alignment(spark, d).select("taxon_id", "alphabet", F.length(op.ungap("row")).alias("ungapped_length"))


def b2_qc_filter(spark, d):
    return op.qc_filter(ad.sequences(spark, d)).select("dataset", "taxon_id", "length", "kept", "reason")


def b3_gap_stats(spark, d):
    return op.gap_stats(ad.alignment(spark, d), ALPHA)


def b4_full_set_gate(spark, d):
    return op.full_set_gate(b3_gap_stats(spark, d)).select("partition", "alphabet", "usable", "reason")


def b5_needs_split(spark, d):
    return op.needs_split(op.gap_stats(ad.alignment(spark, d), ALPHA), BY, both=True, max_gap=0.2, max_expansion=1.2)


def b6_strip_gap_columns(spark, d):
    return op.strip_gap_columns(ad.part_alignment(spark, d), BY).select("partition", "taxon_id", "row")


def b7_sequence_coverage(spark, d):
    return op.sequence_coverage(ad.alignment(spark, d).where("alphabet = 'aa'"), BY)


def b8_column_occupancy(spark, d):
    return op.column_occupancy(ad.alignment(spark, d), ALPHA)


def b9_mutual_coverage(spark, d):
    return op.mutual_coverage(ad.part_alignment(spark, d), BY)


def b10_filter_by_coverage(spark, d):
    return op.filter_by_coverage(ad.alignment(spark, d), BY).select("partition", "alphabet", "taxon_id", "row")


def b11_greedy_partition(spark, d):
    return op.greedy_partition(ad.part_alignment(spark, d), BY, 0.97)


def b12_consensus(spark, d):
    return op.consensus(ad.alignment(spark, d), ALPHA)


def b13_alphabet_lengths(spark, d):
    return op.alphabet_lengths(ad.alignment(spark, d), BY).withColumnsRenamed({"3di": "len_3di", "aa": "len_aa"})


def b14_roster(spark, d):
    return op.roster(ad.alignment(spark, d).where("alphabet = 'aa'"), 10)


def b15_msa_rows(spark, d):
    aln = ad.part_alignment(spark, d)
    order = aln.select("taxon_id", (F.col("ord") * 7919 % 104729).cast("int").alias("leaf_ord"))
    return op.msa_rows(aln, BY, order, 0.2)


def _halves(spark, d):
    s = ad.sequences(spark, d)
    return s.select("taxon_id", "seq"), s.where("dataset <> 'de'").select("taxon_id", F.when(F.length("seq") > 40, F.col("seq")).otherwise(F.lower("seq")).alias("seq"))


def b16_comparability(spark, d):
    return op.comparability(*_halves(spark, d))


def b17_comparable_pairs(spark, d):
    s = ad.sequences(spark, d)
    both = s.select(F.lit("all").alias("dataset"), "taxon_id", "seq").unionByName(s.select("dataset", "taxon_id", "seq")).unionByName(s.select(F.lit("lower").alias("dataset"), "taxon_id", F.lower("seq").alias("seq")))
    return op.comparable_pairs(both)


def b18_alphabet_validity(spark, d):
    return op.alphabet_validity(ad.alignment(spark, d))


def b19_mean_conservation(spark, d):
    return op.mean_conservation(ad.alignment(spark, d), ALPHA)


QUERIES = {k: f for k, f in globals().items() if k[:1] == "b" and k[1:2].isdigit()}

_STATS = """stats AS (SELECT "partition", alphabet, count(*) AS taxa, arg_min(length(row), ord) AS columns, sum(length(row) - length(replace(row, '-', ''))) AS gaps,
  list_sort(list(length(replace(row, '-', ''))))[count(*) // 2 + 1] AS m0 FROM alignment GROUP BY ALL),
gap_stats AS (SELECT "partition", alphabet, taxa, columns, round(gaps / (taxa * columns), 4) AS gap_fraction, CAST(CASE WHEN m0 = 0 THEN 1 ELSE m0 END AS INT) AS median_ungapped_length, round(columns / CASE WHEN m0 = 0 THEN 1 ELSE m0 END, 2) AS expansion FROM stats)"""
_COV = """cov AS (SELECT "partition", taxon_id, length(replace(row, '-', '')) AS non_gaps, round(length(replace(row, '-', '')) / length(row), 4) AS sequence_coverage,
  CASE WHEN max(length(replace(row, '-', ''))) OVER (PARTITION BY "partition") > 0 THEN round(length(replace(row, '-', '')) / max(length(replace(row, '-', ''))) OVER (PARTITION BY "partition"), 4) ELSE 0 END AS domain_coverage FROM {0})"""
_CELLS = """cells AS (SELECT "partition", alphabet, ord, i - 1 AS col, substr(row, i, 1) AS ch FROM (SELECT *, unnest(range(1, length(row) + 1)) AS i FROM alignment)),
sized AS (SELECT "partition", alphabet, count(*) AS taxa FROM alignment GROUP BY ALL),
counted AS (SELECT "partition", alphabet, col, ch, count(*) AS n, min(ord) AS first FROM cells GROUP BY ALL),
consensus AS (SELECT "partition", alphabet, col, ch AS symbol, round(n / taxa, 4) AS conservation FROM (SELECT *, row_number() OVER (PARTITION BY "partition", alphabet, col ORDER BY n DESC, first, ch DESC) AS k FROM counted) JOIN sized USING ("partition", alphabet) WHERE k = 1)"""
_SPLIT = """WITH {0}, {1}, o AS (SELECT *, concat_ws(', ', CASE WHEN gap_fraction >= 0.2 THEN 'gaps' END, CASE WHEN expansion > 1.2 THEN 'expansion' END) AS over FROM gap_stats),
w AS (SELECT "partition", coalesce(max(over) FILTER (alphabet = '3di'), '') AS o3, coalesce(max(over) FILTER (alphabet = 'aa'), '') AS oa FROM o GROUP BY 1)
SELECT "partition", o3 <> '' OR oa <> '' AS split, CASE WHEN o3 <> '' OR oa <> '' THEN concat_ws('; ', CASE WHEN o3 <> '' THEN '3Di: ' || o3 END, CASE WHEN oa <> '' THEN 'AA: ' || oa END) ELSE 'alignment quality acceptable' END AS reason FROM w"""
_STRIP = """keep AS (SELECT {2}, list_sort(list(DISTINCT i)) AS cols FROM (SELECT {2}, row, unnest(range(1, length(row) + 1)) AS i FROM {0}) WHERE substr(row, i, 1) <> '-' GROUP BY ALL),
stripped AS (SELECT {1}, array_to_string(list_transform(cols, lambda c: substr(row, c, 1)), '') AS row FROM {0} JOIN keep USING ({2}))"""
_COMPARE = "CASE WHEN shared < 50 THEN 'too few shared taxa' WHEN shared < least(n_a, n_b) * 0.8 THEN 'too little overlap' WHEN same < shared * 0.99 THEN 'sequences differ' ELSE 'comparable' END"

SQL = {
    "b1_ungap": f"WITH {ad.ALIGNMENT} SELECT taxon_id, alphabet, CAST(length(replace(row, '-', '')) AS INT) AS ungapped_length FROM alignment",
    "b2_qc_filter": f"""WITH {ad.SEQUENCES}, s AS (SELECT dataset, taxon_id, length(seq) AS length FROM sequences), m AS (SELECT list_sort(list(length))[count(*) // 2 + 1] AS median FROM s),
f AS (SELECT median, greatest(50, CAST(floor(median * 0.4) AS INT)) AS floor FROM m)
SELECT dataset, taxon_id, CAST(length AS INT) AS length, length >= floor AS kept, CASE WHEN length < floor THEN 'length ' || length || ' < floor ' || floor || ' (max of min_length=50, 0.4 x median ' || median || ')' END AS reason FROM s, f""",
    "b3_gap_stats": f"WITH {ad.ALIGNMENT}, {_STATS} SELECT * FROM gap_stats",
    "b4_full_set_gate": f"WITH {ad.ALIGNMENT}, {_STATS} SELECT \"partition\", alphabet, NOT (gap_fraction >= 0.5 OR expansion > 1.5) AS usable, concat_ws('; ', CASE WHEN gap_fraction >= 0.5 THEN 'gap fraction >= 50%' END, CASE WHEN expansion > 1.5 THEN 'expansion > 1.5x' END) AS reason FROM gap_stats",
    "b5_needs_split": _SPLIT.format(ad.ALIGNMENT, _STATS),
    "b6_strip_gap_columns": f"WITH {ad.PART_ALIGNMENT}, {_STRIP.format('part_alignment', '\"partition\", taxon_id', '\"partition\"')} SELECT * FROM stripped",
    "b7_sequence_coverage": f"WITH {ad.ALIGNMENT}, aa AS (SELECT * FROM alignment WHERE alphabet = 'aa'), {_COV.format('aa')} SELECT * FROM cov",
    "b8_column_occupancy": f"WITH {ad.ALIGNMENT}, {_CELLS} SELECT \"partition\", alphabet, col, round(avg(CASE WHEN ch <> '-' THEN 1.0 ELSE 0.0 END), 4) AS occupancy FROM cells GROUP BY ALL",
    "b9_mutual_coverage": f"""WITH {ad.PART_ALIGNMENT}, m AS (SELECT *, length(replace(row, '-', '')) AS n, CAST(regexp_replace(regexp_replace(row, '[a-z]', '1', 'g'), '-', '0', 'g') AS BIT) AS bits FROM part_alignment)
SELECT x."partition", x.taxon_id AS a, y.taxon_id AS b, CAST(bit_count(x.bits & y.bits) AS INT) AS mutual, round(bit_count(x.bits & y.bits) / least(x.n, y.n), 4) AS cov_min, round(bit_count(x.bits & y.bits) / greatest(x.n, y.n), 4) AS cov_max FROM m x JOIN m y ON x."partition" = y."partition" AND x.ord < y.ord""",
    "b10_filter_by_coverage": f"WITH {ad.ALIGNMENT}, t AS (SELECT * FROM alignment WHERE alphabet = '3di'), {_COV.format('t')}, passed AS (SELECT a.* FROM alignment a JOIN cov c ON a.\"partition\" = c.\"partition\" AND a.taxon_id = c.taxon_id WHERE sequence_coverage >= 0.7), {_STRIP.format('passed', '\"partition\", alphabet, taxon_id', '\"partition\", alphabet')} SELECT * FROM stripped",
    "b12_consensus": f"WITH {ad.ALIGNMENT}, {_CELLS} SELECT * FROM consensus",
    "b13_alphabet_lengths": f"WITH {ad.ALIGNMENT} SELECT \"partition\", CAST(max(length(row)) FILTER (alphabet = '3di') AS INT) AS len_3di, CAST(max(length(row)) FILTER (alphabet = 'aa') AS INT) AS len_aa FROM alignment GROUP BY 1",
    "b14_roster": f"WITH {ad.ALIGNMENT}, aa AS (SELECT * FROM alignment WHERE alphabet = 'aa'), {_COV.format('aa')}, r AS (SELECT '(all)' AS \"partition\", count(*) AS taxa, max(non_gaps) AS longest, round(avg(sequence_coverage), 4) AS mean_coverage FROM cov UNION ALL SELECT \"partition\", count(*), max(non_gaps), round(avg(sequence_coverage), 4) FROM cov GROUP BY 1) SELECT \"partition\", taxa, CAST(longest AS INT) AS longest, mean_coverage, taxa >= 10 AS major FROM r",
    "b15_msa_rows": f"WITH {ad.PART_ALIGNMENT}, {_COV.format('part_alignment')}, o AS (SELECT taxon_id, CAST(ord * 7919 % 104729 AS INT) AS leaf_ord FROM part_alignment) SELECT \"partition\", taxon_id, leaf_ord, CAST(row_number() OVER (PARTITION BY \"partition\" ORDER BY leaf_ord, taxon_id) AS INT) AS place FROM cov JOIN o USING (taxon_id) WHERE sequence_coverage >= 0.2",
    "b16_comparability": f"""WITH {ad.SEQUENCES}, b AS (SELECT taxon_id, CASE WHEN length(seq) > 40 THEN seq ELSE lower(seq) END AS seq FROM sequences WHERE dataset <> 'de'),
s AS (SELECT count(a.taxon_id) AS n_a, count(b.taxon_id) AS n_b, count(*) FILTER (a.taxon_id = b.taxon_id) AS shared, count(*) FILTER (a.seq = b.seq) AS same FROM sequences a FULL JOIN b USING (taxon_id)) SELECT *, {_COMPARE} AS reason, {_COMPARE} = 'comparable' AS comparable FROM s""",
    "b17_comparable_pairs": f"""WITH {ad.SEQUENCES}, e AS (SELECT 'all' AS dataset, taxon_id, seq FROM sequences UNION ALL SELECT dataset, taxon_id, seq FROM sequences UNION ALL SELECT 'lower', taxon_id, lower(seq) FROM sequences), z AS (SELECT dataset, count(*) AS n FROM e GROUP BY 1),
s AS (SELECT a.dataset AS dataset_a, b.dataset AS dataset_b, count(*) AS shared, count(*) FILTER (a.seq = b.seq) AS same FROM e a JOIN e b ON a.taxon_id = b.taxon_id AND a.dataset < b.dataset GROUP BY ALL), t AS (SELECT s.*, x.n AS n_a, y.n AS n_b FROM s JOIN z x ON x.dataset = dataset_a JOIN z y ON y.dataset = dataset_b) SELECT *, {_COMPARE} AS reason, {_COMPARE} = 'comparable' AS comparable FROM t""",
    "b18_alphabet_validity": f"WITH {ad.ALIGNMENT} SELECT * FROM (SELECT \"partition\", alphabet, taxon_id, CAST(length(regexp_replace(row, '[acdefghiklmnpqrstvwy-]', '', 'g')) AS INT) AS invalid FROM alignment) WHERE invalid > 0",
    "b19_mean_conservation": f"WITH {ad.ALIGNMENT}, {_CELLS} SELECT \"partition\", alphabet, round(100 * avg(conservation), 1) AS mean_conservation FROM consensus GROUP BY ALL",
}
