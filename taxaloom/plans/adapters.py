"""The given tables as inputs of the operators, in Spark and, as common table expressions, in DuckDB. Whole tables, whole
texts: a document becomes as many alignment rows as its text has segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from taxaloom.session import table

SEGMENT = 64


def to_six(x: str) -> Column:
    """F.round(x, 6), but in decimals, which take longer than all else of a pair, only where a half is near or numbers are large."""
    scaled = F.col(x) * 1e6
    plain = (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3) & (F.abs(scaled) < 1e10)
    return F.when(plain, F.floor(scaled + 0.5) / 1e6).otherwise(F.round(x, 6))


def as_sequences(documents: DataFrame) -> DataFrame:
    """dataset = language, seq = the text's ASCII letters."""
    return documents.select(F.col("lang").alias("dataset"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("taxon_id"), F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "").alias("seq"), F.col("doc_id").alias("ord"))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_sequences(table(spark, sf_dir, "documents"))


SEQUENCES = "sequences AS (SELECT lang AS dataset, 'd' || doc_id AS taxon_id, regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g') AS seq, doc_id AS ord FROM documents)"


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut into segments of two rows of 64 columns: the first is the aa row, the second the 3di row."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("partition"), F.lower(F.coalesce("text", F.lit(""))).alias("t"))
    seg = d.select("doc_id", "partition", F.posexplode(F.expr(f"transform(sequence(0, cast(char_length(t) as int) div {2 * SEGMENT}), i -> substr(t, i * {2 * SEGMENT} + 1, {2 * SEGMENT}))")).alias("i", "s"))
    row = lambda a: F.rpad(F.regexp_replace(F.substring("s", a, SEGMENT), "[^a-z]", "-"), SEGMENT, "-")
    both = F.array(F.struct(F.lit("aa").alias("alphabet"), row(1).alias("row")), F.struct(F.lit("3di").alias("alphabet"), row(1 + SEGMENT).alias("row")))
    return seg.select("partition", F.format_string("d%d.%d", "doc_id", "i").alias("taxon_id"), (F.col("doc_id") * F.lit(10**9) + F.col("i")).alias("ord"), F.explode(both).alias("r")).select("partition", "taxon_id", "ord", "r.alphabet", "r.row")


ALIGNMENT = f"""segments AS (SELECT doc_id, source AS "partition", i, substr(t, CAST(i * {2 * SEGMENT} + 1 AS BIGINT), {2 * SEGMENT}) AS s FROM (
  SELECT doc_id, source, lower(coalesce(text, '')) AS t, unnest(range(0, length(lower(coalesce(text, ''))) // {2 * SEGMENT} + 1)) AS i FROM documents)),
alignment AS (SELECT "partition", 'd' || doc_id || '.' || i AS taxon_id, doc_id * 1000000000 + i AS ord, alphabet, rpad(regexp_replace(substr(s, o, {SEGMENT}), '[^a-z]', '-', 'g'), {SEGMENT}, '-') AS row
  FROM segments, (VALUES ('aa', 1), ('3di', {1 + SEGMENT})) AS v(alphabet, o))"""


def part_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per part, a partition per brand: the words of name and type, right-padded."""
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("partition"), F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("taxon_id"), F.rpad(F.regexp_replace(F.lower(F.concat_ws("", "p_name", "p_type")), "[^a-z]", "-"), SEGMENT, "-").alias("row"), F.col("p_partkey").alias("ord"))


PART_ALIGNMENT = f"""part_alignment AS (SELECT p_brand AS "partition", 'p' || p_partkey AS taxon_id, rpad(regexp_replace(lower(p_name || p_type), '[^a-z]', '-', 'g'), {SEGMENT}, '-') AS row, p_partkey AS ord FROM part)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings, with their label as partition, in arithmetic of doubles."""
    return table(spark, sf_dir, "embeddings").select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("taxon_id"), F.col("vec_id").alias("ord"), F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("long").alias("label"))


VECTORS = "vectors AS (SELECT 'v' || vec_id AS taxon_id, vec_id AS ord, CAST(embedding AS DOUBLE[]) AS vec, CAST(label AS BIGINT) AS label FROM embeddings)"

CANDIDATE_KS = (2, 5, 10, 25)


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates: the vectors' ids modulo several k, and the given label."""
    v = vectors(spark, sf_dir)
    options = [F.struct(F.lit(i).alias("grid_pos"), F.concat(F.lit("k"), F.lit(str(k))).alias("candidate_id"), (F.col("ord") % k).alias("label")) for i, k in enumerate(CANDIDATE_KS)]
    options.append(F.struct(F.lit(len(CANDIDATE_KS)).alias("grid_pos"), F.lit("given").alias("candidate_id"), F.col("label")))
    return v.select("taxon_id", F.explode(F.array(*options)).alias("o")).select("taxon_id", "o.grid_pos", "o.candidate_id", "o.label")


MEMBERSHIPS = "memberships AS (" + " UNION ALL ".join([f"SELECT taxon_id, {i} AS grid_pos, 'k{k}' AS candidate_id, ord % {k} AS label FROM vectors" for i, k in enumerate(CANDIDATE_KS)] + [f"SELECT taxon_id, {len(CANDIDATE_KS)}, 'given', label FROM vectors"]) + ")"


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    db = F.create_map(F.lit("A"), F.lit("bfvd_v3"), F.lit("N"), F.lit("afdb50"), F.lit("R"), F.lit("pdb100"))[F.col("l_returnflag")]
    return li.select((F.col("l_suppkey") % 5).alias("query"), db.alias("db"), F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("accession"), (F.col("l_discount") * F.col("l_tax")).alias("evalue"), F.col("l_quantity").cast("int").alias("aln_length"), F.lit(50).alias("q_len"), F.when(F.col("l_linenumber") == 7, 99.95).otherwise(F.col("l_quantity")).alias("seq_id"), F.col("l_orderkey").alias("pos"), F.col("l_extendedprice").alias("tie"))


HITS = "hits AS (SELECT l_suppkey % 5 AS query, CASE l_returnflag WHEN 'A' THEN 'bfvd_v3' WHEN 'N' THEN 'afdb50' WHEN 'R' THEN 'pdb100' END AS db, 't' || l_partkey AS accession, l_discount * l_tax AS evalue, CAST(trunc(l_quantity) AS INT) AS aln_length, 50 AS q_len, CASE WHEN l_linenumber = 7 THEN 99.95 ELSE l_quantity END AS seq_id, l_orderkey AS pos, l_extendedprice AS tie FROM lineitem)"
