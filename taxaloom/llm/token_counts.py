"""Token counts as delta-maintained rollups.

Changes (inserts, deletes, revised counts) become signed sums by source, language and tokenizer version. A batch's sums are
one partition of the ledger, written by overwriting that partition alone: sending a batch again, after a failure or by
mistake, replaces it by the same rows. Totals are the sums over the ledger. Nothing reads the documents again.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from taxaloom.llm.mixing import words
from taxaloom.session import cut, shared_folder

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens"]
#: Rows of a change feed; n_old is the count that a revision replaces, else ignored.
CHANGES = "op string, source string, lang string, tokenizer string, n_tokens long, n_old long"


def signed(changes: DataFrame) -> DataFrame:
    """Sums of a change feed: inserts count 1 and their tokens, deletes the negative of both, revisions the difference.

    Null counts are 0, null keys are keys of their own, and any other op (null too) changes nothing. Repeated rows each count:
    what must count once belongs into one batch once. Summed in every task before the shuffle, so a hot source is small.
    """
    n, old = (F.coalesce(F.col(c), F.lit(0)) for c in ("n_tokens", "n_old"))
    docs = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0).cast("long")
    tokens = F.when(F.col("op") == "insert", n).when(F.col("op") == "delete", -n).when(F.col("op") == "revise", n - old).otherwise(0)
    known = F.col("op").isin("insert", "delete", "revise")
    return changes.where(known).select(*KEYS, docs.alias("n_docs"), tokens.alias("n_tokens")).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


class Rollup:
    """A ledger of batches in a folder of the shared store."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.schema = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch long"

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Idempotent: the batch's partition is replaced whole, others stay. A row that counts nothing goes along, so that a batch
        without changes replaces what was sent under its number before. Columns beside those of CHANGES are left out."""
        nothing = self.spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in KEYS], *[F.lit(0).cast("long").alias(c) for c in SUMS])
        self._write(signed(changes).unionByName(nothing).withColumn("batch", F.lit(batch).cast("long")))

    def _write(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.folder)

    def ledger(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder)

    def totals(self) -> DataFrame:
        """Additive totals; groups whose documents and tokens both came down to 0 are left out."""
        summed = self.ledger().groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        return summed.where("n_docs <> 0 or n_tokens <> 0")


def feed(op: str, docs: DataFrame, tokenizer: str, n: Column, old: Column | None = None) -> DataFrame:
    return docs.select(F.lit(op).alias("op"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), n.cast("long").alias("n_tokens"), (F.lit(None) if old is None else old).cast("long").alias("n_old"))


def replay(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The totals after four batches over a corpus: all documents come in, counted as words, bytes and stated characters; the
    stated counts of characters are revised to the measured ones; toxic documents go; the last batch is sent twice."""
    spark = docs.sparkSession
    rollup = Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid4().hex}")
    counts = {"w": words(F.col("text")), "b": F.coalesce(F.octet_length("text"), F.lit(0)), "c": F.coalesce(F.char_length("text"), F.lit(0)), "stated": F.coalesce(F.col("n_chars"), F.lit(0))}
    sized = cut(docs.select("doc_id", "source", "lang", *[x.cast("long").alias(k) for k, x in counts.items()]))  # texts are read once
    w, b, c, stated = (F.col(k) for k in counts)
    inserts = [feed("insert", sized, "words@1", w), feed("insert", sized, "bytes@1", b), feed("insert", sized, "chars@1", stated)]
    rollup.commit(1, reduce(DataFrame.union, inserts))
    rollup.commit(2, feed("revise", sized, "chars@1", c, stated))
    toxic = sized.join(labels.where("toxic = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    gone = reduce(DataFrame.union, [feed("delete", toxic, "words@1", w), feed("delete", toxic, "bytes@1", b), feed("delete", toxic, "chars@1", c)])
    for _ in range(2):
        rollup.commit(3, gone)
    return rollup.totals()


REPLAY_SQL = r"""
WITH d AS (
  SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, strlen(coalesce(text, '')) AS bytes, length(coalesce(text, '')) AS chars
  FROM documents WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM (
  SELECT source, lang, 'words@1' AS tokenizer, words AS n FROM d UNION ALL SELECT source, lang, 'bytes@1', bytes FROM d UNION ALL SELECT source, lang, 'chars@1', chars FROM d
) GROUP BY source, lang, tokenizer
"""
