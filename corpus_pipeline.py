"""A corpus from raw documents: five stages, each written as Parquet and read again before the next.

Language ID, near-copy removal, masking of personal data, mixing to target weights, byte-level BPE. All but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from taxaloom.llm import byte_bpe, language_id, mixing, ngram_join, pii
from taxaloom.llm.queries import VOCABULARY
from taxaloom.session import cut, table


#: Documents that a Python worker is handed at a time: texts are long, and workers, their buffers and the JVM share an executor's memory.
BATCH_DOCUMENTS = 1_000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_DOCUMENTS))


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    _small_batches(spark)
    return language_id.accepted_only(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    _small_batches(spark)
    return ngram_join.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked."""
    _small_batches(spark)
    return pii.masked(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream, a row for each copy taken, in order of position."""
    _small_batches(spark)
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of what they decode to, a row for each row of the stream."""
    _small_batches(spark)
    return byte_bpe.round_trip(docs, byte_bpe.load_ranks(spark, VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", recognised),
    ("n-gram Jaccard join", without_copies),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

#: SQL can't express the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage gives of the documents that the stages before have kept, a row for each row of the training stream.

    Null and empty texts have no language, and go in the first stage; an empty table gives an empty result. Equal rows are copies of
    each other. Very long texts go through all stages whole. Columns beyond those of documents are kept up to the last stage.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
