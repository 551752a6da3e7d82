"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from taxaloom.llm import byte_bpe, chat, fingerprint, language_id, manifest, mixing, ngram_join, packing, pii, search, sharding, spelling, token_counts
from taxaloom.session import table

#: Where the vocabulary file lies; a parameter, since on a cluster it is put where all machines see it.
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PACKING_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.predict(docs, language_id.fit_on_documents(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe.load_ranks(spark, VOCABULARY), public_tokenizers.PATTERN)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.replay(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.self_search(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.digest(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"), byte_bpe.load_ranks(spark, PACKING_VOCABULARY))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_byte_bpe, op3_ngram_jaccard_join, op4_token_counts, op5_sharding, op6_mixing, op7_exact_top_k, op8_chat_format, op9_fingerprint, op10_personal_data, op11_spelling_variants, op12_merkle_manifest, op13_packing)}

SQL: dict[str, str] = {"op4_token_counts": token_counts.REPLAY_SQL, "op11_spelling_variants": spelling.SQL, "op12_merkle_manifest": manifest.SQL}
