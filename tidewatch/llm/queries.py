"""One query per operator over the whole given tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, filter_audit, katz, language, licenses, manifest, maxscore, mixing,
               sharding, simhash, substrings, tokens, toxicity)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_decontaminate_cgk(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op2_language_bitmask(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify_languages(table(spark, sf, "documents"))


def op3_shard_lpt(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf, "documents"), shards=40)


def op4_simhash_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf, "documents"), words=4, bits=4)


def op5_maxscore_topk(spark: SparkSession, sf: str) -> DataFrame:
    return maxscore.search(table(spark, sf, "embeddings"), every=20, k=20)


def op6_katz_backoff(spark: SparkSession, sf: str) -> DataFrame:
    return katz.score_documents(table(spark, sf, "documents"))


def op7_toxicity_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_mix_pareto(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf, "documents")).drop("copies")


def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest.manifest(table(spark, sf, "documents"), tampered=third)


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op13_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate_cgk, op2_language_bitmask, op3_shard_lpt, op4_simhash_near_copies,
        op5_maxscore_topk, op6_katz_backoff, op7_toxicity_lexicon, op8_token_counts,
        op9_mix_pareto, op10_substring_dedup, op11_merkle_manifest,
        op12_filter_audit, op13_license_scan)
}
SQL: dict[str, str] = {"op11_merkle_manifest": manifest.SQL, "op12_filter_audit": filter_audit.SQL}
