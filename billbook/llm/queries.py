"""The registered queries of this package: one per operator, each over its
whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from billbook.llm import audit, bpe, decontam, langid, lexical, licenses, lpf, minhash, pii, quality, ring, secrets, toxicity
from billbook.llm.common import table

#: Vocabulary of operator 2 (a parameter of its functions).
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicate_rows(table(spark, sf_dir, "documents"), words=2, percent=80)


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_rows(table(spark, sf_dir, "documents"), VOCABULARY)


def op3_bounded_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.shard_rows(table(spark, sf_dir, "documents"), shards=24)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_rows(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rows(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_rows(table(spark, sf_dir, "documents"))


def op8_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lpf.without_repeats(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_rows(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leak_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_rows(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_bpe_codec, op3_bounded_ring_shards, op4_toxicity, op5_language_id,
    op6_quality_rules, op7_license_scan, op8_repeat_removal, op9_secret_scan, op10_decontamination,
    op11_personal_data, op12_ranked_search, op13_filter_audit)}

#: The others can't be written as one SQL query over the tables; the tests
#: hold them against brute force, round trips or held-out labels.
ORACLE: dict[str, str] = {"op12_ranked_search": lexical.ORACLE, "op13_filter_audit": audit.ORACLE}
