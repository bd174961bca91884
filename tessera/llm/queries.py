"""The ten operators as queries over the tables of a folder, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, langid, lm, minhash, mixing, pii, substring, tokens, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_read(spark, sf_dir, "documents"), held_of=10, rounds=15)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"), max_epochs=4.0, seed=17)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.write_tokens(_read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), threshold=0.5, most=4000)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_read(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"), per_language=300, least=0.3)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(_read(spark, sf_dir, "documents"), k=3, perms=160, bands=40, b=4, threshold=0.55)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_spans(_read(spark, sf_dir, "documents"), k=40, min_words=50, batches=4)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_read(spark, sf_dir, "documents"), excerpts=600)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_spans(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=8, min_words=13)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_source_mixing": op2_source_mixing,
    "op3_token_output": op3_token_output,
    "op4_toxicity": op4_toxicity,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_language_id": op6_language_id,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_pii": op9_pii,
    "op10_decontamination": op10_decontamination,
}

ORACLES: dict[str, str] = {
    "op2_source_mixing": mixing.mix_sql("doc_id, text, lang, source, n_chars", max_epochs=4.0, seed=17),
    "op5_exact_dedup": exact_dedup.ORACLE_SQL,
    "op10_decontamination": decontaminate.ORACLE_SQL,
}
