"""A corpus pipeline of five stages over the table ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, langid, minhash, mixing, tokens
from tessera.llm.common import checkpointed, fresh, shared_dir


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that tells rows apart, and its name: doc_id where no row lacks or repeats it, else a number given to each row of a written copy."""
    (k,) = fresh(docs, "row_id")
    n = docs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.col("doc_id").cast("long")).alias("ids")).first()
    if n["rows"] == n["ids"]:
        return docs.withColumn(k, F.col("doc_id").cast("long")), k
    return checkpointed(docs.withColumn(k, F.monotonically_increasing_id()), "numbered"), k


def without(docs: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of docs whose key isn't in ids (column doc_id), without the key."""
    (k,) = fresh(docs, "dropped_id")
    return docs.join(ids.select(F.col("doc_id").alias(k)).distinct(), F.col(key) == F.col(k), "left_anti").drop(key)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language that the network knows go.

    Null and empty texts are in none and go; a null id stays. Very long texts are labelled whole. Repeated rows share their fate. Of
    classes with equal probability the first by name counts. Without any labelled row, as in an empty table, everything stays. Other columns
    come through, whatever their names.
    """
    return langid.accepted_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays: the one with the least id.

    Rows that repeat an id, or lack one, are documents by themselves (then the first row written stays), so of whole repeated rows one
    is left. Null texts, and texts without words, are no duplicates and stay. Very long texts are read whole. The empty table stays
    empty. Other columns come through, whatever their names.
    """
    rows, key = numbered(docs)
    groups = minhash.near_groups(rows, id_col=key, k=3, perms=160, bands=40, b=4, threshold=0.55)
    return without(rows, key, groups.where("is_duplicate"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share 13 successive words or more with a benchmark item go.

    Each row is judged by its own text: one with a null or repeated id too. Null, empty and short texts share nothing and stay; very
    long ones are read whole. There are no ties. An empty table, of documents or of the benchmark, changes nothing. Other
    columns come through, whatever their names.
    """
    rows, key = numbered(docs)
    spans = decontaminate.contaminated_spans(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key)
    return without(rows, key, spans)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in equal shares, none more than four times; repeated documents are repeated rows.

    A null source is a source of its own, a null text has no characters, and rows with a null id are drawn together, by one hash. Rows that repeat an
    id share their draw, so ties don't matter. Very long texts count with all their characters. The empty table stays
    empty. Other columns come through, whatever their names.
    """
    return mixing.mix(docs, max_epochs=4.0, seed=17, epoch_col=None)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in flat files, and where each document's are.

    A null or empty text is its end token; null and repeated ids are kept, a row each. Very long texts are encoded whole. The
    order is that of the rows as they are written, so there are no ties. The empty table has no files. Other columns are left out.
    """
    return tokens.write_tokens(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: A trained network, signatures and token ids can't be written in SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
