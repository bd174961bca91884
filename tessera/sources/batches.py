"""Numbered batches: discovery, signatures, paragraph statistics, index lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import pack_files, rechunk
from .storage import list_folder


def batch_numbers(spark: SparkSession, folder: str, greater_than: int | None = None) -> list[int]:
    """Numbers of the batches below a folder (``batch=7``), in the order of numbers; those above one if asked for."""
    found = sorted(int(n.partition("=")[2]) for n in list_folder(spark, folder) if n.startswith("batch=") and n[6:].isdigit())
    return [n for n in found if greater_than is None or n > greater_than]


def write_signatures(sigs: DataFrame, folder: str, size: int, file: str = "file", first: int = 1) -> None:
    """Signatures (``file, id, sig``) in numbered batches of whole files, which close once they have ``size`` rows."""
    batches = pack_files(sigs.groupBy(file).agg(F.count(F.lit(1)).alias("n")), size, file, first=first)
    sigs.join(batches, file).repartition("batch").sortWithinPartitions(file, "id").write.partitionBy("batch").mode("overwrite").parquet(folder)


def read_signatures(spark: SparkSession, folder: str, greater_than: int | None = None) -> DataFrame:
    """All batches, or those with a greater number; other folders aren't read."""
    out = spark.read.parquet(folder)
    return out if greater_than is None else out.where(F.col("batch") > greater_than)


def renumber_signatures(spark: SparkSession, folder: str, out: str, size: int, first: int = 1) -> None:
    """Batches of another size from the same signatures; files stay whole and in order."""
    write_signatures(read_signatures(spark, folder).drop("batch"), out, size, first=first)


def write_statistics(stats: DataFrame, path: str, by_count: bool = True) -> None:
    """Paragraph statistics (``domain, p, score, count, n_docs``), ranged by domain so that a domain's are read without the others."""
    placed = stats.repartitionByRange("domain", "p")
    placed.sortWithinPartitions("domain", *([F.desc("count")] if by_count else []), "p").write.mode("overwrite").parquet(path)


def read_statistics(spark: SparkSession, path: str, domains: list[str] | None = None, by_domain: bool = False) -> DataFrame:
    """Statistics of all or the given domains (a filter that the scan skips row groups with); by_domain: one row ``domain, n_docs, paragraphs`` for each."""
    out = spark.read.parquet(path)
    if domains is not None:
        out = out.where(F.col("domain").isin(*domains))
    if by_domain:
        out = out.groupBy("domain").agg(F.max("n_docs").alias("n_docs"), F.array_sort(F.collect_list(F.struct("p", "score", "count"))).alias("paragraphs"))
    return out


def write_index_batches(index: DataFrame, path: str, per_file: int = 15_000, order: tuple[str, ...] = ("warc", "offset", "length"), compression: str = "gzip") -> None:
    """Filtered index lines in batches numbered from 0."""
    columns = [c for c in ("domain", "url", "warc", "offset", "length", "status", "mime") if c in index.columns]
    batched = rechunk(index, per_file, list(order), first=0)
    line = F.concat_ws(" ", *(F.col(c).cast("string") for c in columns))
    batched.repartition("batch").sortWithinPartitions("batch", *order).select(line.alias("value"), "batch").write.partitionBy("batch").option("compression", compression).text(path)
