"""Shared folder, table cut-offs and batch helpers of the operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows (of a few dozen bytes) up to which a table may be sent to every executor; beyond it operators join by shuffle.
BROADCAST_ROWS = 200_000


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's whole URI under the session's ``spark.checkpoint.dir``; a path without scheme is one of the default file system.

    Only a local session may have none; it gets a temporary folder, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    fs, p = _hadoop_path(spark, f"{base.rstrip('/')}/tessera-{name}-{uuid.uuid4().hex[:12]}")
    return re.sub(r"^file:/(?!/)", "file:///", fs.makeQualified(p).toString())


def delete_dir(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file."""
    fs, p = _hadoop_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def checkpointed(df: DataFrame, name: str, compression: str = "snappy", path: str | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and lost executors cost nothing.

    The shuffle files of the write aren't needed after it and go at once.
    """
    spark = df.sparkSession
    path, before = path or shared_dir(spark, name), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table that :func:`checkpointed` wrote, once nothing reads it any more."""
    delete_dir(df.sparkSession, df.written_to)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of df has."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lower: bool = True) -> DataFrame:
    """Columns ``id`` (bigint) and ``t`` (text, in lower case unless told otherwise); rows without id are left out."""
    t = F.col(f"`{text_col}`")
    return docs.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("id"), (F.lower(t) if lower else t).alias("t"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def by_key(batches: Iterator[pa.RecordBatch], keys: list[str], target: int = 200_000) -> Iterator[pa.Table]:
    """Re-cuts a partition sorted by keys into tables of about ``target`` rows that never split the rows of one key.

    A key with more rows than that comes as one larger table.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < target:
            continue
        table = pa.Table.from_batches(held)
        cut = _last_change(table, keys)
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        held, rows = table.to_batches(), table.num_rows
        if not cut:
            target = max(target, 2 * rows)  # one key is larger: look again when twice as much is here
    if rows:
        yield pa.Table.from_batches(held)


def _last_change(table: pa.Table, keys: list[str]) -> int:
    n = table.num_rows
    change = np.zeros(n - 1, dtype=bool)
    for k in keys:
        v = table.column(k).to_numpy()
        change |= v[1:] != v[:-1]
    at = np.flatnonzero(change)
    return int(at[-1]) + 1 if len(at) else 0


def hash_id(column: str, seed: int) -> Column:
    """52 seeded bits of a column as a double in [0, 1): the md5 that DuckDB also has, so that SQL can repeat it."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(column).cast("string")).cast("binary"))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))
