"""The shared folder for intermediate tables."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``. Only a local session may lack the setting; it gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: it has to name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def list_folder(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system that Hadoop knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return sorted(f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p))


def read_file(spark: SparkSession, path: str) -> str | None:
    """A small file's text, null if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return "\n".join(r[0] for r in spark.read.text(path).collect()) if fs.exists(p) else None


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file, through Hadoop's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def file_system(uri: str):
    """The Arrow file system of a URI, for workers, and the path in it. Spark's names of S3 are those that Arrow calls s3."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri if re.match(r"[a-zA-Z][\w+.-]*:/", uri) else f"file://{uri}"))


def file_lines(uri: str) -> Iterator[str]:
    """Lines of a text file, plain or compressed by its suffix, as it streams by; what follows the last newline is a line too."""
    fs, path = file_system(uri)
    end = "\n"
    with fs.open_input_stream(path) as stream, io.TextIOWrapper(stream, "utf-8", "replace", "\n") as lines:
        for line in lines:
            yield line.removesuffix("\n")
            end = line
    if end.endswith("\n"):
        yield ""


def list_files(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """``file``: the files below a path or several, dealt to tasks by size; a worker reads them with :func:`file_lines`."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path).select(F.col("_metadata.file_path").alias("file"))


def open_output(uri: str):
    fs, path = file_system(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(path)


def rename_output(old: str, new: str) -> None:
    fs, path = file_system(old)
    fs.move(path, file_system(new)[1])


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: the end of its lineage, which survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
