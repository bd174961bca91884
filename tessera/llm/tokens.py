"""Operator 3: token ids in flat binary files with 64-bit document offsets, and their memory-mapped reader."""

from __future__ import annotations

import base64
import posixpath
import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, shared_dir

#: The splitting pattern of the public byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_ID = 50256


def load_encoder(path: str, pattern: str = PATTERN):
    """A tiktoken encoding from a file of base64 tokens and ranks, and the highest rank."""
    return _encoder(Path(path).read_bytes(), pattern)


def _encoder(vocabulary: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in vocabulary.splitlines() if line)}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), max(ranks.values())


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a URI. Spark's names of S3, s3a and s3n, are Arrow's s3."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def _writer(folder: str, vocabulary, pattern: str, dtype: np.dtype, end_id: int | None):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, _ = _encoder(vocabulary.value, pattern)
        end = np.array([] if end_id is None else [end_id], dtype=dtype).tobytes()
        fs, base = _filesystem(folder)
        shard = TaskContext.get().partitionId()
        name = f"part-{shard:06d}-{uuid.uuid4().hex[:8]}"  # a retried task writes under a new name; only names in the table count
        at = row = 0
        out = None
        offsets: list[np.ndarray] = []
        last, last_ids = None, b""
        encode = enc._core_bpe.encode_to_tiktoken_buffer
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                out = fs.open_output_stream(posixpath.join(base, name + ".bin"))
            lens = np.empty(b.num_rows, dtype=np.int64)
            column = b.column(1)
            for i in range(b.num_rows):
                text = column[i].as_py()
                if not text:
                    data = end
                elif text == last:  # repeated documents often follow each other
                    data = last_ids
                else:
                    data = np.frombuffer(encode(text, set()), dtype=np.uint32).astype(dtype).tobytes() + end
                    last, last_ids = text, data
                out.write(data)
                lens[i] = len(data) // dtype.itemsize
            starts = at + np.cumsum(lens) - lens
            offsets.append(starts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(b.num_rows, shard, np.int32)), pa.array(row + np.arange(b.num_rows)), pa.array(starts), pa.array(lens), pa.array([name] * b.num_rows)],
                ["doc_id", "shard", "row", "local_start", "n_tokens", "name"],
            )
            at += int(lens.sum())
            row += b.num_rows
        if out is not None:
            out.close()
            with fs.open_output_stream(posixpath.join(base, name + ".idx")) as idx:
                idx.write(np.concatenate([*offsets, [at]]).astype("<i8").tobytes())

    return write


def write_tokens(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, pattern: str = PATTERN, end_id: int | None = END_ID) -> DataFrame:
    """Writes all documents' token ids and returns where each one's are.

    Returns ``doc_id, doc_index, token_start, n_tokens, file``: the document's number and first token in the
    whole corpus, its tokens with the end token, and the file that has them.

    Every partition writes ``.bin`` (unsigned ids, 16 bits if the vocabulary allows, else 32) and ``.idx``
    (64-bit token offsets within the file, one more than documents). The partitions' bases in the corpus
    are exclusive prefix sums of their counts over the partition numbers, one row each, and stand in the
    table ``manifest``, with the kind of number. The vocabulary, a file of the driver, is broadcast. Tokens are made once and written by the tasks that made them: documents aren't
    shuffled. A retried task writes new files, and files that no row names are removed at the end.

    Nulls: a null or empty text has the end token only; a null id stays null. Repeated rows are documents
    by themselves, in the order of the table's partitions, so ties don't occur. An empty table gives an empty manifest; other columns are ignored. A text is encoded
    whole, whatever its length, and strings of special tokens are ordinary text.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark, "tokens")
    fs, base = _filesystem(path)
    fs.create_dir(base, recursive=True)
    vocabulary = Path(tokenizer).read_bytes()  # of the driver; executors needn't have it
    dtype = np.dtype("<u2" if max(_encoder(vocabulary, pattern)[1], end_id or 0) < 1 << 16 else "<u4")
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"))
    schema = "doc_id long, shard int, row long, local_start long, n_tokens long, name string"
    source.mapInArrow(_writer(path, spark.sparkContext.broadcast(vocabulary), pattern, dtype, end_id), schema).write.parquet(f"{path}/documents")
    table = spark.read.schema(schema).parquet(f"{path}/documents")
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    shards = table.groupBy("shard", "name").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("shard_tokens"))
    bases = shards.select("shard", "name", "n_docs", "shard_tokens", F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("base_doc"), F.coalesce(F.sum("shard_tokens").over(before), F.lit(0)).alias("base_token"), F.lit(dtype.str).alias("dtype"))
    bases.coalesce(1).write.parquet(f"{path}/manifest")
    manifest = spark.read.schema(bases.schema).parquet(f"{path}/manifest")
    named = {r[0] for r in manifest.select("name").toLocalIterator()}
    for f in fs.get_file_info(pafs.FileSelector(base)):
        if f.extension in ("bin", "idx") and Path(f.base_name).stem not in named:
            fs.delete_file(f.path)
    side = manifest.select("shard", "base_doc", "base_token")
    if len(named) <= BROADCAST_ROWS:
        side = F.broadcast(side)
    return table.join(side, "shard").select("doc_id", (F.col("base_doc") + F.col("row")).alias("doc_index"), (F.col("base_token") + F.col("local_start")).alias("token_start"), "n_tokens", F.concat(F.lit(path + "/"), "name", F.lit(".bin")).alias("file"))


class TokenCorpus:
    """Memory-mapped view of a folder on a file system that ``write_tokens`` filled."""

    def __init__(self, path: str) -> None:
        self.path = Path(path.removeprefix("file://"))
        m = pq.read_table(self.path / "manifest").sort_by("shard").to_pydict()
        self.names, self.dtype = m["name"], np.dtype(m["dtype"][0] if m["dtype"] else "<u2")
        self.base_doc = np.array(m["base_doc"], dtype=np.int64)
        self.base_token = np.array(m["base_token"], dtype=np.int64)
        self.n_docs, self.n_tokens = sum(m["n_docs"]), sum(m["shard_tokens"])
        self._open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _shard(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self._open:
            f = self.path / self.names[i]
            self._open[i] = np.memmap(f"{f}.bin", self.dtype, "r"), np.memmap(f"{f}.idx", "<i8", "r")
        return self._open[i]

    def document(self, index: int) -> np.ndarray:
        """Token ids of the document with this number in the corpus."""
        if not 0 <= index < self.n_docs:
            raise IndexError(index)
        i = int(np.searchsorted(self.base_doc, index, side="right")) - 1
        ids, offsets = self._shard(i)
        k = index - self.base_doc[i]
        return ids[offsets[k] : offsets[k + 1]]

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Token ids from one corpus position to another, across files."""
        start, stop = max(0, start), min(stop, self.n_tokens)
        out = [np.zeros(0, self.dtype)]
        i = max(0, int(np.searchsorted(self.base_token, start, side="right")) - 1)
        while start < stop:
            ids, _ = self._shard(i)
            part = ids[start - self.base_token[i] : stop - self.base_token[i]]
            out.append(part)
            start += len(part)
            i += 1
        return np.concatenate(out)
