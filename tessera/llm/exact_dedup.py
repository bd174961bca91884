"""Operator 5: exact deduplication by a tree merge of sorted digest runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, shuffle_partitions

_RUN = np.dtype([("key", "<u8"), ("p0", "<u8"), ("p1", "<u8"), ("p2", "<u8"), ("p3", "<u8"), ("id", "<i8"), ("n", "<i8")])
_SCHEMA = "bucket int, run long, payload binary"


def merge_runs(runs: list[np.ndarray]) -> np.ndarray:
    """Multiway merge of runs sorted by (key, proof): one record for each verified digest, with its least id.

    Records of equal 64-bit keys are the same text only if their 256-bit proofs agree too; keys that
    collide stay apart. Two runs are merged by binary search of one in the other, more of them pairwise.
    """
    while len(runs) > 1:
        runs = [_merge_two(runs[i], runs[i + 1]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    return runs[0]


def _merge_two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    both = np.empty(len(a) + len(b), dtype=_RUN)
    at = np.searchsorted(a["key"], b["key"], side="right") + np.arange(len(b))
    mask = np.ones(len(both), dtype=bool)
    mask[at] = False
    both[at] = b
    both[mask] = a
    return _fold(both)


def _fold(run: np.ndarray) -> np.ndarray:
    """Joins verified equal records of a run that is sorted by key."""
    if len(run) < 2:
        return run
    same = run["key"][1:] == run["key"][:-1]
    if not same.any():
        return run
    near = np.zeros(len(run), dtype=bool)
    near[1:] |= same
    near[:-1] |= same
    tied, rest = run[near], run[~near]
    tied = tied[np.lexsort((tied["id"], tied["p3"], tied["p2"], tied["p1"], tied["p0"], tied["key"]))]
    new = np.ones(len(tied), dtype=bool)
    new[1:] = np.logical_or.reduce([tied[c][1:] != tied[c][:-1] for c in ("key", "p0", "p1", "p2", "p3")])
    first = np.flatnonzero(new)
    n = np.add.reduceat(tied["n"], first)
    tied = tied[first]
    tied["n"] = n
    out = np.concatenate([rest, tied])
    return out[np.argsort(out["key"], kind="stable")]


def _leaf_runs(buckets: int):
    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for b in batches:
            r = np.zeros(b.num_rows, dtype=_RUN)
            r["key"] = b.column(0).to_numpy().view(np.uint64)
            proof = b.column(1)
            raw = np.frombuffer(proof.buffers()[2], np.uint8, count=32 * b.num_rows, offset=32 * proof.offset) if b.num_rows else np.zeros(0, np.uint8)
            for i, c in enumerate(("p0", "p1", "p2", "p3")):
                r[c] = raw.reshape(-1, 4, 8)[:, i].copy().view("<u8").ravel()
            r["id"] = b.column(2).to_numpy()
            r["n"] = 1
            parts.append(_fold(r[np.argsort(r["key"], kind="stable")]))
        if not parts:
            return
        run = merge_runs(parts)
        bucket = (run["key"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)  # ranges of keys
        cut = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        at = [i for i in range(buckets) if cut[i] < cut[i + 1]]
        who = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([who] * len(at), pa.int64()), pa.array([run[cut[i] : cut[i + 1]].tobytes() for i in at], pa.binary())], ["bucket", "run", "payload"])

    return leaf


def _merge_group(table: pa.Table) -> pa.Table:
    runs = [np.frombuffer(x.as_py(), dtype=_RUN) for x in table.column("payload")]
    return pa.table({"bucket": table.column("bucket").slice(0, 1), "run": pa.array([table.column("parent")[0].as_py()], pa.int64()), "payload": pa.array([merge_runs(runs).tobytes()], pa.binary())})


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x in b.column("payload"):
            r = np.frombuffer(x.as_py(), dtype=_RUN)
            r = r[r["n"] > 1]
            proof = np.stack([r[c] for c in ("p0", "p1", "p2", "p3")], axis=1).astype("<u8")
            yield pa.RecordBatch.from_arrays([pa.array(r["key"].view(np.int64)), pa.array([p.tobytes() for p in proof], pa.binary()), pa.array(r["id"])], ["key", "proof", "keep_id"])


#: Digests (56 bytes each) of one range of keys: what a task of the last round holds.
RANGE_DIGESTS = 1_000_000


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8, range_digests: int = RANGE_DIGESTS) -> DataFrame:
    """For every document the least id among the documents with the same text.

    Returns ``doc_id, keep_id, is_duplicate``. Each partition sorts its digests into runs, one for each
    range of keys; in round j the runs that agree in all but the last j base-``fan_in`` digits of their
    number merge at one of them (a binomial tree for 2; for more, rounds of multiway merges), so that after log(partitions)
    rounds every range has one run. Ranges are as many as keep one below about ``range_digests``. Equal
    64-bit keys are verified at every level by SHA-256. Only digests move, each distinct one at most once
    a round and partition, so in the tree a text with many copies is no skew; in the last join, which brings the least
    ids back, Spark splits such a key's partition, as its other side is one row.

    Nulls: a null text equals no other (keep_id is its own id) and takes no part in the join; rows with a null id are left
    out. The empty text is a text like others, and so is a very long one, of which only the digest moves. Of equal texts the least
    id is kept, so there are no ties. Repeated rows give one row; an id with several texts gives one
    row for each. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    t = F.col(f"`{text_col}`")
    digests = checkpointed(
        docs.where(F.col(f"`{id_col}`").isNotNull()).select(F.xxhash64(t).alias("key"), F.unhex(F.sha2(t.cast("binary"), 256)).alias("proof"), F.col(f"`{id_col}`").cast("long").alias("id")),
        "digests",
    )
    known, nothing = digests.where(F.col("proof").isNotNull()), digests.where(F.col("proof").isNull())
    n = max(1, known.rdd.getNumPartitions())
    ranges = max(shuffle_partitions(spark), -(-known.count() // range_digests))
    runs = known.mapInArrow(_leaf_runs(ranges), _SCHEMA)
    while n > 1:
        n = -(-n // fan_in)
        runs = runs.withColumn("parent", F.floor(F.col("run") / fan_in)).groupBy("bucket", "parent").applyInArrow(_merge_group, _SCHEMA)
    least = runs.mapInArrow(_repeated, "key long, proof binary, keep_id long")
    keep = F.coalesce("keep_id", "id")
    alone = nothing.select(F.col("id").alias("doc_id"), F.col("id").alias("keep_id"), F.lit(False).alias("is_duplicate")).distinct()
    return known.join(least, ["key", "proof"], "left").select(F.col("id").alias("doc_id"), keep.alias("keep_id"), (keep != F.col("id")).alias("is_duplicate"), "key").distinct().drop("key").unionByName(alone)


ORACLE_SQL = """
SELECT doc_id, keep_id, doc_id <> keep_id AS is_duplicate FROM (
  SELECT DISTINCT doc_id, text, CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS keep_id
  FROM documents WHERE doc_id IS NOT NULL)
"""
