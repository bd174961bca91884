"""Operator 8: incremental substring deduplication with a log-structured fingerprint index."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F

from .common import _CLEANUP, by_key, checkpointed, delete_dir, discard, keyed_text, shared_dir, shuffle_partitions, write_text
from .textkernel import kgrams, mix, powers, slices, winnow, word_hashes

_U = np.uint64
_TEXTS = "id BIGINT, t STRING, batch INT"
_RUN = "h BIGINT, proof INT, doc BIGINT, pos INT, first_doc BIGINT, first_pos INT, is_first BOOLEAN"
_SPANS = "doc_id long, start int, n_words int, source_doc_id long, source_start int"


def _fingerprints(k: int, w: int):
    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "t", _SLICE):
                wh, wo = word_hashes(b.column(1))
                h, pos, ko = kgrams(wh, wo, k)
                at = winnow(h, ko, w)
                at = at[np.repeat(np.diff(ko), np.diff(ko))[at] >= w]  # a text without a whole window has no run of the guaranteed length
                if not len(at):
                    continue
                proof, _, _ = kgrams(mix(wh ^ _U(0x5851F42D4C957F2D)), wo, k)
                doc = np.searchsorted(ko, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at].view(np.int64)), pa.array((proof[at] >> _U(32)).astype(np.uint32).view(np.int32)), b.column(0).take(pa.array(doc)), pa.array(pos[at].astype(np.int32))], ["h", "proof", "doc", "pos"]
                )

    return fingerprints


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gives every fingerprint of a sorted partition the place where the batch has it first. Holds no more than one record batch."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        h, proof, doc, pos = (c.to_numpy() for c in b.columns)
        new = np.concatenate([[last is None or (h[0], proof[0]) != last[:2]], (h[1:] != h[:-1]) | (proof[1:] != proof[:-1])])
        at, group = np.flatnonzero(new), np.cumsum(new)
        first_doc, first_pos = (np.append(held, x[at])[group] for held, x in ((last[2] if last else 0, doc), (last[3] if last else 0, pos)))
        last = (h[-1], proof[-1], first_doc[-1], first_pos[-1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first_doc), pa.array(first_pos.astype(np.int32)), pa.array(new)], ["h", "proof", "doc", "pos", "first_doc", "first_pos", "is_first"])


def _merge_spans(k: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Joins overlapping windows of the same alignment (sorted by doc, src, diag, pos)."""
        for table in by_key(batches, ["doc", "src"]):
            doc, src, diag, pos = (table.column(c).to_numpy() for c in ("doc", "src", "diag", "pos"))
            new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (src[1:] != src[:-1]) | (diag[1:] != diag[:-1]) | (pos[1:] > pos[:-1] + k)])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(doc)) - 1
            n = pos[last] + k - pos[first]
            yield pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(pos[first]), pa.array(n.astype(np.int32)), pa.array(src[first]), pa.array((pos[first] - diag[first]).astype(np.int32))], ["doc_id", "start", "n_words", "source_doc_id", "source_start"])

    return merge


@dataclass
class Run:
    """An immutable table of fingerprints, bucketed and sorted by hash: one row for each with the place of its first occurrence."""

    table: str
    path: str
    level: int


@dataclass
class Texts:
    """The texts of some batches, in buckets by id, a folder for each batch; those numbered from ``done`` on aren't in the index yet."""

    table: str
    path: str
    done: int = 0


class FingerprintIndex:
    """A log-structured index of the window hashes of all documents added so far.

    Every batch becomes one run. Two neighbouring runs of a level are compacted to one of the next, so
    that n batches leave log n runs; the earlier occurrence of a fingerprint stays. Runs are bucketed by hash into the
    same number of files, so that joining a batch with a run, and merging two runs, needs no shuffle. Texts are in as many
    buckets by id, so that they aren't shuffled when they are read again.

    With a ``path`` the index outlives its session: runs, texts and hits are below it, and after each batch the manifest
    there names those that count. :meth:`open` goes on with it; what a broken batch left isn't named and isn't read.
    """

    def __init__(self, spark: SparkSession, k: int = 40, min_words: int = 50, buckets: int | None = None, path: str | None = None) -> None:
        self.spark, self.k, self.w = spark, k, min_words - k + 1
        self.buckets = buckets or shuffle_partitions(spark)
        self.path = path.rstrip("/") if path else None
        self.runs: list[Run] = []
        self._old: list[Run] = []
        self.texts: list[Texts] = []  # to extend spans
        self.hits: list[DataFrame] = []  # of each batch, with repeats within one document

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> FingerprintIndex:
        m = json.loads("\n".join(r[0] for r in spark.read.text(f"{path.rstrip('/')}/manifest.json").collect()))
        index = cls(spark, m["k"], m["min_words"], m["buckets"], path)
        for place, level in m["runs"]:
            run = Run(f"tessera_run_{uuid.uuid4().hex}", place, level)
            spark.sql(f"CREATE TABLE {run.table} ({_RUN}) USING parquet CLUSTERED BY (h) SORTED BY (h) INTO {index.buckets} BUCKETS LOCATION '{place}'")
            index.runs.append(run)
        for place, done in m["texts"]:
            texts = Texts(f"tessera_texts_{uuid.uuid4().hex}", place, done)
            spark.sql(f"CREATE TABLE {texts.table} ({_TEXTS}) USING parquet PARTITIONED BY (batch) CLUSTERED BY (id) SORTED BY (id) INTO {index.buckets} BUCKETS LOCATION '{place}'")
            spark.catalog.recoverPartitions(texts.table)
            index.texts.append(texts)
        index.hits = [spark.read.schema("doc bigint, pos int, src bigint, src_pos int").parquet(p) for p in m["hits"]]
        for df, p in zip(index.hits, m["hits"]):
            df.written_to = p
        return index

    def _place(self, name: str) -> str:
        return f"{self.path}/{name}-{uuid.uuid4().hex[:12]}" if self.path else shared_dir(self.spark, name)

    def _save(self) -> None:
        if self.path:
            m = {"k": self.k, "min_words": self.k + self.w - 1, "buckets": self.buckets, "runs": [(r.path, r.level) for r in self.runs], "texts": [(x.path, x.done) for x in self.texts], "hits": [x.written_to for x in self.hits]}
            write_text(self.spark, f"{self.path}/manifest.json", json.dumps(m))

    def _write(self, df: DataFrame, level: int) -> Run:
        run = Run(f"tessera_run_{uuid.uuid4().hex}", self._place(f"run-{level}"), level)
        self._save_table(df.write.bucketBy(self.buckets, "h").sortBy("h").format("parquet").option("path", run.path), run.table)
        return run

    def _save_table(self, writer: DataFrameWriter, table: str) -> None:
        """The shuffle files of the write go at once, as in :func:`checkpointed`: those of the texts are as large as the table."""
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            writer.saveAsTable(table)
        finally:
            self.spark.conf.set(_CLEANUP, before)

    def _drop(self, run: Run) -> None:
        self.spark.sql(f"DROP TABLE {run.table}")
        delete_dir(self.spark, run.path)

    def entries(self, run: Run, suffix: str = "") -> DataFrame:
        """The run's fingerprints with their first occurrences."""
        df = self.spark.table(run.table).where("is_first")
        return df.select(*(F.col(c).alias(c + suffix) for c in ("h", "proof", "doc", "pos")))

    def split(self, docs: DataFrame, batches: int) -> list[DataFrame]:
        """Documents (``id``, ``t`` in lower case) in batches by the hash of the id: read once and written once, a folder for each batch."""
        texts = Texts(f"tessera_texts_{uuid.uuid4().hex}", self._place("texts"))
        rows = docs.select("id", "t", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch")).where("t <> ''")
        self._save_table(rows.repartition(self.buckets, "id").write.partitionBy("batch").bucketBy(self.buckets, "id").sortBy("id").format("parquet").option("path", texts.path), texts.table)
        self.texts.append(texts)
        return [self.spark.table(texts.table).where(f"batch = {i}").drop("batch") for i in range(batches)]

    def add(self, texts: DataFrame, last: bool = False) -> DataFrame:
        """Adds the next batch that :meth:`split` wrote and returns its windows that another document had before.

        Columns doc, pos, src, src_pos: an earlier batch goes before, then the lower id within the batch. After the
        last batch that the index ever gets its runs aren't compacted.
        """
        new = texts.mapInArrow(_fingerprints(self.k, self.w), "h long, proof int, doc long, pos int")
        new = new.repartition(self.buckets, "h").sortWithinPartitions("h", "proof", "doc", "pos")
        run = self._write(new.mapInArrow(_firsts, "h long, proof int, doc long, pos int, first_doc long, first_pos int, is_first boolean"), 0)
        hits = self.spark.table(run.table)
        src, at = F.lit(None).cast("long"), F.lit(None).cast("int")
        for i, r in enumerate(self.runs):
            # the proofs are compared apart from the key: with both as keys the buckets, by h alone, would be shuffled
            hits = hits.join(self.entries(r, f"_{i}"), (F.col("h") == F.col(f"h_{i}")) & (F.col("proof").bitwiseXOR(F.col(f"proof_{i}")) == 0), "left")
            src, at = F.coalesce(src, F.col(f"doc_{i}")), F.coalesce(at, F.col(f"pos_{i}"))
        hits = hits.select("doc", "pos", F.coalesce(src, "first_doc").alias("src"), F.coalesce(at, "first_pos").alias("src_pos")).where("src <> doc or src_pos <> pos")
        self.hits.append(checkpointed(hits, "hits", path=self._place("hits")))
        self.runs.append(run)
        while not last and len(self.runs) > 1 and self.runs[-1].level == self.runs[-2].level:
            self._compact()
        self.texts[-1].done += 1
        self._save()
        for run in self._old:  # not before the manifest stops naming them
            self._drop(run)
        self._old = []
        return self.hits[-1].where("src <> doc")

    def drop_runs(self) -> None:
        """Deletes the fingerprints of an index that gets no further batch; texts and hits stay."""
        for run in self.runs:
            self._drop(run)
        self.runs = []

    def _compact(self) -> None:
        a, b = self.runs[-2], self.runs[-1]
        both = self.entries(a).join(self.entries(b, "_b"), (F.col("h") == F.col("h_b")) & (F.col("proof").bitwiseXOR(F.col("proof_b")) == 0), "full_outer")
        merged = both.select(*(F.coalesce(c, f"{c}_b").alias(c) for c in ("h", "proof", "doc", "pos")), F.lit(None).cast("long").alias("first_doc"), F.lit(None).cast("int").alias("first_pos"), F.lit(True).alias("is_first"))
        self.runs[-2:] = [self._write(merged, a.level + 1)]
        if self.path:
            self._old += [a, b]
        else:
            self._drop(a)
            self._drop(b)


def spans(hits: DataFrame, k: int) -> DataFrame:
    """Joins the windows of :meth:`FingerprintIndex.add` to spans."""
    n = shuffle_partitions(hits.sparkSession)
    aligned = hits.select("doc", "src", (F.col("pos") - F.col("src_pos")).alias("diag"), "pos").distinct()
    return aligned.repartition(n, "doc").sortWithinPartitions("doc", "src", "diag", "pos").mapInArrow(_merge_spans(k), _SPANS)


#: Bytes of text that are hashed at once: small, so that the arrays of a worker are too.
_SLICE = 1 << 20
#: Blocks that are compared at once; a power of 2.
_BLOCKS = 64
_PLACES = "id long, batch int, at int, n int, l int, r int, src long, src_at int, digest long, left array<long>, right array<long>"


def _counted(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lists of so many values: offsets, and list and place in it of each value."""
    off = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    return off, row, np.arange(off[-1]) - off[row]


def _ahead(room: np.ndarray, have: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The stretches that tell how far a run goes on, of ``have`` words: offsets, rows, and where they begin and end, counted from the run.

    Of room -1, nothing known, the first 1, 2, 4, ... words; else blocks of so many words that room, which is 2^j - 1, has fewer than 64.
    """
    size = np.maximum(1, (room + 1) // _BLOCKS)
    ladder = np.where(have > 0, np.frexp(have.astype(float))[1], 0)
    off, row, i = _counted(np.where(room < 0, ladder, np.minimum(room // size, have // size)))
    new = room[row] < 0
    return off, row, np.where(new, 0, i * size[row]), np.where(new, np.left_shift(1, np.minimum(i, 40)), (i + 1) * size[row])


def _around(sums, lens: np.ndarray, at: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Digest of n words, and of stretches before them (the nearest first) and after them."""
    off_l, row_l, near_l, far_l = _ahead(left, at)
    off_r, row_r, near_r, far_r = _ahead(right, lens - at - n)
    lists = (pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(v)) for o, v in ((off_l, sums(row_l, at[row_l] - far_l, at[row_l] - near_l)), (off_r, sums(row_r, (at + n)[row_r] + near_r, (at + n)[row_r] + far_r))))
    every = np.arange(len(at))
    return every, at, n, sums(every, at, at + n), *lists


def _runs(k: int, least: int):
    def runs(sums, lens: np.ndarray, at: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray):
        """Digests of the runs of ``least`` words that hold the k words at a place."""
        low = np.maximum(0, at + k - least)
        _, row, i = _counted(np.maximum(0, np.minimum(at, lens - least) + 1 - low))
        start, none = low[row] + i, pa.nulls(len(row), pa.list_(pa.int64()))
        return row, start, np.full(len(row), least), sums(row, start, start + least), none, none

    return runs


def _read(index: FingerprintIndex, places: DataFrame, f) -> DataFrame:
    """f of the words of every text of an id, at the places (``id, at, n, l, r``) asked for. Texts stay in their buckets.

    ``src, src_at`` of a place come through: where its source is, or, with -1, that it is one.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b for batch in batches for b in slices(batch, "t", _SLICE)):
            wh, wo = word_hashes(b.column(1))
            up, down = powers("word", len(wh) + 1)
            total = np.concatenate([np.zeros(1, _U), np.cumsum(wh * up[:-1], dtype=_U)])
            doc = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column(3)).to_numpy(zero_copy_only=False))
            asked = b.column(3).flatten()
            fields = [asked.field(i).to_numpy().astype(np.int64) for i in range(6)]
            inside = (wo[doc + 1] - wo[doc]) >= fields[0] + fields[1]  # another text of the id may be shorter
            doc, fields = doc[inside], [x[inside] for x in fields]
            ids, numbers = b.column(0).to_numpy(), b.column(2).to_numpy()
            for lo in range(0, len(doc), 10_000):
                d, (at, n, left, right, src, src_at) = doc[lo : lo + 10_000], (x[lo : lo + 10_000] for x in fields)

                def sums(row: np.ndarray, start: np.ndarray, end: np.ndarray, first=wo[d], total=total, down=down) -> np.ndarray:
                    start = first[row] + start
                    return mix((total[first[row] + end] - total[start]) * down[start]).view(np.int64)

                row, start, words, digest, before, after = f(sums, wo[d + 1] - wo[d], at, n, left, right)
                small = (pa.array(x.astype(np.int32)) for x in (numbers[d[row]], start, words, left[row], right[row]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[d[row]]), *small, pa.array(src[row]), pa.array(src_at[row].astype(np.int32)), pa.array(digest), before, after], ["id", "batch", "at", "n", "l", "r", "src", "src_at", "digest", "left", "right"])

    asked = places.groupBy("id").agg(F.collect_set(F.struct("at", "n", "l", "r", "src", "src_at")).alias("asked"))
    out, before = [], 0
    for x in index.texts:
        rows = index.spark.table(x.table).where(F.col("batch") < x.done).join(asked, "id")
        out.append(rows.select("id", "t", (F.col("batch") + before).alias("batch"), "asked").mapInArrow(read, _PLACES))
        before += x.done
    return reduce(DataFrame.unionByName, out)


def _equal(a: pa.Array, b: pa.Array) -> np.ndarray:
    """How many leading values of two lists are equal, row by row."""
    (oa, va), (ob, vb) = ((x.offsets.to_numpy(), x.values.to_numpy()) for x in (a, b))
    n = np.minimum(np.diff(oa), np.diff(ob)).astype(np.int64)
    _, row, i = _counted(n)
    other = np.flatnonzero(va[oa[row] + i] != vb[ob[row] + i])
    np.minimum.at(n, row[other], i[other])
    return n


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, start, n, src, at, *rooms = (batch.column(i).to_numpy().astype(np.int64) for i in range(7))
        grown = []
        for room, same in zip(rooms, (_equal(batch.column(7), batch.column(9)), _equal(batch.column(8), batch.column(10)))):
            size, reached = np.maximum(1, (room + 1) // _BLOCKS), np.where(same > 0, np.left_shift(1, np.maximum(same - 1, 0)), 0)
            grown += [np.where(room < 0, reached, same * size), np.where(room < 0, np.maximum(reached - 1, 0), size - 1)]
        left, left_room, right, right_room = grown
        out = (doc, start - left, n + left + right, src, at - left, left_room, right_room)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in zip(out, "q i i q i i i".split())], ["doc_id", "start", "n_words", "source_doc_id", "source_start", "l", "r"])


def _sources(places: DataFrame) -> DataFrame:
    """Places (id, at, n, l, r in this order) that are read for themselves."""
    return places.distinct().toDF("id", "at", "n", "l", "r").select("*", F.lit(0).cast("long").alias("src"), F.lit(-1).alias("src_at"))


def extended(found: DataFrame, index: FingerprintIndex) -> DataFrame:
    """Spans grown word by word to the longest equal runs that hold them, each run once.

    First the 1, 2, 4, ... words on each side of a span are compared in both documents, by their hashes. What is left is less than the
    greatest that is equal, and is searched by fewer than 64 blocks, and those by smaller ones, down to words: two readings
    for less than 128 words, three for less than 8,192. So little is moved, however long the run. A document's stretches are read
    with the place of their source, so that they meet the source's in one join.
    """
    out, todo = [], checkpointed(found.withColumns({"l": F.lit(-1), "r": F.lit(-1)}), "found")
    while True:
        here = todo.select(F.col("doc_id").alias("id"), F.col("start").alias("at"), F.col("n_words").alias("n"), "l", "r", F.col("source_doc_id").alias("src"), F.col("source_start").alias("src_at"))
        read = checkpointed(_read(index, here.union(_sources(here.select("src", "src_at", "n", "l", "r"))), _around).drop("batch"), "around")
        one, two = read.where("src_at >= 0"), read.where("src_at < 0").drop("src", "src_at")
        two = two.select(*(F.col(c).alias(f"{c}_b") for c in two.columns))
        both = one.join(two, [F.col(x) == F.col(f"{y}_b") for x, y in (("src", "id"), ("src_at", "at"), ("n", "n"), ("l", "l"), ("r", "r"), ("digest", "digest"))])
        grown = both.select(*(F.col(x).alias(y) for x, y in (("id", "doc_id"), ("at", "start"), ("n", "n_words"), ("src", "source_doc_id"), ("src_at", "source_start"))), "l", "r", "left", "right", "left_b", "right_b")
        grown = checkpointed(grown.mapInArrow(_grow, _SPANS + ", l int, r int").distinct(), "grown")
        discard(read)
        out.append(grown.where("l = 0 and r = 0").drop("l", "r"))
        todo = grown.where("l <> 0 or r <> 0")
        if todo.isEmpty():
            return reduce(DataFrame.unionByName, out).distinct()


def other_sources(short: DataFrame, hits: DataFrame, index: FingerprintIndex) -> DataFrame:
    """Runs of the guaranteed length at the windows of spans that are shorter, with their first documents.

    The first document of a window may share less of the passage than a later one does. So all documents that have the
    window are read, and each run of the guaranteed length there is looked for among them.
    """
    k, n = index.k, index.k + index.w - 1
    here = short.select(F.col("doc_id").alias("doc"), F.col("source_doc_id").alias("src"), (F.col("start") - F.col("source_start")).alias("diag"), "start", "n_words")
    windows = hits.withColumn("diag", F.col("pos") - F.col("src_pos")).join(here, ["doc", "src", "diag"]).where("pos >= start and pos < start + n_words").select("src", "src_pos").distinct()
    every = reduce(DataFrame.unionByName, index.hits).join(windows, ["src", "src_pos"]).select(F.col("doc").alias("id"), F.col("pos").alias("at"), F.lit(k).alias("n"), F.lit(0).alias("l"), F.lit(0).alias("r"))
    every = every.union(windows.select("src", "src_pos", F.lit(k), F.lit(0), F.lit(0)))
    runs = _read(index, _sources(every), _runs(k, n)).groupBy("id", "at", "digest").agg(F.min("batch").alias("batch"))
    first = runs.withColumn("first", F.min(F.struct("batch", "id", "at")).over(Window.partitionBy("digest"))).where("first.id <> id")
    mine = first.join(short.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
    return mine.select(F.col("id").alias("doc_id"), F.col("at").alias("start"), F.lit(n).alias("n_words"), F.col("first.id").alias("source_doc_id"), F.col("first.at").alias("source_start"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 40, min_words: int = 50, batches: int = 4, index: FingerprintIndex | None = None) -> DataFrame:
    """Passages of documents that another document had before.

    Returns ``doc_id, start, n_words, source_doc_id, source_start`` (word positions from 0). The documents
    come in ``batches`` (by the id's hash); one goes before another if its batch is earlier, or in the same
    batch its id is lower, so that a passage's first document isn't reported. Of every window of
    ``min_words - k + 1`` successive hashes of k words the least is kept; each batch's are sorted, joined with
    the runs of all earlier batches, verified by a second 32-bit hash of the k words, and become a run of the
    index. The source is the first document that has the window. Windows of one alignment that overlap or touch
    are one span, which then grows word by word, by 64-bit hashes, to the longest run that both documents have; of
    fewer than ``min_words`` words none is reported. Where the first document shares less, the first that
    shares ``min_words`` is the source. Thus every run of ``min_words`` words that an earlier document has is
    within a reported span, but for one case: the first document of all its windows shares ``min_words`` words or more, and
    not the run's last (or first) ``min_words - k`` words or fewer, which a later one shares; those words may be missing. A passage with thousands of copies is thousands of rows, not of pairs.

    With a given index, which may hold earlier documents, the documents are further batches of it.

    Nulls: rows with a null id are left out; a null or empty text, or one of fewer than ``min_words`` words,
    has no spans. Texts are read whole, however long. Of equally early sources the lower place counts. Repeats within one document, or under one id, aren't reported. Repeated rows give no further rows. Empty
    tables give an empty result; other columns are ignored.
    """
    own = index is None
    index = FingerprintIndex(docs.sparkSession, k, min_words) if own else index
    source = keyed_text(docs, id_col, text_col).where("t is not null")
    hits = None
    for i, part in enumerate(index.split(source, batches)):
        found = index.add(part, last=own and i == batches - 1)
        hits = found if hits is None else hits.unionByName(found)
    if own:
        index.drop_runs()
    least = index.k + index.w - 1
    whole = checkpointed(extended(spans(hits, index.k), index), "spans")
    long, short = whole.where(F.col("n_words") >= least), whole.where(F.col("n_words") < least)
    if short.isEmpty():
        return long
    return long.unionByName(extended(other_sources(short, hits, index), index)).distinct()
