"""Operator 10: benchmark decontamination by winnowing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, keyed_text
from .textkernel import kgrams, slices, winnow, word_hashes

#: Bytes of benchmark text up to which every worker gets the fingerprints; a larger benchmark is joined with the documents by shuffle.
BENCHMARK_BYTES = 32 << 20
_OUT = "doc_id long, item_id long, doc_start int, item_start int, n_words int"


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", k: int = 8, min_words: int = 13, broadcast_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """All longest word runs of at least ``min_words`` that a document shares with a benchmark item.

    Returns ``doc_id, item_id, doc_start, item_start, n_words`` (word positions from 0), each row once.
    Both sides are winnowed: of every window of ``min_words - k + 1`` successive k-gram hashes the least
    is kept, so any shared run of ``min_words`` words has a common fingerprint. Equal fingerprints are
    joined and extended word by word to both sides; runs that stay shorter are dropped, so the result is
    exact. Words are compared by 64-bit hash, in lower case, without punctuation.

    The benchmark's fingerprints go to every worker, if they are within ``broadcast_bytes`` of text, and the documents
    aren't shuffled then. Fingerprints of a larger benchmark are joined with the documents' by shuffle, and only texts of
    pairs with a common fingerprint are brought together.

    Nulls: rows with a null id are left out; a null or empty text, or one of fewer than ``min_words``
    words, shares nothing. Texts are read whole, however long. An item that occurs in several places is a row for each, so there
    are no ties. Repeated rows give no further rows. Empty tables give an empty result; other
    columns are ignored.
    """
    spark = docs.sparkSession
    w = min_words - k + 1
    items = keyed_text(benchmark, item_col, item_text_col).where(F.length("t") > 0)
    n_bytes = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    todo = keyed_text(docs, id_col, text_col)
    if n_bytes > broadcast_bytes:
        return _joined(todo.where(F.length("t") > 0), items, k, w, min_words)
    table = items.distinct().toArrow()
    item_ids = table.column("id").to_numpy()
    wh, wo = word_hashes(table.column("t"))
    h, pos, ko = kgrams(wh, wo, k)
    at = winnow(h, ko, w)
    order = np.argsort(h[at], kind="stable")
    item = np.searchsorted(ko, at, side="right") - 1
    held = spark.sparkContext.broadcast((item_ids, wh, wo, h[at][order], item[order], pos[at][order]))
    return todo.mapInArrow(_matcher(held, k, w, min_words), _OUT).distinct()


def _joined(docs: DataFrame, items: DataFrame, k: int, w: int, min_words: int) -> DataFrame:
    """The same by a join of winnowed fingerprints. Texts are numbered, as an id may have several; pairs of texts are compared once, at all their hits."""

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "t"):
                h, pos, ko = kgrams(*word_hashes(b.column(1)), k)
                at = winnow(h, ko, w)
                doc = np.searchsorted(ko, at, side="right") - 1
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(h[at].view(np.int64)), pa.array(pos[at].astype(np.int32))], ["n", "h", "pos"])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "t"):
                aw, ao = word_hashes(b.column(1))
                bw, bo = word_hashes(b.column(3))
                hits = [np.array([(x["pos"], x["at"]) for x in row], dtype=np.int64).reshape(-1, 2) for row in b.column(4).to_pylist()]
                which = np.repeat(np.arange(len(hits)), list(map(len, hits)))
                both = np.concatenate(hits) if hits else np.zeros((0, 2), np.int64)
                keep = np.array([len(bo) > 1] * len(which), dtype=bool)
                d, i, ds, is_, n = extend(aw, ao, which[keep], both[keep, 0], bw, bo, which[keep], both[keep, 1])
                ok = n >= min_words
                ids, item_ids = b.column(0).to_numpy(), b.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids[d[ok]]), pa.array(item_ids[i[ok]]), *(pa.array(x[ok].astype(np.int32)) for x in (ds, is_, n))], ["doc_id", "item_id", "doc_start", "item_start", "n_words"])

    numbered = [checkpointed(x.distinct().withColumn("n", F.monotonically_increasing_id()), "texts") for x in (docs, items)]
    mine, theirs = (x.select("n", "t").mapInArrow(fingerprints, "n long, h long, pos int") for x in numbered)
    theirs = theirs.select(F.col("n").alias("m"), "h", F.col("pos").alias("at"))
    pairs = mine.join(theirs, "h").groupBy("n", "m").agg(F.collect_list(F.struct("pos", "at")).alias("hits"))
    whole = pairs.join(numbered[0], "n").join(numbered[1].select(F.col("n").alias("m"), F.col("id").alias("item"), F.col("t").alias("s")), "m")
    return whole.select("id", "t", "item", "s", "hits").mapInArrow(grow, _OUT).distinct()


def _matcher(held, k: int, w: int, min_words: int):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, iw, io, keys, items, starts = held.value
        table = 1 << 20  # a bitmap of low bits lets nearly all hashes skip the search
        seen = np.zeros(table, dtype=bool)
        seen[(keys & np.uint64(table - 1)).astype(np.int64)] = True
        for batch in batches:
            for b in slices(batch, "t"):
                wh, wo = word_hashes(b.column(1))
                h, pos, ko = kgrams(wh, wo, k)
                at = np.flatnonzero(seen[(h & np.uint64(table - 1)).astype(np.int64)])
                if not len(at):
                    continue
                lo = np.searchsorted(keys, h[at], side="left")
                hit = (lo < len(keys)) & (keys[np.minimum(lo, len(keys) - 1)] == h[at])
                if not hit.any():
                    continue
                chosen = np.zeros(len(h), dtype=bool)
                chosen[winnow(h, ko, w)] = True
                hit &= chosen[at]
                at, lo = at[hit], lo[hit]
                n = np.searchsorted(keys, h[at], side="right") - lo
                rep = np.repeat(np.arange(len(at)), n)
                which = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                doc = np.searchsorted(ko, at, side="right")[rep] - 1
                rows = extend(wh, wo, doc, pos[at][rep], iw, io, items[which], starts[which])
                d, i, ds, is_, ln = (x[rows[4] >= min_words] for x in rows)
                if len(d):
                    ids = b.column(0).to_numpy()
                    yield pa.RecordBatch.from_arrays([pa.array(ids[d]), pa.array(item_ids[i]), pa.array(ds.astype(np.int32)), pa.array(is_.astype(np.int32)), pa.array(ln.astype(np.int32))], ["doc_id", "item_id", "doc_start", "item_start", "n_words"])

    return match


def extend(aw, ao, a, a_pos, bw, bo, b, b_pos):
    """Grows aligned word positions of documents a and b to the longest equal runs that hold them.

    Returns (a, b, a_start, b_start, n_words), each run once. All hits grow together, a word a step, and
    hits of one run are joined at the start, so the work is the length of the runs.
    """
    diag = a_pos - b_pos
    order = np.lexsort((a_pos, diag, b, a))
    a, b, a_pos, b_pos, diag = (x[order] for x in (a, b, a_pos, b_pos, diag))
    left, right = a_pos.copy(), a_pos.copy()  # equal words are known to be [left, right)
    a0, b0 = ao[a], bo[b]
    a_len, b_len = ao[a + 1] - a0, bo[b + 1] - b0
    live = np.arange(len(a))
    while len(live):  # to the right
        p = right[live]
        q = p - diag[live]
        inside = (p < a_len[live]) & (q < b_len[live])
        live, p, q = live[inside], p[inside], q[inside]
        same = aw[a0[live] + p] == bw[b0[live] + q]
        live = live[same]
        right[live] += 1
        if len(live):  # a hit that reaches the next hit of its diagonal leaves the rest to that one
            nxt = np.minimum(live + 1, len(a) - 1)
            joined = (nxt > live) & (a[nxt] == a[live]) & (b[nxt] == b[live]) & (diag[nxt] == diag[live]) & (left[nxt] <= right[live])
            live = live[~joined]
    new = np.ones(len(a), dtype=bool)
    if len(a) > 1:
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (diag[1:] != diag[:-1]) | (a_pos[1:] > right[:-1])
    first = np.flatnonzero(new)
    right = np.maximum.reduceat(right, first) if len(first) else right
    a, b, left, diag, a0, b0 = (x[first] for x in (a, b, left, diag, a0, b0))
    live = np.arange(len(a))
    while len(live):  # to the left
        p = left[live] - 1
        q = p - diag[live]
        inside = (p >= 0) & (q >= 0)
        live, p, q = live[inside], p[inside], q[inside]
        same = aw[a0[live] + p] == bw[b0[live] + q]
        live = live[same]
        left[live] -= 1
    return a, b, left, left - diag, right - left


ORACLE_SQL = """
WITH dw AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[0-9a-z\\x{80}-\\x{10ffff}]+') AS w FROM documents WHERE doc_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[0-9a-z\\x{80}-\\x{10ffff}]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
dg AS (SELECT doc_id, i - 1 AS p, array_to_string(w[i:i+12], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM dw WHERE len(w) >= 13)),
bg AS (SELECT item_id, i - 1 AS q, array_to_string(w[i:i+12], ' ') AS g FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM bw WHERE len(w) >= 13)),
m AS (SELECT DISTINCT doc_id, item_id, p, q, p - q AS diag FROM dg JOIN bg USING (g)),
r AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item_id, diag ORDER BY p) AS island FROM m)
SELECT doc_id, item_id, CAST(min(p) AS INTEGER) AS doc_start, CAST(min(q) AS INTEGER) AS item_start, CAST(count(*) + 12 AS INTEGER) AS n_words
FROM r GROUP BY doc_id, item_id, diag, island
"""
