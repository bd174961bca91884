"""Vectorised text kernels over Arrow string columns.

A batch of documents is one byte array with offsets (the Arrow layout itself), so words, word
hashes, k-gram hashes and winnowing are a few numpy passes over the batch and no per-document
Python loop runs. Words are maximal runs of ``[0-9a-z]`` and non-ASCII characters of the
lower-cased text (lower-case in the JVM before the batch comes here); other characters separate.

Null texts count as empty. Every kernel returns arrays in CSR form: values, and offsets with one
more entry than there are documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one kernel call handles; documents are never split, so one longer than this is a slice of its own.
SLICE_BYTES = 4 << 20

_U = np.uint64
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xC2B2AE3D27D4EB4F}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """b^0..b^(n-1) and their inverses modulo 2^64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        b = _BASES[base]
        up, down = np.full(size, b, dtype=_U), np.full(size, pow(b, -1, 1 << 64), dtype=_U)
        up[0] = down[0] = 1
        have = _powers[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have[0][:n], have[1][:n]


def forget_powers() -> None:
    """Frees the kept powers, for a process that goes on to work without them; they are worked out again when needed."""
    _powers.clear()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the result depends on all of the input."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    big = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if big else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of whole rows with at most ``limit`` bytes of text (one row at least)."""
    _, off = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the offsets of each document's words."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = np.empty(n + 1, dtype=bool)
    np.take(_WORD, data, out=inside[1:])
    inside[0] = False
    first = off[:-1][off[:-1] < off[1:]]
    change = inside[1:] & ~inside[:-1]
    change[first] = inside[first + 1]
    start = np.flatnonzero(change)
    ends = np.empty(n, dtype=bool)
    np.greater(inside[1:-1], inside[2:], out=ends[:-1])
    ends[-1] = inside[n]
    last = off[1:][off[:-1] < off[1:]] - 1
    ends[last] = inside[last + 1]
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, off)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span: a polynomial modulo 2^64, mixed with the length."""
    up, down = powers("byte", len(data) + 1)
    total = np.empty(len(data) + 1, dtype=_U)
    total[0] = 0
    np.cumsum((data.astype(_U) + _U(1)) * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U) * _U(0x632BE59BD9B4E019))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, with document offsets."""
    data, off = text_bytes(column)
    start, end, wo = words(data, off)
    return (span_hash(data, start, end) if len(start) else np.zeros(0, _U)), wo


def kgrams(wh: np.ndarray, wo: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and word position (within its document) of every run of k words, with document offsets."""
    lens = np.diff(wo)
    counts = np.maximum(lens - k + 1, 0)
    ko = np.concatenate([[0], np.cumsum(counts)])
    if ko[-1] == 0:
        return np.zeros(0, _U), np.zeros(0, np.int64), ko
    pos = np.arange(ko[-1]) - np.repeat(ko[:-1], counts)
    at = pos + np.repeat(wo[:-1], counts)
    up, down = powers("word", len(wh) + 1)
    total = np.empty(len(wh) + 1, dtype=_U)
    total[0] = 0
    np.cumsum(wh * up[:-1], out=total[1:])
    return mix((total[at + k] - total[at]) * down[at]), pos, ko


def _sliding(a: np.ndarray, w: int, op: np.ufunc) -> np.ndarray:
    """op over a[i:i+w] for every i that has w values."""
    out, have = a, 1
    while have * 2 <= w:
        out = op(out[:-have], out[have:])
        have *= 2
    if have < w:
        out = op(out[: len(out) - (w - have)], out[w - have :])
    return out


def winnow(h: np.ndarray, ko: np.ndarray, w: int) -> np.ndarray:
    """Indices of the winnowed values: those that are the least of some window of w successive values.

    Equal least values of a window are all kept. A document with fewer than w values is one window.
    """
    n = len(h)
    if n == 0 or w <= 1:
        return np.arange(n)
    lens = np.diff(ko)
    low = np.zeros(n, dtype=_U)
    seen = np.zeros(n, dtype=bool)
    if n >= w:
        low[: n - w + 1] = _sliding(h, w, np.minimum)
        pos_left = np.repeat(ko[1:], lens) - np.arange(n)
        seen = pos_left >= w
        low[~seen] = 0
    # greatest of the window minima over the windows that hold i: windows that start in (i-w, i]
    padded = np.concatenate([np.zeros(w - 1, _U), low])
    top = _sliding(padded, w, np.maximum)
    keep = top == h
    # a window that starts in the document before never reaches in here, as its minimum was set to 0; 0 itself may be a hash
    if not h.all():
        keep &= (h != 0) | seen
    short = np.flatnonzero((lens > 0) & (lens < w))
    if len(short):
        for d in short if len(short) < 64 else ():
            a, b = ko[d], ko[d + 1]
            keep[a:b] = h[a:b] == h[a:b].min()
        if len(short) >= 64:
            full = np.flatnonzero(lens > 0)
            least = np.repeat(np.minimum.reduceat(h, ko[:-1][full]), lens[full])
            is_short = np.repeat(lens[full] < w, lens[full])
            keep = np.where(is_short, h == least, keep)
    return np.flatnonzero(keep)
