"""Operator 1: language-model scores by deleted interpolation of word n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_key, checkpointed, shuffle_partitions
from .textkernel import forget_powers, mix, slices, word_hashes

#: Words of the longest n-gram.
ORDER = 3
#: Context-frequency buckets: unseen, then one for each power of two.
BUCKETS = 48
#: Bytes of text whose n-grams a worker counts and scores at once, and n-grams of one range of keys. Larger ones make fewer and longer messages.
CHUNK_BYTES, RANGE_KEYS = 8 << 20, 4 << 20
#: Symbols whose n-grams or probabilities a worker works out at once, bytes of text that it hashes at once, and bytes of a message's numbers from which it is sent.
STEP, HASH_BYTES, SEND_BYTES = 1 << 16, 1 << 20, 4 << 20
#: Bytes that a word is taken to have with what is between words.
WORD_BYTES = 6
_U = np.uint64
#: The symbols before and after a text.
_BEGIN, _END = _U(0x1D8E4E27C47D124F), _U(0xEB44ACCAB455D165)
_CHUNK = "chunk long, held boolean, n_docs long, n_symbols long, ids array<long>, known array<boolean>, lens array<int>, vocabulary binary, words binary"
_COUNTS = "range int, chunk long, held boolean, keys binary, counts binary"
_TOTALS = "chunk long, range int, held boolean, at binary, total binary, train binary, n_words long"
_SCORES = "doc_id long, known boolean, n_words long, bits double"
_CASES = "n long, " + ", ".join(f"q{k} double, b{k} long" for k in range(1, ORDER + 1))


def _planes(a: np.ndarray) -> bytes:
    """The bytes of all numbers, the lowest ones first: what is alike in all of them compresses to nothing."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _numbers(data: bytes, dtype: str) -> np.ndarray:
    kind = np.dtype(dtype)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def gram_keys(number: np.ndarray, symbols: np.ndarray, so: np.ndarray, k: int) -> np.ndarray:
    """The keys of the n-grams of order k + 1 that end in each symbol of the texts.

    number: of every symbol, its place in symbols (hashes); so: the texts' offsets. A key has 56 bits: a hash and, as its
    two lowest bits, the order, so that n-grams of different orders never meet.
    """
    keys = np.empty(len(number), dtype=_U)
    for lo in range(0, len(number), STEP):
        hi = min(lo + STEP, len(number))
        h = symbols[number[lo:hi]]
        for j in range(1, k + 1):
            before, skip = np.full(hi - lo, _BEGIN, dtype=_U), max(j - lo, 0)
            before[skip:] = symbols[number[lo + skip - j : max(hi - j, 0)]]
            a, b = np.searchsorted(so[:-1], [lo - j + 1, hi])
            for i in range(j):  # positions whose j-th symbol before is of the text before
                at = so[a:b] + i
                before[at[(at < so[a + 1 : b + 1]) & (at >= lo) & (at < hi)] - lo] = _BEGIN
            h = mix(h * _U(0x9E3779B97F4A7C15) + before)
        keys[lo:hi] = mix(h) >> _U(10) << _U(2) | _U(k)
    return keys


def _new(x: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    new = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return new


def _places(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The place of each value among the distinct ones; order sorts the values, and new says where they change then."""
    at, number = np.empty(len(order), dtype=np.uint32), np.cumsum(new, dtype=np.uint32)
    number -= 1
    at[order] = number
    return at


def _distinct(a: list[np.ndarray], places: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """The only array of the list, which is taken from it: its sorted distinct values, their counts, and the place of each value among them."""
    x, at = a.pop(), None
    if places:
        order = np.argsort(x)
        x = x[order]
        at = _places(order, _new(x))
        del order
    else:
        x.sort()
    first = np.flatnonzero(_new(x))
    n = np.empty(len(first), dtype=np.uint32)
    n[:-1], n[-1:] = first[1:], len(x)
    n -= first.astype(np.uint32)
    return x[first], n, at


def _chunks(chunk_bytes: int):
    """Packs a partition's texts, held-out ones apart, to rows of about ``chunk_bytes`` of text: a vocabulary and the words' numbers in it."""

    def pack(chunk: int, held: bool, ids: list, known: list, lens: list, hashes: list) -> pa.RecordBatch:
        every = [np.concatenate(hashes)]
        hashes.clear()
        words, n, number = _distinct(every)
        order = np.argsort(-n.astype(np.int64), kind="stable")
        rank = np.empty(len(words), dtype=np.uint32)
        rank[order] = np.arange(len(words))
        size = np.concatenate(lens)
        one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.cast(kind) if isinstance(x, pa.Array) else pa.array(x, kind))
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk]), pa.array([held]), pa.array([len(size)]), pa.array([int(size.sum()) + len(size)]), one(pa.concat_arrays(ids), pa.int64()), one(np.concatenate(known), pa.bool_()), one(size, pa.int32()), pa.array([words[order].tobytes()], pa.binary()), pa.array([_planes(rank[number])], pa.binary())],
            [c.split()[0] for c in _CHUNK.split(", ")],
        )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        open_: dict[bool, list] = {}
        for batch in batches:
            for b in slices(batch, "t"):
                held = b.column(3).to_numpy(zero_copy_only=False)
                for h in (False, True):
                    part = b if not h and not held.any() else b.filter(pa.array(held == h))
                    if not part.num_rows:
                        continue
                    have = open_.setdefault(h, [[], [], [], []])
                    for few in slices(part, "t", HASH_BYTES):
                        wh, wo = word_hashes(few.column(1))
                        for to, x in zip(have, (few.column(0), few.column(2).to_numpy(zero_copy_only=False), np.diff(wo), wh)):
                            to.append(x)
                    if sum(map(len, have[3])) * WORD_BYTES >= chunk_bytes:
                        yield pack(number, h, *open_.pop(h))
                        number += 1
        forget_powers()  # the worker goes on to other stages
        for h, have in open_.items():
            yield pack(number, h, *have)
            number += 1

    return chunks


class _Grams:
    """The n-grams of a chunk, one order after the other, as those of all orders take too much memory at once."""

    def __init__(self, row: dict) -> None:
        lens, words = np.asarray(row["lens"], dtype=np.int64), row.pop("words")
        self.so = np.append(0, np.cumsum(lens + 1))
        self.symbols = np.append(np.frombuffer(row["vocabulary"], _U) if len(words) else np.zeros(0, _U), _END)
        self.number = np.full(self.so[-1], len(self.symbols) - 1, dtype=np.uint32)
        if len(words):
            word = np.ones(len(self.number), dtype=bool)
            word[self.so[1:] - 1] = False
            self.number[word] = _numbers(words, "<u4")

    def of(self, k: int, places: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Of order k + 1: sorted distinct keys, their counts in the chunk, and the place of each symbol's n-gram among them."""
        return _distinct([gram_keys(self.number, self.symbols, self.so, k)], places)


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of keys begins, in sorted ones."""
    r = np.arange(ranges + 1, dtype=_U)
    return np.searchsorted(keys, ((r << _U(32)) + _U(ranges - 1)) // _U(ranges) << _U(24))


def _filled(answers: pa.Table, column: str, counts: np.ndarray, cut: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Counts of one order, replaced by the sums that came back; a range's keys are those of order 1, then of 2, then of 3.

    cut: where each range's keys begin in this order; before: how many keys of lower orders each range has.
    """
    for r, at, value in zip(answers.column("range").to_numpy(), answers.column("at"), answers.column(column)):
        at = np.cumsum(_numbers(at.as_buffer(), "<u4"), dtype=np.int64) - before[r]
        lo, hi = np.searchsorted(at, [0, cut[r + 1] - cut[r]])
        counts[at[lo:hi] + cut[r]] = _numbers(value.as_buffer(), "<i8")[lo:hi]
    return counts


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _count(ranges: int):
    """Every chunk's n-grams and counts, a row for each range of keys."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            g = _Grams(row)
            keys, n, _ = zip(*(g.of(k, places=False) for k in range(ORDER)))
            del g
            cuts = [_cuts(x, ranges) for x in keys]
            at = np.flatnonzero(sum(np.diff(c) for c in cuts))
            of = lambda values, i: _planes(np.concatenate([v[c[i] : c[i + 1]] for v, c in zip(values, cuts)]))
            for some in np.array_split(at, max(1, 12 * sum(map(len, keys)) // SEND_BYTES)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([row["chunk"]] * len(some), pa.int64()), pa.array([row["held"]] * len(some), pa.bool_()), pa.array([of(keys, i) for i in some], pa.binary()), pa.array([of(n, i) for i in some], pa.binary())],
                    [c.split()[0] for c in _COUNTS.split(", ")],
                )

    return count


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the counts of one range after the other, and gives each chunk those that other chunks have a share in.

    The row of chunk -1 is the range's number of distinct words.
    """
    kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
    message = lambda out: pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], [c.split()[0] for c in _TOTALS.split(", ")])
    for table in by_key(batches, ["range"], 1):
        number = table.column("range").to_numpy()
        starts = np.flatnonzero(np.diff(number, prepend=-1))
        for start, stop in zip(starts, np.append(starts[1:], len(number))):
            rows, r = table.slice(start, stop - start), int(number[start])
            chunks, helds = rows.column("chunk").to_pylist(), rows.column("held").to_pylist()
            ends = np.cumsum([len(x.as_buffer()) // 8 for x in rows.column("keys")])
            spans = list(zip(np.append(0, ends[:-1]), ends))
            keys, n = np.empty(ends[-1], dtype=_U), np.empty(ends[-1], dtype=np.uint32)
            for (lo, hi), k, c in zip(spans, rows.column("keys"), rows.column("counts")):
                keys[lo:hi], n[lo:hi] = _numbers(k.as_buffer(), "<u8"), _numbers(c.as_buffer(), "<u4")
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            new = _new(keys)
            words, first = int((new & (keys & _U(3) == 0)).sum()), np.flatnonzero(new)
            del keys
            group = _places(order, new)
            each = n[order]
            total = np.add.reduceat(each, first, dtype=np.int64)
            each[np.repeat(helds, np.diff(ends, prepend=0))[order]] = 0
            train = np.add.reduceat(each, first, dtype=np.int64)
            del each, first, order, new
            out, size = [(-1, r, False, b"", b"", b"", words)], 0
            for chunk, held, (lo, hi) in zip(chunks, helds, spans):
                t = total[group[lo:hi]]
                at = np.flatnonzero(t != n[lo:hi])
                out.append((chunk, r, held, _planes(np.diff(at, prepend=0).astype("<u4")), _planes(t[at]), _planes(train[group[lo:hi][at]]) if held else b"", 0))
                size += 12 * len(at)
                if size >= SEND_BYTES:
                    yield message(out)
                    out, size = [], 0
            if out:
                yield message(out)


def bucket(x: np.ndarray) -> np.ndarray:
    """0 for a context that wasn't seen, else 1 + floor(log2 count)."""
    return np.where(x > 0, 1 + np.floor(np.log2(np.maximum(x, 1))), 0).astype(np.int64).clip(0, BUCKETS - 1)


def _estimates(counts: list[np.ndarray], begins: int, so: np.ndarray, symbols: np.ndarray, lo: int, hi: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Maximum-likelihood estimates of orders 1 to 3 and the buckets of their contexts, for the symbols from lo to hi.

    counts: of the n-grams that end in each symbol. An n-gram was followed by a symbol as often as it occurred, as none
    goes on after an end symbol; so the context's count is that of the shorter n-gram one symbol before, and
    ``begins`` (texts) at a text's first symbol. symbols: of all texts, the context of order 1.
    """
    q, b = [], []
    starts = so[np.searchsorted(so, lo) : np.searchsorted(so, hi)] - lo
    for k in range(ORDER):
        x = symbols
        if k:
            x = counts[k - 1][lo - 1 : hi - 1].astype(np.int64) if lo else np.append(0, counts[k - 1][: hi - 1])
            x[starts] = begins
        q.append(counts[k][lo:hi] / np.maximum(x, 1))
        b.append(bucket(x))
    return q, b


def mixed(q: list[np.ndarray], b: list[np.ndarray], weights: np.ndarray, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Interpolated probability, and the share that each order (0: uniform) has in it.

    q, b: estimates and context buckets of orders 1 to 3; weights: orders x buckets; words: distinct ones.
    """
    rest = np.ones(len(q[0]))
    parts = []
    for k in range(ORDER - 1, -1, -1):
        lam = np.where(b[k] > 0, weights[k][b[k]], 0.0)
        parts.append(rest * lam * q[k])
        rest = rest * (1 - lam)
    parts.append(rest / (words + 1))
    return np.sum(parts, axis=0), parts[::-1]


def _held_cases(ranges: int, n_docs: int, n_symbols: int):
    """The distinct cases (estimates and buckets from the texts that aren't held out) of a held-out chunk's symbols, with how often each occurs."""

    def cases(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in _CASES.split(", ")]
        if not chunk.num_rows:
            return pa.table({n: pa.array([], pa.float64() if n[0] == "q" else pa.int64()) for n in names})
        g = _Grams(chunk.to_pylist()[0])
        train, before = [], np.zeros(ranges, dtype=np.int64)
        for k in range(ORDER):
            keys, _, at = g.of(k, places=True)
            cut = _cuts(keys, ranges)
            train.append(_narrow(_filled(answers, "train", np.zeros(len(keys), dtype=np.int64), cut, before))[at])
            before = before + np.diff(cut)
        parts = [[] for _ in range(2 + 2 * ORDER)]
        for lo in range(0, len(g.number), STEP):
            hi = min(lo + STEP, len(g.number))
            q, b = _estimates(train, n_docs, g.so, np.full(hi - lo, n_symbols), lo, hi)
            h = np.zeros(hi - lo, dtype=_U)
            for x in (*q, *b):
                h = mix(h * _U(3) + x.view(_U))
            h, first, n = np.unique(h, return_index=True, return_counts=True)
            for to, x in zip(parts, (h, n.astype(np.uint32), *(x[first] for k in range(ORDER) for x in (q[k], b[k].astype(np.uint8))))):
                to.append(x)
        del train, g
        h, first, at = np.unique(np.concatenate(parts.pop(0)), return_index=True, return_inverse=True)
        cols = [pa.array(np.bincount(at, np.concatenate(parts.pop(0))).astype(np.int64))]
        del h, at
        while parts:
            x = np.concatenate(parts.pop(0))[first]
            cols.append(pa.array(x.astype(np.int64) if x.dtype == np.uint8 else x))
        return pa.table(cols, names=names)

    return cases


def _by_text(at: np.ndarray, doc: np.ndarray, step: int) -> Iterator[np.ndarray]:
    """Parts of the places at (sorted) of about ``step``, which never split those of one text."""
    lo, of = 0, doc[at]
    while lo < len(at):
        hi = int(np.searchsorted(of, of[min(lo + step, len(at)) - 1], side="right"))
        yield at[lo:hi]
        lo = hi


def _score(ranges: int, n_docs: int, n_symbols: int, words: int, weights: np.ndarray):
    """Code length of each text of a chunk; its own n-grams are taken from the counts."""

    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "known": pa.array([], pa.bool_()), "n_words": pa.array([], pa.int64()), "bits": pa.array([], pa.float64())})
        row = chunk.to_pylist()[0]
        g = _Grams(row)
        size, before, others = np.diff(g.so), np.zeros(ranges, dtype=np.int64), []
        doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
        for k in range(ORDER):
            keys, n, at = g.of(k, places=True)
            cut, m = _cuts(keys, ranges), len(keys)
            del keys
            other = _filled(answers, "total", n.astype(np.int64), cut, before)[at]
            before = before + np.diff(cut)
            once = n[at] == 1
            other[once] -= 1  # these occur once in the chunk, so once in the text
            again = np.flatnonzero(~once)
            for some in _by_text(again, doc, STEP):
                _, pair, own = np.unique(doc[some].astype(np.int64) * m + at[some], return_inverse=True, return_counts=True)
                other[some] -= own[pair]
            others.append(_narrow(other))
            del other, again, at, n, once  # what an order took goes before the next one
        bits = np.empty(g.so[-1])
        for lo in range(0, len(bits), STEP):
            hi = min(lo + STEP, len(bits))
            q, b = _estimates(others, n_docs - 1, g.so, n_symbols - size[doc[lo:hi]], lo, hi)
            bits[lo:hi] = -np.log2(mixed(q, b, weights, words)[0])
        bits = np.add.reduceat(bits, g.so[:-1])
        return pa.table({"doc_id": pa.array(row["ids"], pa.int64()), "known": pa.array(row["known"], pa.bool_()), "n_words": pa.array(size), "bits": pa.array(bits)})

    return score


def _expect(weights: np.ndarray, words: int):
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, reached, bits = np.zeros((ORDER, BUCKETS)), np.zeros((ORDER, BUCKETS)), 0.0
        for batch in batches:
            n, *cols = [c.to_numpy() for c in batch.columns]
            q, b = cols[::2], cols[1::2]
            p, parts = mixed(q, b, weights, words)
            share = [n * x / p for x in parts]
            below = share[0]
            for k in range(ORDER):
                below = below + share[k + 1]
                used[k] += np.bincount(b[k], share[k + 1], BUCKETS)
                reached[k] += np.bincount(b[k], below, BUCKETS)
            bits -= float((n * np.log2(p)).sum())
        k, i = np.nonzero(reached)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(k, -1)), pa.array(np.append(i, 0)), pa.array(np.append(used[k, i], bits)), pa.array(np.append(reached[k, i], 0.0))], ["k", "b", "used", "reached"])

    return expect


def learn_weights(cases: DataFrame, words: int, rounds: int) -> np.ndarray:
    """Weights (orders x buckets) by expectation-maximisation on the held-out symbols."""
    weights = np.full((ORDER, BUCKETS), 0.5)  # stays where no held-out text has the bucket
    last = None
    for _ in range(rounds):
        sums = cases.mapInArrow(_expect(weights, words), "k long, b long, used double, reached double").groupBy("k", "b").agg(F.sum("used").alias("u"), F.sum("reached").alias("r")).collect()
        bits = sum(r["u"] for r in sums if r["k"] < 0)
        for r in sums:
            if r["k"] >= 0 and r["r"] > 0:
                weights[r["k"], r["b"]] = min(max(r["u"] / r["r"], 1e-6), 1 - 1e-6)
        if last is not None and last - bits <= 1e-4 * abs(last):
            break
        last = bits
    return weights


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_of: int = 10, rounds: int = 15, chunk_bytes: int = CHUNK_BYTES, range_keys: int = RANGE_KEYS) -> DataFrame:
    """How well a word trigram model of all other documents predicts each document.

    Returns ``doc_id, n_words, bits_per_word, perplexity``; n_words counts the text's words (runs of letters and digits,
    in lower case) and an end symbol. Words are compared by 64-bit hash, n-grams by one of 54 bits.

    Estimates: P_k = w_k(c) ML_k + (1 - w_k(c)) P_(k-1), where ML_k is the maximum-likelihood estimate of order k, c the
    bucket of its context's count (powers of two; an unseen context has weight 0) and P_0 uniform over the corpus's
    distinct words and one unknown. The weights w are learned by at most ``rounds`` rounds of expectation-maximisation
    on the n-grams of held-out texts (one of ``held_of``, by a hash of id and text) against counts of the others; a
    bucket that no held-out text has keeps 1/2. A score then uses the counts of all texts but the document itself:
    as a text helps predict itself whatever it says, its own n-grams are deleted. So a document that occurs twice is
    nearly free, and one unlike all others is dear.

    Plan: texts become chunks of about ``chunk_bytes``, written to the shared folder. Each sends its distinct
    n-grams with counts, a message for each range of keys; a range's counts are added up and go back to the chunks for those
    n-grams that other chunks have too. What moves grows with the distinct n-grams of the chunks, texts don't move,
    a frequent n-gram is one number a chunk, and workers hold a chunk or a range of about ``range_keys`` n-grams.

    Nulls: a null id stays null; a null text has null results and isn't counted; an empty text, or one without words, is
    its end symbol. A text larger than a chunk is a chunk of its own. Ties don't occur; repeated rows are counted and
    scored each. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    t, i = F.col(f"`{text_col}`"), F.col(f"`{id_col}`").cast("long")
    source = docs.select(i.alias("id"), t.alias("t"), t.isNotNull().alias("k"), (t.isNotNull() & (F.pmod(F.xxhash64(i, t), F.lit(held_of)) == 0)).alias("h"))
    nothing = source.where(~F.col("k")).select(F.col("id").alias("doc_id"), F.lit(None).cast("long").alias("n_words"), F.lit(None).cast("double").alias("bits_per_word"), F.lit(None).cast("double").alias("perplexity"))
    texts = source.where("k").select("id", F.lower("t").alias("t"), "k", "h")
    chunks = checkpointed(texts.mapInArrow(_chunks(chunk_bytes), _CHUNK), "chunks", compression="zstd")
    sizes = {r["held"]: (r["d"], r["n"]) for r in chunks.groupBy("held").agg(F.sum("n_docs").alias("d"), F.sum("n_symbols").alias("n")).collect()}
    (train_docs, train_symbols), (held_docs, held_symbols) = sizes.get(False, (0, 0)), sizes.get(True, (0, 0))
    n_docs, n_symbols, n = train_docs + held_docs, train_symbols + held_symbols, shuffle_partitions(spark)
    ranges = max(4 * n, -(-2 * n_symbols // range_keys))
    counts = chunks.mapInArrow(_count(ranges), _COUNTS).repartition(n, "range").sortWithinPartitions("range")
    totals = checkpointed(counts.mapInArrow(_total, _TOTALS), "totals", compression="zstd")
    words = totals.where("chunk < 0").agg(F.sum("n_words")).first()[0] or 0
    answers = totals.where("chunk >= 0").drop("n_words")
    held = chunks.where("held").groupBy("chunk").cogroup(answers.where("held").groupBy("chunk"))
    cases = checkpointed(held.applyInArrow(_held_cases(ranges, train_docs, train_symbols), _CASES), "cases")
    weights = learn_weights(cases, words, rounds)
    out = chunks.groupBy("chunk").cogroup(answers.drop("train").groupBy("chunk")).applyInArrow(_score(ranges, n_docs, n_symbols, words, weights), _SCORES)
    mean = F.col("bits") / F.col("n_words")
    return out.select("doc_id", "n_words", mean.alias("bits_per_word"), F.pow(F.lit(2.0), mean).alias("perplexity")).unionByName(nothing)
