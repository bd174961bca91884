"""MinHash signatures, banding, and the ways to remove near duplicates.

A document is dropped for a candidate: another document with an equal band of minima (``mode collision``),
or one whose estimated similarity also reaches the threshold (``mode verified``). All rules name the order
in which documents come; the order of input files is no order.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sized_slices
from ..sources.storage import stored

_U = np.uint64
PRIME = (1 << 31) - 1
#: Minimum of a text without shingles: all such texts are candidates of each other.
NO_SHINGLE = PRIME


def coefficients(perms: int, seed: int = 1) -> list[tuple[int, int]]:
    """Multipliers and offsets of the permutations x -> (a x + b) mod 2^31 - 1."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(perms)]


def optimal_bands(threshold: float, perms: int, steps: int = 200) -> tuple[int, int]:
    """Bands and rows that make the areas of false positives and false negatives least, weighed equally."""
    best = (float("inf"), 1, 1)
    grid = [(i + 0.5) / steps for i in range(steps)]
    for b in range(1, perms + 1):
        for r in range(1, perms // b + 1):
            error = sum(1 - (1 - s**r) ** b if s < threshold else (1 - s**r) ** b for s in grid) / steps
            best = min(best, (error, b, r))
    return best[1], best[2]


def signatures(docs: DataFrame, keys: list[str], text: str, perms: int = 256, n: int = 5, seed: int = 1, min_shingles: int = 0) -> DataFrame:
    """``keys, sig``: minima of the permuted 28-bit hashes of all character n-grams.

    Minima are made in Arrow batches, with matrices of n-grams by permutations. What is shuffled is the text, so that all
    texts of a key are at one place. min_shingles: texts of fewer are left out, and so is a key without any other.
    """
    # a number of partitions that is asked for stays: minima are work for all cores, however few bytes the texts are
    spark = docs.sparkSession
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    placed = docs.select(*keys, F.col(text).alias("_text")).repartition(tasks, *keys)
    own = placed.groupBy(*keys).agg(F.collect_list("_text").alias("_t"))
    kinds = ", ".join(f"`{k}` {kind}" for k, kind in own.dtypes[: len(keys)])
    return own.mapInArrow(_minima(coefficients(perms, seed), n, min_shingles), f"{kinds}, sig array<long>")


#: n-grams of which a worker keeps what it knows, and n-grams of one matrix.
KEPT_GRAMS, MATRIX_ROWS = 1 << 19, 512
#: Characters whose n-grams are sorted at once; the binary logarithm of the number of n-grams from which on a row's minima are looked
#: for among small values only; and how many values below that bound such a row has for a permutation, on average, at least.
CHUNK_CHARS, LARGE, EXPECTED = 3 << 20, 9, 8
#: Bits of a sign's number in a key, and the most n-grams of a row as a power of 2.
SIGN_BITS, MOST = 12, 24


def permuted(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(a h + b) mod 2^31 - 1: a row for each h (28 bits), a column for each permutation."""
    x = h[:, None] * a
    x += b
    y = x >> _U(31)
    x &= _U(PRIME)
    x += y  # below 2^31 - 1 + 2^29: the prime is to be taken off once at most
    z = x.astype(np.uint32)
    return np.minimum(z, z - np.uint32(PRIME), out=z)  # what would be negative is large


def minima(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least (a h + b) mod 2^31 - 1 over all h (28 bits) for each permutation."""
    out = np.full(len(a), NO_SHINGLE, dtype=np.uint32)
    for i in range(0, len(h), MATRIX_ROWS):
        np.minimum(out, permuted(h[i : i + MATRIX_ROWS], a, b).min(axis=0), out=out)
    return out


class _Grams:
    """What a worker keeps of n-grams: the first 28 bits of their md5, and the permutations that give them small values.

    Of n-gram i, ``perm`` and ``value`` have from ``first[i]`` on the values in rising order; ``below[k, i]`` of them are small
    enough for rows of 2^(k + LARGE) n-grams.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, n: int) -> None:
        self.a, self.b, self.n = a, b, n
        self.bounds = np.array([min(PRIME, PRIME * EXPECTED >> k) for k in range(LARGE, MOST + 1)], dtype=np.uint32)
        self.clear()

    def clear(self) -> None:
        self.code, self.signs, self.passing = np.zeros(0x110000, dtype=np.uint16), 0, False
        self.keys, self.ids, self.h = np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=_U)
        self.first, self.perm, self.value = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint16), np.zeros(0, dtype=np.uint32)
        self.below = np.zeros((len(self.bounds), 0), dtype=np.uint16)

    def find(self, signs: np.ndarray) -> np.ndarray:
        """Numbers of distinct n-grams, a row of code points each; those that aren't known are added."""
        chars = np.unique(signs)
        unseen = chars[self.code[chars] == 0]
        if self.passing or self.signs + len(unseen) >= 1 << SIGN_BITS or len(self.h) > KEPT_GRAMS:
            self.clear()
            unseen = chars
        if len(unseen) >= 1 << SIGN_BITS or SIGN_BITS * self.n > 63:  # keys don't fit a number: nothing is kept
            self.passing = True
            return self._add(signs)
        self.code[unseen] = np.arange(self.signs + 1, self.signs + 1 + len(unseen))
        self.signs += len(unseen)
        key = np.zeros(len(signs), dtype=_U)
        for j in range(self.n):
            key = (key << _U(SIGN_BITS)) | self.code[signs[:, j]].astype(_U)
        at = np.searchsorted(self.keys, key)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == key if len(self.keys) else np.zeros(len(key), dtype=bool)
        out = np.empty(len(key), dtype=np.int64)
        out[known] = self.ids[at[known]]
        if not known.all():
            out[~known] = new = self._add(signs[~known])
            keys, ids = np.append(self.keys, key[~known]), np.append(self.ids, new)
            order = np.argsort(keys)
            self.keys, self.ids = keys[order], ids[order]
        return out

    def _add(self, signs: np.ndarray) -> np.ndarray:
        text, n = signs.astype("<u4").tobytes().decode("utf-32-le"), self.n
        h = np.fromiter((int(md5(text[i : i + n].encode()).hexdigest()[:7], 16) for i in range(0, len(text), n)), _U, len(signs))
        found = []
        for i in range(0, len(h), MATRIX_ROWS):
            v = permuted(h[i : i + MATRIX_ROWS], self.a, self.b).ravel()
            cell = np.flatnonzero(v < self.bounds[0])
            found.append((cell // len(self.a) + i, cell % len(self.a), v[cell]))
        g, p, v = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((v, g))
        g, p, v = g[order], p[order], v[order]
        below = np.stack([np.bincount(g[v < t], minlength=len(h)) for t in self.bounds]).astype(np.uint16)
        numbers = np.arange(len(self.h), len(self.h) + len(h))
        self.h = np.append(self.h, h)
        self.first = np.append(self.first, self.first[-1] + np.cumsum(below[0], dtype=np.int64))
        self.perm, self.value = np.append(self.perm, p.astype(np.uint16)), np.append(self.value, v)
        self.below = np.concatenate([self.below, below], axis=1)
        return numbers


def _distinct(texts: list[str], rows: list[int], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams as rows of code points, and (row, n-gram's place there) for those of each row, in the order of rows; rows ascend."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    seen = np.zeros(0x110000, dtype=bool)
    seen[chars] = True
    alphabet = np.flatnonzero(seen)
    bits = max(1, (len(alphabet) - 1).bit_length())
    number, local = np.unique(rows, return_inverse=True)
    if bits * n + int(local[-1]).bit_length() > 63:  # too many different signs for one number
        pairs = sorted({(r, t[j : j + n]) for r, t in zip(rows, texts) for j in range(len(t) - n + 1)})
        known = {g: i for i, g in enumerate(dict.fromkeys(g for _, g in pairs))}
        signs = np.frombuffer("".join(known).encode("utf-32-le"), "<u4").reshape(-1, n)
        return signs, np.array([r for r, _ in pairs], dtype=np.int64), np.array([known[g] for _, g in pairs], dtype=np.int64)
    m = max(0, len(chars) - n + 1)
    table = np.zeros(0x110000, dtype=np.uint32)
    table[alphabet] = np.arange(len(alphabet))
    code = table[chars].astype(_U)
    key = np.repeat(local.astype(_U), lens)[:m]
    for j in range(n):
        key <<= _U(bits)
        key |= code[j : j + m]
    whole, ends = np.ones(len(chars), dtype=bool), np.cumsum(lens)
    for j in range(1, n):  # none begins so near the end of its text
        at = ends - j
        whole[at[at >= ends - lens]] = False
    key = key[whole[:m]]
    key.sort()
    key = key[np.append(True, key[1:] != key[:-1])]
    row = number[(key >> _U(bits * n)).astype(np.int64)]
    key &= _U((1 << bits * n) - 1)
    grams = np.sort(key)
    grams = grams[np.append(True, grams[1:] != grams[:-1])]
    signs = np.stack([alphabet[((grams >> _U(bits * (n - 1 - j))) & _U((1 << bits) - 1)).astype(np.int64)] for j in range(n)], axis=1)
    return signs, row, np.searchsorted(grams, key)


def _small_rows(out: np.ndarray, at: np.ndarray, starts: np.ndarray, sizes: np.ndarray, gram: np.ndarray, ids: np.ndarray, known: _Grams) -> None:
    """Minima of rows (at) with few n-grams: the j-th n-grams of a block of rows at once, longest rows first."""
    order = np.argsort(-sizes, kind="stable")
    at, starts, sizes = at[order], starts[order], sizes[order]
    used = np.zeros(len(ids), dtype=bool)
    used[gram[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]] = True
    own = np.flatnonzero(used)
    number = np.zeros(len(ids), dtype=np.int64)
    number[own] = np.arange(len(own))
    place = number[gram]
    h, perms = known.h[ids[own]], len(known.a)
    width = max(16, min(perms, (1 << 24) // len(own)))
    for c in range(0, perms, width):
        a, b = known.a[c : c + width], known.b[c : c + width]
        values = np.concatenate([permuted(h[i : i + MATRIX_ROWS], a, b) for i in range(0, len(own), MATRIX_ROWS)])
        step = max(64, (1 << 16) // width)
        for lo in range(0, len(at), step):
            s, k = starts[lo : lo + step], sizes[lo : lo + step]
            least = values.take(place[s], axis=0)
            longer = np.searchsorted(-k, -np.arange(int(k[0])))  # rows with more than j
            for j in range(1, int(k[0])):
                n = longer[j]
                np.minimum(least[:n], values.take(place[s[:n] + j], axis=0), out=least[:n])
            rows = at[lo : lo + step]
            out[rows, c : c + width] = np.minimum(out[rows, c : c + width], least)


def _large_rows(out: np.ndarray, at: np.ndarray, starts: np.ndarray, sizes: np.ndarray, gram: np.ndarray, ids: np.ndarray, known: _Grams) -> None:
    """Minima of rows (at) with many n-grams. Of n-grams only the permutations are looked at that give them a value so small that a
    row of this size has ``EXPECTED`` such values; where a row has none for a permutation, all its n-grams are gone through.
    """
    perms, kind = len(known.a), np.minimum(np.log2(sizes).astype(np.int64), MOST) - LARGE
    for k in np.unique(kind).tolist():
        chosen = np.flatnonzero(kind == k)
        for lo in range(0, len(chosen), 128):
            rows = chosen[lo : lo + 128]
            ks = sizes[rows]
            own = ids[gram[np.repeat(starts[rows] - (np.cumsum(ks) - ks), ks) + np.arange(ks.sum())]]
            n = known.below[k, own].astype(np.int64)
            place = np.repeat(known.first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            least = np.full(len(rows) * perms, NO_SHINGLE, dtype=np.uint32)
            np.minimum.at(least, np.repeat(np.repeat(np.arange(len(rows)) * perms, ks), n) + known.perm[place], known.value[place])
            for cell in np.flatnonzero(least == NO_SHINGLE).tolist():
                r, c = divmod(cell, perms)
                least[cell] = minima(known.h[ids[gram[starts[rows[r]] : starts[rows[r]] + ks[r]]]], known.a[c : c + 1], known.b[c : c + 1])[0]
            out[at[rows]] = np.minimum(out[at[rows]], least.reshape(len(rows), perms))


def all_minima(texts: list[list[str]], known: _Grams) -> np.ndarray:
    """A row of minima for each list of texts, over the n-grams of all of them. Long texts are gone through in overlapping pieces."""
    n = known.n
    out = np.full((len(texts), len(known.a)), NO_SHINGLE, dtype=np.uint32)

    def add(pieces: list[str], rows: list[int]) -> None:
        signs, row, gram = _distinct(pieces, rows, n)
        ids = known.find(signs)
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        sizes = np.diff(np.append(starts, len(row)))
        for part, f in ((sizes < 1 << LARGE, _small_rows), (sizes >= 1 << LARGE, _large_rows)):
            if part.any():
                f(out, row[starts[part]], starts[part], sizes[part], gram, ids, known)

    pieces, rows, held = [], [], 0
    for i, own in enumerate(texts):
        for t in own:
            for lo in range(0, max(0, len(t) - n + 1), CHUNK_CHARS):
                piece = t[lo : lo + CHUNK_CHARS + n - 1]
                if pieces and held + len(piece) > CHUNK_CHARS:
                    add(pieces, rows)
                    pieces, rows, held = [], [], 0
                pieces.append(piece)
                rows.append(i)
                held += len(piece)
    if pieces:
        add(pieces, rows)
    return out


#: A worker's n-grams by permutations and n: they outlive a task.
_KNOWN: dict[tuple, _Grams] = {}


def _minima(permutations: list[tuple[int, int]], n: int, min_shingles: int):
    key = (*permutations, n)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _KNOWN:
            _KNOWN.clear()
            _KNOWN[key] = _Grams(*(np.array(c, dtype=_U) for c in zip(*permutations)), n)
        known = _KNOWN[key]
        for batch in batches:
            for part in sized_slices(batch):
                texts = part.column(part.num_columns - 1).to_pylist()
                if min_shingles:
                    texts = [[t for t in own if len({t[j : j + n] for j in range(len(t) - n + 1)}) >= min_shingles] for own in texts]
                kept = [i for i, own in enumerate(texts) if own or not min_shingles]
                if kept:
                    sigs = all_minima([texts[i] for i in kept], known)
                    sig = pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1, dtype=np.int32) * len(permutations)), pa.array(sigs.ravel().astype(np.int64)))
                    yield pa.RecordBatch.from_arrays([*(c.take(pa.array(kept)) for c in part.columns[:-1]), sig], [*part.schema.names[:-1], "sig"])

    return signed


def _bands(b: int, r: int):
    return F.array(*(F.struct(F.lit(i).alias("band"), F.md5(F.array_join(F.slice("sig", i * r + 1, r).cast("array<string>"), ",")).alias("hash")) for i in range(b)))


def bands(sigs: DataFrame, keys: list[str], b: int, r: int) -> DataFrame:
    """``keys, band, hash``: a row for each of the b bands of r minima."""
    return sigs.select(*keys, F.inline(_bands(b, r)))


def hashed(sigs: DataFrame, keys: list[str], b: int, r: int) -> DataFrame:
    """``keys, _g``: 64-bit hashes of the b bands of r minima, in place of the signatures, which are much larger."""
    return sigs.select(*keys, F.array(*(F.xxhash64(F.lit(i), F.slice("sig", i * r + 1, r)) for i in range(b))).alias("_g"))


def similarity(x, y):
    """Part of the minima that agree."""
    return F.size(F.filter(F.zip_with(x, y, lambda p, q: p == q), lambda e: e)) / F.size(x)


def _verified(pairs: DataFrame, left: DataFrame, right: DataFrame, threshold: float | None) -> DataFrame:
    if threshold is None:
        return pairs
    both = pairs.join(left.select(F.col("id").alias("a"), F.col("sig").alias("_x")), "a").join(right.select(F.col("id").alias("b"), F.col("sig").alias("_y")), "b")
    return both.where(similarity(F.col("_x"), F.col("_y")) >= threshold).select("a", "b")


#: Members of one kind of signature whose pairs are made in one row.
BLOCK = 256


def pairs(sigs: DataFrame, b: int, r: int, threshold: float | None = None, other_doc: str | None = None) -> DataFrame:
    """All candidate pairs ``a, b`` (a < b) of signatures with an ``id``. other_doc: pairs within one document are left out.

    Signatures that are equal (without a threshold: in all bands) have the same candidates. One of them is searched for all,
    and its pairs are expanded afterwards, from pairs of blocks of ``BLOCK`` members, which are spread over all tasks.
    """
    keys = ["id"] + ([other_doc] if other_doc else [])
    if threshold is None:
        rows = hashed(sigs, keys, b, r)
    else:
        rows = hashed(sigs, [*keys, "sig"], b, r)
    kind = F.xxhash64("_g" if threshold is None else "sig").alias("_kind")
    rows = stored(rows.select("*", kind), "signatures")
    kinds = rows.groupBy("_kind").agg(F.count(F.lit(1)).alias("_n"), *(F.first(c).alias(c) for c in rows.columns if c in ("_g", "sig")))
    banded = kinds.select("_kind", F.explode("_g").alias("g"))
    x, y = (banded.withColumnRenamed("_kind", c) for c in ("a", "b"))
    found = x.join(y, "g").where("a < b").select("a", "b").distinct()
    if threshold is not None:
        each = kinds.select(F.col("_kind").alias("id"), "sig")
        found = _verified(found, each, each, threshold)
    found = found.unionByName(kinds.where("_n > 1").select(F.col("_kind").alias("a"), F.col("_kind").alias("b")))
    member = F.struct("id", *([F.col(other_doc).alias("doc")] if other_doc else []))
    size = kinds.select("_kind", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"))
    blocks = rows.join(size, "_kind").groupBy("_kind", F.pmod(F.xxhash64("id"), F.col("_blocks")).alias("_i")).agg(F.collect_list(member).alias("_m"))
    blocks = stored(blocks, "blocks")
    left, right = (blocks.select(F.col("_kind").alias(c), F.col("_i").alias(f"_i{c}"), F.col("_m").alias(f"_m{c}")) for c in ("a", "b"))
    each = found.join(left, "a").join(right, "b").where("a <> b or _ia <= _ib")
    tasks = int(sigs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = each.repartition(tasks).select("a", "b", "_ia", "_ib", "_mb", F.explode("_ma").alias("_x")).select("a", "b", "_ia", "_ib", "_x", F.explode("_mb").alias("_y"))
    each = each.where("a <> b or _ia <> _ib or _x.id < _y.id")
    if other_doc:
        each = each.where("_x.doc <> _y.doc")
    return each.select(F.least("_x.id", "_y.id").alias("a"), F.greatest("_x.id", "_y.id").alias("b"))


def cross(sigs: DataFrame, others: DataFrame, b: int, r: int, threshold: float | None = None) -> DataFrame:
    """Ids without a candidate among the others.

    Only distinct bands of the others are joined, so that many copies there cost one.
    """
    if threshold is None:
        return _cross(stored(hashed(sigs, ["id"], b, r), "bands"), hashed(others, [], b, r)).select("id")
    sigs = stored(sigs, "signatures")
    own = bands(sigs, ["id"], b, r)
    them = bands(others, ["id"], b, r).select(F.col("id").alias("b"), "band", "hash")
    hit = _verified(own.select(F.col("id").alias("a"), "band", "hash").join(them, ["band", "hash"]).select("a", "b").distinct(), sigs, others, threshold).select(F.col("a").alias("id"))
    return sigs.select("id").join(hit.distinct(), "id", "left_anti")


def _cross(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Rows (``id, _g``) of which no band is among those of others (``_g``)."""
    hit = rows.select("id", F.explode("_g").alias("g")).join(others.select(F.explode("_g").alias("g")).distinct(), "g", "left_semi")
    return rows.join(hit.select("id").distinct(), "id", "left_anti")


def later_batch_wins(sigs: DataFrame, b: int, r: int, batch: str = "batch") -> DataFrame:
    """Keep-first within each batch, then what is left of a batch loses documents with a candidate in what is left of a later one.

    For each band the last batch that has it decides: no pairs are made.
    """
    rows = stored(hashed(sigs, ["id", batch], b, r), "bands")
    return _by_batch(stored(_keep_first(rows, batch), "bands"), batch, F.max, lambda own, best: best > own)


def batch_chain(sigs: DataFrame, b: int, r: int, batch: str = "batch") -> DataFrame:
    """Batch after batch, without candidates among what was kept of the earlier batches; candidates within a batch stay.

    Unlike :func:`cumulative`, a document that was removed removes no other. A document stands against its whole batch: one
    round decides all batches without an undecided earlier one in any of their bands, and ends in a written table.
    """
    rows = stored(hashed(sigs, ["id", batch], b, r).select("id", F.col(batch).alias("_batch"), F.explode("_g").alias("g")), "bands")
    kept = None
    while not rows.isEmpty():
        first = rows.groupBy("g").agg(F.min("_batch").alias("_first"))
        least = rows.join(first, "g").groupBy("id").agg(F.max((F.col("_batch") > F.col("_first")).cast("int")).alias("_waits"))
        now = stored(least.where("_waits = 0").select("id"), "kept")
        held = rows.join(now, "id", "left_semi").groupBy("g").agg(F.min("_batch").alias("_kept"))
        gone = rows.join(held, "g").where(F.col("_batch") > F.col("_kept")).select("id").distinct()
        kept = now if kept is None else kept.unionByName(now)
        rows = stored(rows.join(now.unionByName(gone).distinct(), "id", "left_anti"), "bands")
    return sigs.select("id").limit(0) if kept is None else kept


def cumulative(sigs: DataFrame, b: int, r: int, batch: str = "batch") -> DataFrame:
    """Ids without a candidate in an earlier batch, whatever became of it there; see :func:`batch_chain` for the other rule."""
    return _by_batch(stored(hashed(sigs, ["id", batch], b, r), "bands"), batch, F.min, lambda own, best: best < own)


def _by_batch(rows: DataFrame, batch: str, pick, beats) -> DataFrame:
    """Ids of rows (``id, batch, _g``) none of whose bands belongs to a batch that beats theirs."""
    banded = rows.select("id", batch, F.explode("_g").alias("g"))
    best = banded.groupBy("g").agg(pick(batch).alias("_best"))
    hit = banded.join(best, "g").where(beats(F.col(batch), F.col("_best"))).select("id").distinct()
    return rows.select("id").join(hit, "id", "left_anti")


def greedy(edges: DataFrame) -> DataFrame:
    """Dropped nodes of keep-first: in order, a node goes if an earlier neighbour was kept.

    edges ``a, b``: b comes after a. In each round nodes without an earlier undecided neighbour are kept and
    their neighbours dropped. Rounds are as many as the longest chain of decisions; each ends in a written table.
    """
    now = stored(edges.select("a", "b").distinct(), "edges")
    dropped = None
    while not now.isEmpty():
        kept = now.select(F.col("a").alias("n")).distinct().join(now.select(F.col("b").alias("n")).distinct(), "n", "left_anti")
        gone = stored(now.join(kept, now["a"] == kept["n"], "left_semi").select(F.col("b").alias("n")).distinct(), "dropped")
        dropped = gone if dropped is None else dropped.unionByName(gone)
        left = now.join(kept, now["a"] == kept["n"], "left_anti").join(gone, now["b"] == gone["n"], "left_anti")
        now = stored(left.join(gone.withColumnRenamed("n", "m"), left["a"] == F.col("m"), "left_anti"), "edges")
    return edges.select(F.col("b").alias("n")).limit(0) if dropped is None else dropped


def keep_first(banded: DataFrame) -> DataFrame:
    """``n, rep``: what keep-first drops, and the least kept candidate that it was dropped for.

    banded ``id, g``: ids that share a g are candidates. No pairs are made: in each round the ids that are the least
    undecided one in all of their g are kept, and the others of those g dropped. Rounds end in written tables.
    """
    rows = stored(banded.select("id", "g").distinct(), "bands")
    dropped = None
    while not rows.isEmpty():
        first = rows.groupBy("g").agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")  # alone in a g: no candidate there
        contested = stored(rows.join(first, "g").select("id", "g", "_first"), "bands")
        heads = contested.groupBy("id").agg(F.min((F.col("id") == F.col("_first")).cast("int")).alias("_all")).where("_all = 1").select(F.col("id").alias("_first"))
        gone = stored(contested.where(F.col("id") != F.col("_first")).join(heads, "_first").groupBy("id").agg(F.min("_first").alias("rep")).select(F.col("id").alias("n"), "rep"), "dropped")
        dropped = gone if dropped is None else dropped.unionByName(gone)
        decided = gone.select("n").unionByName(heads.select(F.col("_first").alias("n")))
        rows = stored(contested.join(decided.distinct(), contested["id"] == F.col("n"), "left_anti").select("id", "g"), "bands")
    return banded.select(F.col("id").alias("n"), F.col("id").alias("rep")).limit(0) if dropped is None else dropped


def self_dedup(sigs: DataFrame, b: int, r: int, threshold: float | None = None, within: str | None = None) -> DataFrame:
    """Ids kept by keep-first in the order of ids. within: a column; only equal values of it are candidates.

    Texts with equal signatures are each other's candidates and have the same others, so the first stands for all.
    """
    own = [within] if within else []
    if threshold is None:
        return _keep_first(hashed(sigs, ["id", *own], b, r), within).select("id")
    first = stored(sigs.groupBy("sig", *own).agg(F.min("id").alias("id")).select("id", "sig", *own), "signatures")
    gone = greedy(pairs(first, b, r, threshold)).withColumnRenamed("n", "id")
    return first.select("id").join(gone, "id", "left_anti")


def _keep_first(rows: DataFrame, within: str | None = None) -> DataFrame:
    """The rows (``id, _g`` and ``within``) that keep-first keeps; of those equal in all bands only the first is looked at."""
    own = [within] if within else []
    first = stored(rows.groupBy("_g", *own).agg(F.min("id").alias("id")).select("id", *own, "_g"), "signatures")
    banded = first.select("id", *own, F.explode("_g").alias("g")).select("id", (F.xxhash64(within, "g") if within else F.col("g")).alias("g"))
    return first.join(keep_first(banded).select(F.col("n").alias("id")), "id", "left_anti")


def incremental_dedup(sigs: DataFrame, seeds: DataFrame, b: int, r: int) -> DataFrame:
    """Ids kept by keep-first after earlier documents (seeds) that stay: those with a candidate among them go first."""
    return _keep_first(_cross(stored(hashed(sigs, ["id"], b, r), "bands"), hashed(seeds, [], b, r))).select("id")


def apply_result(docs: DataFrame, kept: DataFrame, key: str | list[str] = "id") -> DataFrame:
    """Documents whose key (one column, or file and id) survived."""
    keys = [key] if isinstance(key, str) else key
    return docs.join(kept.select(*keys).distinct(), keys, "left_semi")


def at_positions(sigs: DataFrame, numbers: DataFrame, order: str = "id") -> DataFrame:
    """Rows at the given line numbers (from 1, column ``n``) in the order of ``order``."""
    from .sampling import numbered

    return numbered(sigs, [order], "_n").join(numbers.select(F.col("n").alias("_n")).distinct(), "_n", "left_semi").withColumnRenamed("_n", "n")
