"""Operator 7: near-duplicate groups by b-bit MinHash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_key, checkpointed, keyed_text, shuffle_partitions
from .components import components
from .textkernel import kgrams, mix, slices, word_hashes

_U = np.uint64


def minima(wh: np.ndarray, wo: np.ndarray, k: int, perms: int, seed: int = 1) -> np.ndarray:
    """32-bit minima (documents x perms) of the word k-grams; a document of fewer words is one gram.

    Rows of documents without words are all ones.
    """
    lens = np.diff(wo)
    h, _, ko = kgrams(wh, wo, k)
    counts = np.diff(ko)
    for n in range(1, k):  # short documents: one gram of all their words
        some = np.flatnonzero(lens == n)
        if len(some):
            g = mix(np.add.reduce([wh[wo[some] + i] * _U(2 * i + 3) for i in range(n)], axis=0) + _U(n))
            h = np.insert(h, ko[some], g)
            counts[some] = 1
            ko = np.concatenate([[0], np.cumsum(counts)])
    out = np.full((len(lens), perms), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(counts > 0)
    if not len(full):
        return out
    x = (h >> _U(32)).astype(np.uint32)
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 31, perms, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    c = rng.integers(0, 1 << 32, perms, dtype=np.uint32)
    v = np.empty(len(x), dtype=np.uint32)
    starts = ko[:-1][full]
    step = 1 << 16  # values that stay in the cache while all permutations go over them
    cut = [0]
    while cut[-1] < len(full):
        cut.append(max(cut[-1] + 1, int(np.searchsorted(starts, starts[cut[-1]] + step, side="right")) - 1 if starts[-1] > starts[cut[-1]] + step else len(full)))
    for lo, hi in zip(cut, cut[1:]):
        s, e = starts[lo], (starts[hi] if hi < len(full) else len(x))
        part, to, at = x[s:e], v[: e - s], starts[lo:hi] - s
        res = np.empty((perms, hi - lo), dtype=np.uint32)
        for j in range(perms):
            np.multiply(part, a[j], out=to)
            np.add(to, c[j], out=to)
            np.minimum.reduceat(to, at, out=res[j])
        out[full[lo:hi]] = res.T
    return out


def pack(low: np.ndarray, b: int) -> np.ndarray:
    """Packs b-bit values (documents x perms, b in 1, 2, 4, 8) into bytes."""
    per = 8 // b
    out = np.zeros((low.shape[0], low.shape[1] // per), dtype=np.uint8)
    for i in range(per):
        out |= low[:, i::per].astype(np.uint8) << np.uint8(b * i)
    return out


def similarity(x: np.ndarray, y: np.ndarray, b: int) -> np.ndarray:
    """Estimated Jaccard similarity of rows of packed signatures, corrected for the 2^-b chance matches.

    Values differ where any of their b bits does; the differing bits of each value are folded into its
    lowest one and counted.
    """
    z = x ^ y
    for s in (4, 2, 1):
        if s < b:
            z |= z >> np.uint8(s)
    z &= np.uint8({1: 0xFF, 2: 0x55, 4: 0x11, 8: 0x01}[b])
    perms = x.shape[1] * 8 // b
    if z.shape[1] % 8 == 0:
        z = np.ascontiguousarray(z).view(_U)
    matched = 1.0 - np.bitwise_count(z).sum(axis=1, dtype=np.int64) / perms
    chance = 0.5**b
    return (matched - chance) / (1 - chance)


def _sign(k: int, perms: int, b: int, bands: int):
    rows = perms // bands

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(rows)], dtype=_U)
        for batch in batches:
            for s in slices(batch, "t"):
                wh, wo = word_hashes(s.column(1))
                m = minima(wh, wo, k, perms)
                has = np.flatnonzero(np.diff(wo) > 0)
                if not len(has):
                    continue
                mixed = mix(m[has].astype(_U) + (np.arange(perms, dtype=_U) << _U(32)))
                bh = mix((mixed.reshape(len(has), bands, rows) * weights).sum(axis=2, dtype=_U))
                odd = np.arange(bands, dtype=_U) * _U(2) + _U(1)
                whole = [mix((bh * (odd * _U(c))).sum(axis=1, dtype=_U)) for c in (0x632BE59BD9B4E019, 0xD6E8FEB86659FD93)]
                packed = pack((mixed & _U((1 << b) - 1)).astype(np.uint8), b)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(has) + 1, dtype=np.int32) * bands), pa.array(bh.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([s.column(0).take(pa.array(has)), pa.array(whole[0].view(np.int64)), pa.array(whole[1].view(np.int64)), _binary(packed), lists], ["id", "w0", "w1", "sig", "bands"])

    return sign


def _binary(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1, dtype=np.int32) * width).tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(column.buffers()[2], np.uint8, width * len(column), width * column.offset).reshape(-1, width)


#: Documents of a band that one task compares with each other; the pairs of larger bands are compared in blocks. Both find the same groups.
HOT = 1000
#: Documents of a block.
BLOCK = 1 << 14
#: First unlike documents of a large band that all its documents are compared with.
LEADERS = 64
#: Chance that a similar pair shares none of the parts into which a large band is split.
MISS = 1e-4


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the bands that hold two documents or more, with the row's number in its band. Holds one record batch and a row."""
    held, number = None, 0  # the last row, which may be alone in its band
    for b in batches:
        if not b.num_rows:
            continue
        band, ids = b.column("band").to_numpy(), b.column("id").to_numpy()
        if held is not None:
            band, ids = np.concatenate([[held[0]], band]), np.concatenate([[held[1]], ids])
        new = np.concatenate([[True], band[1:] != band[:-1]])
        first = np.flatnonzero(new)
        n = np.arange(len(band)) - first[np.cumsum(new) - 1]
        n[: first[1] if len(first) > 1 else len(n)] += number
        same = np.concatenate([band[1:] == band[:-1], [False]])
        keep = (n > 0) | same
        held, number = (band[-1], ids[-1]), int(n[-1])
        yield pa.RecordBatch.from_arrays([pa.array(x[:-1][keep[:-1]]) for x in (band, ids, n)], ["band", "id", "n"])
    if held is not None and number:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*held, number)], ["band", "id", "n"])


def _lead(b: int, width: int, least: float):
    """Compares the documents of each large band (sorted by band, id) with its first ``LEADERS`` that are like none before them.

    Edges ``u, v`` to those that a document is similar to; a document that is similar to none and comes too late to lead has
    v null. One record batch and the leaders are held, and each document is compared ``LEADERS`` times at most.
    """

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sigs = None, [], []
        for t in batches:
            if not t.num_rows:
                continue
            bands, docs, rows = t.column(0).to_numpy(), t.column(1).to_numpy(), _rows(t.column(2), width)
            us, vs, late = [], [], []
            cut = np.flatnonzero(np.concatenate([[True], bands[1:] != bands[:-1], [True]]))
            for lo, hi in zip(cut, cut[1:]):
                if bands[lo] != now:
                    now, ids, sigs = bands[lo], [], []
                hit = np.zeros(hi - lo, dtype=bool)

                def compare(after: int, leader: int, sig: np.ndarray) -> None:
                    near = after + np.flatnonzero(similarity(rows[lo + after : hi], sig[None], b) >= least)
                    hit[near] = True
                    us.append(docs[lo:hi][near])
                    vs.append(np.full(len(near), leader))

                for leader, sig in zip(ids, sigs):
                    compare(0, leader, sig)
                while len(ids) < LEADERS and not hit.all():
                    p = int(np.flatnonzero(~hit)[0])
                    ids.append(docs[lo + p])
                    sigs.append(rows[lo + p].copy())
                    hit[p] = True
                    compare(p + 1, ids[-1], sigs[-1])
                late.append(lo + np.flatnonzero(~hit))
            u, v, rest = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (us, vs, late))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([u, docs[rest]])), pa.array(np.concatenate([v, rest]), mask=np.arange(len(u) + len(rest)) >= len(u)), pa.array(np.concatenate([u, bands[rest]]))], ["u", "v", "band"])

    return lead


def _split(perms: int, b: int, least: float):
    """Parts ``band, id`` of large bands: documents that agree in r of their b-bit values, for many choices of r values.

    r is such that few of a band's n unlike documents agree by chance, and the choices so many that a pair at the
    threshold agrees in one of them but for a chance of ``MISS``: about log n rows for each document, not n.
    """
    agree = least + (1 - least) * 0.5**b

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            band, ids, n = (t.column(i).to_numpy() for i in (0, 1, 3))
            rows = _rows(t.column(2), perms * b // 8) if t.num_rows else np.zeros((0, perms * b // 8), np.uint8)
            values = np.stack([rows >> np.uint8(b * i) & np.uint8((1 << b) - 1) for i in range(8 // b)], axis=2).reshape(len(rows), -1)
            size = np.maximum(3, np.ceil(np.log2(np.maximum(n, 2)) / b)).astype(int)
            for r in np.unique(size):
                own = size == r
                rng = np.random.default_rng(r)
                for j in range(int(np.ceil(np.log(MISS) / np.log(1 - agree**r)))):
                    key = np.zeros(int(own.sum()), dtype=_U)
                    for c in rng.choice(perms, r, replace=False):
                        key = key * _U(1 << b) + values[own, c].astype(_U)
                    part = mix(mix(key + _U((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) ^ band[own].view(_U))
                    yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), pa.array(ids[own])], ["band", "id"])

    return split


def _neighbours(b: int, width: int, least: float):
    """Compares each document of a part (sorted by band, id) with the one before it and with the part's first."""

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for t in batches:
            if not t.num_rows:
                continue
            band, ids, sig = t.column(0).to_numpy(), t.column(1).to_numpy(), _rows(t.column(2), width)
            if last is not None:
                band, ids, sig = np.concatenate([last[0], band]), np.concatenate([last[1], ids]), np.concatenate([last[2], sig])
            first = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
            head = first[np.searchsorted(first, np.arange(len(band)), side="right") - 1]
            us, vs = [], []
            for other in (head, np.maximum(np.arange(len(band)) - 1, head)):
                at = np.flatnonzero(other < np.arange(len(band)))
                at = at[similarity(sig[at], sig[other[at]], b) >= least]
                us.append(ids[at])
                vs.append(ids[other[at]])
            tail = [head[-1], len(band) - 1] if head[-1] < len(band) - 1 else [len(band) - 1]
            last = band[tail], ids[tail], sig[tail]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return neighbours


def _across(b: int, width: int, least: float):
    """Edges between the classes (``root``) of a large band's documents, from two of its blocks (sorted by band, lo, hi, n).

    Every document of block lo is compared with every one of block hi (or, of the same block, every later one) that isn't of
    its class; classes that an edge joins are one from there on. So the edges are no more than the classes, and no link between two classes is lost.
    """

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, ["band", "lo", "hi"], 1):
            table = table.combine_chunks()
            band, lo, hi, n, ids, roots = (table.column(c).to_numpy() for c in ("band", "lo", "hi", "n", "id", "root"))
            sig = np.concatenate([_rows(c, width) for c in table.column("sig").chunks])
            cut = np.flatnonzero(np.concatenate([[True], (band[1:] != band[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]), [True]]))
            us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s, e in zip(cut, cut[1:]):
                root, own = roots[s:e].copy(), int((n[s:e] // BLOCK == lo[s]).sum())
                for p in range(own):
                    after = own if lo[s] < hi[s] else p + 1
                    todo = after + np.flatnonzero(root[after:] != root[p])
                    near = todo[similarity(sig[s + todo], sig[s + p : s + p + 1], b) >= least]
                    if len(near):
                        other, at = np.unique(root[near], return_index=True)
                        us.append(np.full(len(at), ids[s + p]))
                        vs.append(ids[s + near[at]])
                        root[np.isin(root, other)] = root[p]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return across


def _blocks(large: DataFrame, roots: DataFrame) -> DataFrame:
    """The documents of large bands (``band, id, n, sig, size``) that aren't one class, once for each pair of blocks that their own is in."""
    placed = large.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    block = F.floor(F.col("n") / BLOCK)
    each = placed.join(mixed.select("band"), "band", "left_semi").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / BLOCK))))
    return each.select("band", F.least(block, "other").alias("lo"), F.greatest(block, "other").alias("hi"), "n", "id", "root", "sig")


def _link(b: int, width: int, least: float):
    """Edges that join the documents of every band as all of its similar pairs would.

    All documents are compared with their band's first. Where some aren't similar to it, every reached
    document is compared with all that aren't reached yet, and then a next one starts: the components are
    those of all pairs, but a band of n copies takes n comparisons.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, ["band"], 50_000):
            table = table.combine_chunks()
            band, ids = table.column("band").to_numpy(), table.column("id").to_numpy()
            sig = np.concatenate([_rows(c, width) for c in table.column("sig").chunks])
            new = np.ones(len(band), dtype=bool)
            new[1:] = band[1:] != band[:-1]
            first = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            near = np.empty(len(band))
            for lo in range(0, len(band), 20_000):
                hi = min(len(band), lo + 20_000)
                near[lo:hi] = similarity(sig[lo:hi], sig[first[group[lo:hi]]], b)
            hit = (near >= least) | new
            us, vs = [ids[first[group]][hit & ~new]], [ids[hit & ~new]]
            size = np.diff(np.append(first, len(band)))
            for g in np.flatnonzero(np.bincount(group[~hit], minlength=len(first)) > 0) if not hit.all() else ():
                s, e = first[g], first[g] + size[g]
                todo = s + np.flatnonzero(~hit[s:e])
                queue = list(s + 1 + np.flatnonzero(hit[s + 1 : e]))
                while len(todo):
                    if not queue:
                        queue, todo = [todo[0]], todo[1:]
                        continue
                    p = queue.pop()
                    ok = similarity(sig[todo], sig[p : p + 1], b) >= least
                    if ok.any():
                        us.append(np.full(int(ok.sum()), ids[p]))
                        vs.append(ids[todo[ok]])
                        queue.extend(todo[ok])
                        todo = todo[~ok]
            u, v = np.concatenate(us), np.concatenate(vs)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["u", "v"])

    return link


def _compare(b: int, width: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                x, y = (_rows(c, width) for c in (t.column(2), t.column(3)))
                yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(similarity(x, y, b))], ["id", "root", "similarity"])

    return compare


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, perms: int = 160, bands: int = 40, b: int = 4, threshold: float = 0.55, slack: float = 0.05) -> DataFrame:
    """For every document the least id of its group of near duplicates.

    Returns ``doc_id, keep_id, is_duplicate, similarity``. Documents are sets of word k-grams with ``perms``
    minima. The minima of a band, in full, make candidates: two documents of Jaccard similarity s share
    one of the bands with probability ``1 - (1 - s^4)^40`` (0.978 at 0.55). Of each minimum b low bits stay in
    a packed signature; candidates are duplicates if the estimate from it, corrected for chance matches, is
    ``threshold - slack`` or more (slack: rather more than one standard error, 0.04, so that pairs at the
    threshold aren't lost). Groups are connected components. ``similarity`` is the estimate between the
    document and keep_id (1 for itself), which in a chain can be lower.

    Documents with equal minima are one group from the start and only the least id goes on to the bands,
    so thousands of copies cost no more than two. In a band of up to ``HOT`` documents all are candidates of each other
    (:func:`_link`). A larger one, as boilerplate makes it, is gone through in order first: its documents are compared with its first
    64 unlike ones, and those similar to none of these meet in parts of the band, by further values of their signatures
    (:func:`_split`). That finds most links in n log n. Then all pairs of the band that aren't of one class yet are compared, a pair
    of blocks in a task (:func:`_across`). So no task holds a large band, the groups are those of all pairs whatever ``HOT`` is, and the work
    is quadratic only in what a large band has of unlike documents.

    Nulls: rows with a null id are left out; a null text, or one without words, is no duplicate and has
    similarity null. Texts of fewer than k words are one gram; very long ones are read whole. Repeated ids are one document that is
    a candidate by each of its texts; ``similarity`` is that of its least signature. The result has one row for each id. Of
    a group the least id is kept, so there are no ties. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    width, least = perms * b // 8, threshold - slack
    source = keyed_text(docs, id_col, text_col)
    sigs = checkpointed(source.mapInArrow(_sign(k, perms, b, bands), "id long, w0 long, w1 long, sig binary, bands array<long>"), "sigs")
    heads = sigs.groupBy("w0", "w1").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = checkpointed(sigs.select("id", "w0", "w1").join(heads, ["w0", "w1"]).where("id <> head").select("id", "head", "w0", "w1"), "copies")
    heads_only = sigs.join(copies.select("id", "w0", "w1"), ["id", "w0", "w1"], "left_anti")
    n = shuffle_partitions(spark)
    in_order = lambda df: df.repartition(n, "band").sortWithinPartitions("band", "id")
    shared = checkpointed(in_order(heads_only.select(F.explode("bands").alias("band"), "id")).mapInArrow(_shared, "band long, id long, n long"), "bands")
    hot = checkpointed(shared.where(F.col("n") >= HOT).groupBy("band").agg((F.max("n") + 1).alias("n")), "hot")
    some = not hot.isEmpty()
    cold = shared.join(hot.select("band"), "band", "left_anti") if some else shared
    own = sigs.select("id", "sig").join(shared.select("id").distinct(), "id", "left_semi")
    edges = in_order(cold.join(own, "id").select("band", "id", "sig")).mapInArrow(_link(b, width, least), "u long, v long")
    if some:
        large = checkpointed(shared.join(hot.withColumnRenamed("n", "size"), "band").join(own, "id").select("band", "id", "sig", "n", "size"), "large")
        led = checkpointed(in_order(large.select("band", "id", "sig")).mapInArrow(_lead(b, width, least), "u long, v long, band long"), "led")
        late = led.where("v is null").select("band", F.col("u").alias("id")).join(hot, "band").join(own, "id").select("band", "id", "sig", "n")
        parts = in_order(late.mapInArrow(_split(perms, b, least), "band long, id long")).mapInArrow(_shared, "band long, id long, n long")
        near = in_order(parts.join(own, "id").select("band", "id", "sig")).mapInArrow(_neighbours(b, width, least), "u long, v long")
        edges = edges.unionByName(led.where("v is not null").select("u", "v")).unionByName(near)
    roots = checkpointed(components(edges.unionByName(copies.select(F.col("id").alias("u"), F.col("head").alias("v")))), "roots")
    if some:
        blocks = _blocks(large, roots).repartition(n, "band", "lo", "hi").sortWithinPartitions("band", "lo", "hi", "n")
        more = checkpointed(blocks.mapInArrow(_across(b, width, least), "u long, v long"), "across")
        if not more.isEmpty():
            roots = checkpointed(components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more)), "roots")
    roots = roots.where("node <> root")
    one = sigs.groupBy("id").agg(F.min("sig").alias("sig"))
    members = roots.join(one, roots["node"] == one["id"]).select("id", "root", "sig")
    rooted = members.join(one.select(F.col("id").alias("root"), F.col("sig").alias("root_sig")), "root").select("id", "root", "sig", "root_sig")
    linked = rooted.mapInArrow(_compare(b, width), "id long, root long, similarity double")
    ids = docs.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("id")).distinct()
    words = sigs.select("id").distinct().withColumn("has", F.lit(True))
    out = ids.join(words, "id", "left").join(linked, "id", "left")
    return out.select(F.col("id").alias("doc_id"), F.coalesce("root", "id").alias("keep_id"), F.col("root").isNotNull().alias("is_duplicate"), F.when(F.col("root").isNotNull(), F.col("similarity")).when(F.col("has"), F.lit(1.0)).alias("similarity"))
