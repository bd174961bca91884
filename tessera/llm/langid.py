"""Operator 6: language identification by a bidirectional GRU over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_id
from .rnn import F32, Adam, Recurrent
from .textkernel import slices, text_bytes

#: Class of text in no language.
NONE = "und"
PAD = 256
#: Bytes of a window, and windows that run at once.
WINDOW, LANES = 256, 1024


@dataclass
class LanguageModel:
    net: Recurrent
    out: np.ndarray  # 2 hidden x classes
    bias: np.ndarray
    classes: list[str]

    def logits(self, ids: np.ndarray) -> np.ndarray:
        """Class scores (time, classes, windows) of byte symbols (time, windows)."""
        return np.matmul(self.out.T, self.net.states(ids)) + self.bias[:, None]


def _none_windows(rng: np.random.Generator, n: int, width: int) -> np.ndarray:
    """Bytes in no language: digits and signs, random letters, hexadecimal, bytes above 127."""
    pools = [b"0123456789 .,-:/", b"!#$%&*()+=<>?@[]{}|~^_ \n0123456789", bytes(range(48, 58)) + b"abcdef", bytes(range(65, 91)) + bytes(range(97, 123)) + b"0123456789+/", bytes(range(128, 256)), bytes(range(1, 256))]
    out = np.empty((n, width), dtype=np.int64)
    for i in range(n):
        out[i] = rng.choice(np.frombuffer(pools[i % len(pools)], np.uint8), width)
    return out


def fit(rows: list[tuple[str, str]], hidden: int = 12, width: int = 64, per_class: int = 900, epochs: int = 6, batch: int = 128, seed: int = 5) -> LanguageModel | None:
    """Trains on (language, text) rows by backpropagation through time; every position carries its text's label.

    Windows of ``width`` bytes are cut at random places; one in eight is put in upper case. The class
    ``und`` is trained on made-up bytes. None without rows.
    """
    rng = np.random.default_rng(seed)
    by: dict[str, list[np.ndarray]] = {}
    for lang, text in rows:
        if text and text.strip():
            by.setdefault(lang, []).append(np.frombuffer(text.encode(), np.uint8))
    if not by:
        return None
    classes = [*sorted(by), NONE]
    xs, ys = [], []
    for c, lang in enumerate(classes[:-1]):
        texts = by[lang]
        x = np.full((per_class, width), PAD, dtype=np.int64)
        for i in range(per_class):
            b = texts[i % len(texts)]
            at = int(rng.integers(0, max(1, len(b) - width + 1)))
            if i % 8 == 7:
                b = np.frombuffer(bytes(b).decode(errors="ignore").upper().encode(), np.uint8)
            n = int(rng.integers(width // 8, width + 1)) if i % 4 == 0 else width
            piece = b[at : at + n]
            x[i, : len(piece)] = piece
        xs.append(x)
        ys.append(np.full(per_class, c))
    xs.append(_none_windows(rng, per_class, width))
    ys.append(np.full(per_class, len(classes) - 1))
    x, y = np.concatenate(xs), np.concatenate(ys)
    net = Recurrent("gru", 257, hidden, rng)
    out, bias = rng.normal(0, 0.3, (2 * hidden, len(classes))).astype(F32), np.zeros(len(classes), F32)
    adam = Adam([*net.params(), out, bias], rate=0.02)
    steps = epochs * (len(x) // batch or 1)
    for step in range(steps):
        if step % max(1, len(x) // batch) == 0:
            order = rng.permutation(len(x))
        lo = step % max(1, len(x) // batch) * batch
        pick = order[lo : lo + batch]
        ids = x[pick].T
        h, saved = net.forward(ids)
        z = h @ out + bias
        p = np.exp(z - z.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        real = (ids != PAD).astype(F32)[:, :, None]
        d = p.copy()
        d[:, np.arange(len(pick)), y[pick]] -= 1
        d *= real / real.sum()
        grads = net.backward(d @ out.T, saved)
        adam.step([*grads, np.tensordot(h, d, ([0, 1], [0, 1])).astype(F32), d.sum((0, 1)).astype(F32)], 0.02 * (1 - 0.9 * step / steps))
        net.shut()
    return LanguageModel(net, out, bias, classes)


def windows(data: np.ndarray, off: np.ndarray, width: int = WINDOW, stride: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of the windows that cover all bytes of every document."""
    stride = stride or width
    lens = np.diff(off)
    counts = np.where(lens > 0, 1 + np.maximum(0, -(-(lens - width) // stride)), 0)
    doc = np.repeat(np.arange(len(lens)), counts)
    k = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = off[:-1][doc] + k * stride
    return start, np.minimum(width, off[1:][doc] - start), doc


def gather(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int, pad: int) -> np.ndarray:
    """Symbols (time, windows), padded at the end."""
    at = start[None, :] + np.arange(width)[:, None]
    ids = data[np.minimum(at, len(data) - 1)].astype(np.int64)
    ids[np.arange(width)[:, None] >= length[None, :]] = pad
    return ids


def pooled(model: LanguageModel, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of every position's class probabilities, and counts of positions by their label (documents x classes)."""
    C = len(model.classes)
    prob, count = np.zeros((len(off) - 1, C)), np.zeros((len(off) - 1, C), dtype=np.int64)
    start, length, doc = windows(data, off)
    order = np.argsort(length, kind="stable")
    for lo in range(0, len(order), LANES):
        w = order[lo : lo + LANES]
        width = int(length[w].max())
        z = model.logits(gather(data, start[w], length[w], width, PAD))
        top = z.max(axis=1, keepdims=True)
        real = (np.arange(width)[:, None] < length[w][None, :])[:, None, :]
        best = (z == top) & real
        z -= top
        np.exp(z, out=z)
        z *= real / z.sum(axis=1, keepdims=True)
        np.add.at(prob, doc[w], z.sum(axis=0, dtype=np.float64).T)
        np.add.at(count, doc[w], best.sum(axis=0).T)
    return prob, count


def label_positions(model: LanguageModel, text: str) -> list[str]:
    """The label of every byte of a text."""
    data = np.frombuffer(text.encode(), np.uint8)
    start, length, _ = windows(data, np.array([0, len(data)]))
    if not len(start):
        return []
    z = model.logits(gather(data, start, length, WINDOW, PAD)).argmax(axis=1)
    return [model.classes[z[t, w]] for w in range(len(start)) for t in range(length[w])]


def _apply(held, least: float, names: list[str]):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: LanguageModel = held.value
        for batch in batches:
            for s in slices(batch, "t"):
                data, off = text_bytes(s.column(1))
                n = np.diff(off)
                prob, count = pooled(model, data, off)
                prob[n == 0, -1] = 1
                share = prob / np.maximum(n, 1)[:, None]
                c = share.argmax(axis=1)
                rows = np.arange(len(c))
                p = share[rows, c]
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), pa.array([model.classes[i] for i in c], pa.string()), pa.array(p), pa.array(count[rows, c] / np.maximum(n, 1)), pa.array((c != len(model.classes) - 1) & (p >= least))],
                    names,
                )

    return apply


def training_rows(docs: DataFrame, per_language: int, seed: int = 5, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", chars: int = 400, most_languages: int = 64) -> list[tuple[str, str]]:
    """A bounded sample of labelled rows: of each language at most ``per_language`` documents, those with the least seeded hashes, and of each an excerpt
    (``chars`` characters from a hashed place). Labels beyond the ``most_languages`` most frequent ones are taken for noise."""
    labelled = docs.where(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(F.col(f"`{lang_col}`").cast("string").alias("l")).count().orderBy(F.desc("count"), "l").limit(most_languages).collect()}
    if not counts:
        return []
    shares = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, 1.3 * per_language / n)))
    bound = F.coalesce(F.try_element_at(shares, F.col(f"`{lang_col}`").cast("string")), F.lit(0.0))
    h = hash_id(f"`{id_col}`", seed)
    at = F.lit(1) + F.floor(F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.greatest(F.lit(1), F.length(F.col(f"`{text_col}`")) - chars))).cast("int")
    rows = labelled.where(h < bound).select(F.col(f"`{lang_col}`").cast("string").alias("l"), h.alias("h"), F.col(f"`{text_col}`").substr(at, F.lit(chars)).alias("t")).collect()
    rows.sort(key=lambda r: (r["h"], r["l"], r["t"]))
    out: dict[str, list[tuple[str, str]]] = {}
    for r in rows:
        if len(out.setdefault(r["l"], [])) < per_language:
            out[r["l"]].append((r["l"], r["t"]))
    return [x for k in sorted(out) for x in out[k]]


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: LanguageModel | None = None, per_language: int = 300, least: float = 0.3) -> DataFrame:
    """Language of every document.

    Returns ``doc_id, language, probability, share, accepted``. The network runs over windows of 256 bytes
    that cover the whole text; the labels of all positions are pooled: probability is the mean of their
    class probabilities, share the part of the positions with the document's label. A document is
    accepted if its language isn't ``und`` (no language) and has at least ``least`` probability.

    Without a given model one is trained on excerpts (400 characters) of at most ``per_language`` labelled rows of each
    language (``lang_col``; the 64 most frequent labels); labelling reads all of every text, whatever its length. Of classes
    with equal probability the first by name counts. Without any labelled row there is no model: language, probability and share are null,
    and everything is accepted.

    Nulls: a null id stays null; rows with a null language aren't trained on; a null or empty text is
    ``und`` with probability 1 and share 0, and isn't accepted. Repeated rows are labelled each. Empty
    tables give an empty result; other columns are ignored.
    """
    schema = "doc_id long, language string, probability double, share double, accepted boolean"
    names = ["doc_id", "language", "probability", "share", "accepted"]
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("t"))
    if model is None:
        model = fit(training_rows(docs, per_language, lang_col=lang_col, text_col=text_col, id_col=id_col))
    if model is None:
        return source.select("doc_id", F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("double").alias("share"), F.lit(True).alias("accepted"))
    return source.mapInArrow(_apply(docs.sparkSession.sparkContext.broadcast(model), least, names), schema)


def accepted_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: LanguageModel | None = None, per_language: int = 300, least: float = 0.3) -> DataFrame:
    """The rows of docs that :func:`identify` accepts, with all columns; nothing is joined or shuffled.

    Nulls, empty and very long texts, ties, repeated rows, empty tables and a missing model are handled as there; other columns
    come through as they are, whatever their names.
    """
    if model is None:
        model = fit(training_rows(docs, per_language, lang_col=lang_col, text_col=text_col, id_col=id_col))
    if model is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _apply(held, least, ["doc_id", "language", "probability", "share", "accepted"])
        for batch in batches:
            if batch.num_rows:
                pair = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(at)], ["doc_id", "t"])
                yield batch.filter(pa.concat_arrays([b.column(4) for b in judge(iter([pair]))]))

    return docs.mapInArrow(keep, docs.schema)

