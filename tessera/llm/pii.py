"""Operator 9: personal data and secrets by a character-level bidirectional LSTM with CRF transitions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_id, keyed_text
from .langid import gather, windows
from .rnn import CRF, F32, Adam, Recurrent
from .textkernel import slices, text_bytes

TAGS = ["", "email", "phone", "ip", "card", "secret"]
#: ASCII by itself, other letters, other characters, padding.
LETTER, OTHER, PAD = 128, 129, 130
#: Characters of a window, of the overlap of two, and windows that run at once.
WINDOW, OVERLAP, LANES = 512, 64, 1024
#: The fewest characters that a span of each kind has in any form: a@b.c, 1.1.1.1, seven digits of a phone, 13 of a card. A secret may have any number.
LEAST_CHARS = {"email": 5, "phone": 7, "ip": 7, "card": 13, "secret": 1}


def symbols(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(cp < 128, cp, np.where(cp >= 0xC0, LETTER, OTHER)).astype(np.uint8)


# ---- labelled spans for training ----


class Maker:
    """Makes training texts with labelled spans: background words or excerpts, personal data, and look-alikes that aren't."""

    def __init__(self, rng: np.random.Generator, excerpts: list[str]) -> None:
        self.rng = rng
        self.excerpts = [e for e in excerpts if len(e) >= 40 and not any(c.isdigit() or c == "@" for c in e)]

    def pick(self, *options: str) -> str:
        return options[int(self.rng.integers(len(options)))]

    def digits(self, n: int) -> str:
        return "".join(map(str, self.rng.integers(0, 10, n)))

    def word(self, low: int = 2, high: int = 9) -> str:
        pool = "aaabcdeeeefghiiijklmnoooprsttuuvwxyz" + ("éèñüäößçóí" if self.rng.random() < 0.2 else "")
        return "".join(pool[i] for i in self.rng.integers(0, len(pool), int(self.rng.integers(low, high + 1))))

    def of(self, chars: str, n: int) -> str:
        return "".join(chars[i] for i in self.rng.integers(0, len(chars), n))

    def personal(self) -> tuple[str, str, str, int]:
        """Text before, the span, text after, and its tag."""
        r, kind = self.rng, int(self.rng.integers(1, len(TAGS)))
        if kind == 1:
            local = self.pick(self.word(1), self.word(1) + self.pick(".", "_", "-", "") + self.word(1), self.word(1) + self.pick(".", "", "_") + self.digits(int(r.integers(1, 4))))
            host = self.pick("mail", "smtp", "post", self.word(), self.word()) + self.pick("", "", self.digits(1)) + self.pick("", ".example", "." + self.word(3, 7))
            return "", (local + "@" + host + self.pick(".com", ".com", ".org", ".net", ".de", ".fr", ".es", ".co.uk", ".io", "." + self.word(2, 4))).replace("..", "."), "", kind
        if kind == 2:
            a, b, c = self.digits(3), self.digits(3), self.digits(4)
            return "", self.pick(f"+1 ({a}) {b}-{c}", f"+1 ({a}) 555-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1-{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{int(r.integers(20, 99))} {self.digits(2)} {c} {self.digits(4)}", f"+{int(r.integers(20, 99))} {b} {self.digits(int(r.integers(6, 9)))}"), "", kind
        if kind == 3:
            return "", ".".join(str(x) for x in r.integers(0, 256, 4)), "", kind
        if kind == 4:
            d = self.pick("4", "4", "51", "52", "53", "54", "55", "6011", "65")
            d += self.digits(16 - len(d))
            parts = [d[i : i + 4] for i in range(0, 16, 4)]
            return "", self.pick(d, d, d, " ".join(parts), "-".join(parts)), "", kind
        hexa, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
        value = self.pick(self.of(hexa, 40), self.of(hexa, 40), self.of(hexa, 32), self.of(hexa, 64), "AKIA" + self.of(alnum[:26] + "0123456789", 16), "sk-" + self.of(alnum, 40), "ghp_" + self.of(alnum, 36), self.of(alnum, 40))
        name = self.pick("token", "token", "api_key", "secret", "password", "apikey", "access_token", "key")
        q = self.pick('"', '"', "'", "")
        return name + self.pick(" = ", "=", ": ", " : ") + q, value, q, kind

    def harmless(self) -> str:
        n = self.digits
        return self.pick(n(1) + "." + n(1), n(4), n(2), n(1) + "," + n(3), n(2) + "%", "$" + n(3) + "." + n(2), "20" + n(2) + "-0" + n(1) + "-1" + n(1), n(2) + ":" + n(2), n(6), n(9), n(11), n(1) + "." + n(1) + "." + n(1), "version " + n(1) + ".", "@" + self.word(), self.word() + " @ " + self.word(), "(" + n(4) + ")", "#" + n(3), n(3) + "/" + n(3), "token", "token = ", "key: " + self.word(), self.word() + "." + self.word(), "http://" + self.word() + ".com/" + self.word(), self.word().upper(), "===", "&&&", "***", "%%%", "--", '"' + self.word() + '"', "mail" + n(1), self.pick(*"012789") + n(15))

    def background(self) -> str:
        draw = self.rng.random()
        if draw < 0.2:  # words with signs after them
            signs = [self.pick("###", "***", "&&&", "$$$", "%%%", "!!", " |", "@@@", "...") for _ in range(3)]
            words = [self.word(1, 14) + self.pick("", "", ".", ",") + signs[int(self.rng.integers(3))] for _ in range(int(self.rng.integers(2, 7)))]
            return self.pick(" ".join(words), " ".join(words).upper())
        if self.excerpts and draw < 0.8:
            e = self.excerpts[int(self.rng.integers(len(self.excerpts)))]
            at = int(self.rng.integers(0, max(1, len(e) - 20)))
            return e[at : at + int(self.rng.integers(5, 45))]
        return self.pick(" ", "\n").join(self.word() + self.pick("", "", "", ".", ",") for _ in range(int(self.rng.integers(1, 6))))

    def text(self, width: int) -> tuple[str, np.ndarray]:
        out, tags = "", []
        if self.rng.random() < 0.4:
            out = self.background()
            out = out[int(self.rng.integers(0, len(out))) :]
            tags = [0] * len(out)
        while len(out) < width:
            draw = self.rng.random()
            if draw < 0.4:
                before, span, after, kind = self.personal()
                after += self.pick("", "", "", ".", ",", "***", "&&&", " |")
            elif draw < 0.65:
                before, span, after, kind = "", self.harmless(), "", 0
            else:
                before, span, after, kind = "", self.background(), "", 0
            gap = self.pick(" ", " ", " ", " ", "\n", " | ", ": ", " (", ", ")
            out += gap + before + span + after
            tags += [0] * len(gap + before) + [kind] * len(span) + [0] * len(after)
        at = int(self.rng.integers(0, len(out) - width + 1))
        return out[at : at + width], np.array(tags[at : at + width])


@dataclass
class PiiModel:
    net: Recurrent
    out: np.ndarray
    bias: np.ndarray
    crf: CRF

    def tags(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        e = np.matmul(self.out.T, self.net.states(ids)) + self.bias[:, None]
        return self.crf.decode(e.transpose(0, 2, 1), lengths)


def fit(excerpts: list[str], hidden: int = 12, width: int = 96, steps: int = 420, batch: int = 64, seed: int = 11) -> PiiModel:
    """Trains on made-up labelled spans within the excerpts (and made-up words), by backpropagation through time and the CRF's likelihood."""
    rng = np.random.default_rng(seed)
    maker = Maker(rng, excerpts)
    net, crf = Recurrent("lstm", PAD + 1, hidden, rng), CRF(len(TAGS))
    out, bias = rng.normal(0, 0.3, (2 * hidden, len(TAGS))).astype(F32), np.zeros(len(TAGS), F32)
    bias[0] = 1
    adam = Adam([*net.params(), out, bias, *crf.params()], rate=0.02)
    for step in range(steps):
        made = [maker.text(width) for _ in range(batch)]
        ids, y = np.stack([symbols(t) for t, _ in made], axis=1).astype(np.int64), np.stack([t for _, t in made], axis=1)
        h, saved = net.forward(ids)
        _, de, dcrf = crf.loss(h @ out + bias, y)
        grads = net.backward(de @ out.T, saved)
        adam.step([*grads, np.tensordot(h, de, ([0, 1], [0, 1])).astype(F32), de.sum((0, 1)), *dcrf], 0.025 * (1 - 0.93 * step / steps))
        net.shut()
    return PiiModel(net, out, bias, crf)


def tag_texts(model: PiiModel, data: np.ndarray, off: np.ndarray, width: int = WINDOW, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tags of all characters of the texts (UTF-8 bytes with offsets), the texts' character offsets, and the characters' symbols.

    Every text is covered by windows that overlap. Each is decoded by itself; of the overlap of two, the
    first half is taken from the earlier one and the second from the later, so that every label comes from
    the window that sees more of its surroundings, and spans go on across the seams.
    """
    if not len(data):
        return np.zeros(0, np.int8), np.zeros(len(off), np.int64), np.zeros(0, np.uint8)
    ids = symbols(data.tobytes().decode())
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    co = first[off]
    start, length, doc = windows(ids, co, width, width - overlap)
    out = np.zeros(len(ids), dtype=np.int8)
    lo = np.where(start == co[doc], 0, overlap // 2)
    last = np.ones(len(doc), dtype=bool)
    last[:-1] = doc[1:] != doc[:-1]
    hi = np.where(last, length, width - (overlap - overlap // 2))
    order = np.argsort(length, kind="stable")
    for i in range(0, len(order), LANES):
        w = order[i : i + LANES]
        wide = int(length[w].max())
        y = model.tags(gather(ids, start[w], length[w], wide, PAD), length[w])
        t, k = np.nonzero(y)
        ok = (t >= lo[w][k]) & (t < hi[w][k])
        out[start[w][k[ok]] + t[ok]] = y[t[ok], k[ok]]
    return out, co, ids


def checked(number: str) -> bool:
    """Whether the digits' Luhn sum is right."""
    d = np.array([int(c) for c in reversed(number)])
    d[1::2] *= 2
    return bool((d - 9 * (d > 9)).sum() % 10 == 0)


def is_card(span: str) -> bool:
    """Whether the span has 13 to 19 digits, together or in one piece, with the right check digit."""
    runs = [re.sub(r"\D", "", x) for x in (span, *re.split(r"[^0-9-]+", span))]
    return any(13 <= len(x) <= 19 and checked(x) for x in runs)


def spans(tags: np.ndarray, co: np.ndarray, ids: np.ndarray, least: dict[str, int] = LEAST_CHARS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start, end and tag of the runs of one tag other than 0 that have their kind's ``least`` characters; card numbers only with the right check digit."""
    if not len(tags):
        return (np.zeros(0, np.int64),) * 4
    new = np.ones(len(tags), dtype=bool)
    new[1:] = tags[1:] != tags[:-1]
    new[co[:-1][co[:-1] < len(tags)]] = True
    s = np.flatnonzero(new)
    e = np.append(s[1:], len(tags))
    ok = (tags[s] != 0) & (e - s >= np.array([0, *(least[k] for k in TAGS[1:])])[tags[s]])
    for i in np.flatnonzero(ok & (tags[s] == TAGS.index("card"))):
        ok[i] = is_card("".join(map(chr, ids[s[i] : e[i]])))
    s, e = s[ok], e[ok]
    doc = np.searchsorted(co, s, side="right") - 1
    return doc, s - co[doc], e - co[doc], tags[s]


def _apply(held):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "t", 2 << 20):
                data, off = text_bytes(b.column(1))
                doc, s, e, tag = spans(*tag_texts(held.value, data, off))
                if len(doc):
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array([TAGS[i] for i in tag])], ["doc_id", "start", "end", "kind"])

    return apply


def training_excerpts(docs: DataFrame, n: int, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", chars: int = 400) -> list[str]:
    """Excerpts (``chars`` characters from a hashed place) of at most n documents, those with the least seeded hashes of ids: surroundings of made-up spans, no labels."""
    rows = keyed_text(docs, id_col, text_col, lower=False).where(F.length("t") > 0)
    total = rows.select("id").count() if n else 0
    if not total:
        return []
    at = F.lit(1) + F.floor(F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.length("t") - chars))).cast("int")
    got = rows.where(hash_id("id", seed) < 1.3 * n / total).select(hash_id("id", seed).alias("h"), F.col("t").substr(at, F.lit(chars)).alias("t")).collect()
    return [r["t"] for r in sorted(got, key=lambda r: (r["h"], r["t"]))[:n]]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: PiiModel | None = None, excerpts: int = 600) -> DataFrame:
    """Spans of e-mail addresses, phone numbers, IP addresses, card numbers and secrets.

    Returns ``doc_id, start, end, kind`` (characters of the text, end exclusive), a row for each span. All
    characters of every text are tagged by the network, over windows of 512 characters that overlap by 64,
    and the Viterbi paths of the windows are joined to one labelling of the text (``tag_texts``). Card numbers are
    reported if their check digit is right, which a network of this size can't compute.

    Spans shorter than any form of their kind (``LEAST_CHARS``) aren't reported: they are a tag that flickers.

    Without a given model one is trained on made-up labelled spans, with excerpts (400 characters each) of at most
    ``excerpts`` documents as surroundings: the bounded sample of the training, tagging reads all of every text.

    Nulls: rows with a null id are left out; a null or empty text has no spans. A text of any length is tagged window by
    window. Of two windows' tags at one place the one further from its window's end counts, so there are no ties.
    Repeated rows give their spans each. Empty tables give an empty result; other columns are ignored.
    """
    if model is None:
        model = fit(training_excerpts(docs, excerpts, id_col=id_col, text_col=text_col))
    return keyed_text(docs, id_col, text_col, lower=False).mapInArrow(_apply(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, start int, end int, kind string")
