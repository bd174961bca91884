"""Operator 4: toxicity by a counterfactually regularised linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_id
from .textkernel import kgrams, mix, slices, span_hash, text_bytes, word_hashes, words

#: Terms that name groups of people, by language and kind; a term is swapped with the others of its kind and with a neutral word of its language.
IDENTITY_TERMS: dict[str, tuple[str, ...]] = {
    "en gender": ("women", "men", "woman", "man", "female", "male", "transgender", "nonbinary"),
    "en orientation": ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"),
    "en religion": ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    "en origin": ("black", "white", "asian", "african", "latino", "mexican", "arab", "european", "immigrant", "refugee"),
    "en ability": ("blind", "deaf", "disabled", "autistic"),
    "en age": ("old", "young", "elderly", "teenage"),
    "de gender": ("frauen", "männer", "frau", "mann", "weiblich", "männlich"),
    "de orientation": ("schwul", "lesbisch", "bisexuell", "homosexuell", "heterosexuell"),
    "de religion": ("muslime", "christen", "juden", "hindus", "buddhisten", "katholiken"),
    "de origin": ("schwarze", "weiße", "asiaten", "afrikaner", "araber", "europäer", "flüchtlinge", "einwanderer"),
    "fr gender": ("femmes", "hommes", "femme", "homme", "féminin", "masculin"),
    "fr orientation": ("gai", "lesbienne", "bisexuel", "homosexuel", "hétérosexuel"),
    "fr religion": ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "catholiques"),
    "fr origin": ("noirs", "blancs", "asiatiques", "africains", "arabes", "européens", "réfugiés", "immigrés"),
    "es gender": ("mujeres", "hombres", "mujer", "hombre", "femenino", "masculino"),
    "es orientation": ("gais", "lesbiana", "bisexual", "homosexual", "heterosexual"),
    "es religion": ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "católicos"),
    "es origin": ("negros", "blancos", "asiáticos", "africanos", "árabes", "europeos", "refugiados", "inmigrantes"),
}
NEUTRAL: dict[str, tuple[str, ...]] = {"en": ("local", "person", "people"), "de": ("leute", "person", "menschen"), "fr": ("gens", "personne", "voisins"), "es": ("gente", "persona", "vecinos")}
#: Feature numbers of words and stems: their hash's low bits.
DIMS = 1 << 20
#: Bytes of a stem.
STEM = 6
#: A word or stem has a feature for one occurrence in a text, one for two, and so on up to so many.
TIMES = 3
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


@dataclass
class ToxicityModel:
    weights: np.ndarray  # of the words, by feature number
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """Log odds of lower-case texts."""
        doc, f, n = word_features(column)
        at = np.flatnonzero(self.weights.reshape(TIMES, DIMS).any(axis=0)[f])
        doc, f = times(doc[at], f[at])
        return self.bias + np.bincount(doc, self.weights[f], n)


def times(doc: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each text, once each: that a word or stem occurs, that it does so twice, and ``TIMES`` times."""
    pairs, n = np.unique(doc * DIMS + f, return_counts=True)
    found = [pairs[n > i] for i in range(TIMES)]
    return np.concatenate(found) // DIMS, np.concatenate([p % DIMS + i * DIMS for i, p in enumerate(found)])


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Document and number of every feature: each word, and the first ``STEM`` bytes of a longer one; and the count of texts."""
    data, off = text_bytes(column)
    start, end, wo = words(data, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(wo))
    if not len(start):
        return doc, doc, len(off) - 1
    long = np.flatnonzero(end - start > STEM)
    stems = mix(span_hash(data, start[long], start[long] + STEM) + np.uint64(1))
    f = np.concatenate([span_hash(data, start, end), stems]) & np.uint64(DIMS - 1)
    return np.concatenate([doc, doc[long]]), f.astype(np.int64), len(off) - 1


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, with offsets."""
    doc, f, n = word_features(pa.array(texts, pa.large_string()))
    doc, f = times(doc, f)
    order = np.argsort(doc, kind="stable")
    return f[order], np.searchsorted(doc[order], np.arange(n + 1))


def distinct_texts(texts: list[str], k: int = 3, samples: int = 24, most: int = 8) -> np.ndarray:
    """Positions of the texts without a near copy before: none that is kept shares more than ``most`` of its ``samples`` minima of word 3-grams.

    Copies of one labelled text would make its chance words look like evidence. A text of fewer than k words stays.
    """
    wh, wo = word_hashes(pa.array(texts, pa.large_string()))
    h, _, ko = kgrams(wh, wo, k)
    having: dict[tuple[int, int], list[int]] = {}
    keep = []
    for i in range(len(texts)):
        own = h[ko[i] : ko[i + 1]]
        marks = [(j, int(mix(own + np.uint64(j)).min())) for j in range(samples)] if len(own) else []
        shared = Counter(x for m in marks for x in having.get(m, ()))
        if max(shared.values(), default=0) <= most:
            keep.append(i)
            for m in marks:
                having.setdefault(m, []).append(i)
    return np.array(keep, dtype=np.int64)


def counterfactuals(texts: list[str], terms: dict[str, tuple[str, ...]], n: int, rng: np.random.Generator) -> tuple[list[str], list[str]]:
    """Sentences of the labelled texts with an identity term, and the same with the term swapped.

    Each sentence that has a term is swapped with the others of the kind and a neutral word. n further sentences, drawn
    from all of the labelled texts, get a term at a random place first, so that terms without labelled mentions are held too.
    """
    kind = {t: k for k, ts in terms.items() for t in ts}
    left, right = [], []

    def swap(words: list[str], i: int) -> None:
        neutral = NEUTRAL.get(kind[words[i]][:2], NEUTRAL["en"])
        others = [t for t in terms[kind[words[i]]] if t != words[i]] + [neutral[int(rng.integers(len(neutral)))]]
        for o in others:
            left.append(" ".join(words))
            right.append(" ".join([*words[:i], o, *words[i + 1 :]]))

    plain = []
    for t in texts:
        for s in _SENTENCE.findall(t):
            words = _WORD.findall(s)
            hits = [i for i, w in enumerate(words) if w in kind]
            for i in hits:
                swap(words, i)
            if words and not hits:
                plain.append(s)
    every = sorted(kind)
    for j in range(n if plain and every else 0):
        words = _WORD.findall(plain[int(rng.integers(len(plain)))])
        i = int(rng.integers(len(words) + 1))
        words.insert(i, every[j % len(every)])
        swap(words, i)
    return left, right


def fit(rows: list[tuple[str, int]], terms: dict[str, tuple[str, ...]] | None = None, penalty: float = 30.0, sparsity: float = 1.8, least_docs: int = 4, inserted: int = 400, steps: int = 400, seed: int = 3) -> ToxicityModel | None:
    """Logistic regression on the distinct words and stems of (text, 0 or 1) rows. None unless both labels occur.

    Loss: mean log loss + ``penalty`` / 2 times the mean squared change of the score under the swaps of
    :func:`counterfactuals` + an L1 term of ``sparsity`` times the square root of each feature's document count
    (so many times two standard errors of one without effect: chance words get weight 0). The features
    that this leaves are fitted again with a tenth of the L1 term, which would shrink their weights, and with further
    copies of the texts that lack most of their words, so that no word hides behind those that go with it.
    Features in fewer than ``least_docs`` texts are left out, unless they are of identity terms.
    """
    terms = IDENTITY_TERMS if terms is None else terms
    rows = [(t.lower(), int(y)) for t, y in rows if t and y is not None]
    if not rows:
        return None
    keep = distinct_texts([t for t, _ in rows])
    rows = [rows[i] for i in keep]
    y = np.array([r[1] for r in rows], dtype=float)
    if y.min() == y.max():
        return None
    n = len(rows)
    idx, off = _features([t for t, _ in rows])
    left, right = counterfactuals([t for t, _ in rows], terms, inserted, np.random.default_rng(seed))
    swaps = (*_features(left), *_features(right))
    df = np.bincount(idx, minlength=TIMES * DIMS)
    swapped = np.zeros(TIMES * DIMS, dtype=bool)
    swapped[_features([t for ts in (*terms.values(), *NEUTRAL.values()) for t in ts])[0]] = True
    used = np.flatnonzero((df >= least_docs) | swapped & (df > 0))
    w, b = _solve(idx, off, y, swaps, used, penalty, sparsity * np.sqrt(df[used]) / n, steps)
    used = used[(w != 0) | swapped[used]]  # the L1 term has chosen the words; their weights are fitted anew with little of it
    rng, doc = np.random.default_rng(seed), np.repeat(np.arange(n), np.diff(off))
    kept = [np.ones(len(idx), dtype=bool), *(rng.random(len(idx)) < 0.4 for _ in range(3))]
    doc = np.concatenate([doc[k] + i * n for i, k in enumerate(kept)])
    idx, off, y = np.concatenate([idx[k] for k in kept]), np.searchsorted(doc, np.arange(len(kept) * n + 1)), np.tile(y, len(kept))
    w, b = _solve(idx, off, y, swaps, used, penalty, 0.1 * sparsity * np.sqrt(df[used]) / n, steps)
    weights = np.zeros(TIMES * DIMS)
    weights[used] = w
    return ToxicityModel(weights, b)


def _solve(idx: np.ndarray, off: np.ndarray, y: np.ndarray, swaps: tuple, used: np.ndarray, penalty: float, shrink: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient with a step for each word, as words differ in frequency."""
    n, size, column = len(y), len(used), np.full(TIMES * DIMS, -1)
    column[used] = np.arange(size)

    def csr(i: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c, row = column[i], np.repeat(np.arange(len(o) - 1), np.diff(o))
        return c[c >= 0], row[c >= 0]

    xc, xr = csr(idx, off)
    (lc, lr), (rc, rr) = csr(*swaps[:2]), csr(*swaps[2:])
    dc, dr, dv, m = np.concatenate([lc, rc]), np.concatenate([lr, rr]), np.concatenate([np.ones(len(lc)), -np.ones(len(rc))]), max(1, len(swaps[1]) - 1)
    scale = 1 / (np.maximum(np.bincount(xc, minlength=size), 1) / (1.5 * n) + 2 * penalty * np.bincount(dc, minlength=size) / m)
    w, b = np.zeros(size), float(np.log(y.mean() / (1 - y.mean())))
    z, zb, t, rate = w, b, 1.0, 0.5

    def smooth(w: np.ndarray, b: float) -> tuple[float, np.ndarray, float]:
        s = np.bincount(xr, w[xc], n) + b
        change = np.bincount(dr, dv * w[dc], m)
        p = 1 / (1 + np.exp(-np.clip(s, -40, 40)))
        loss = float(np.mean(np.logaddexp(0, s) - y * s)) + penalty / 2 * float(np.mean(change**2))
        r = (p - y) / n
        return loss, np.bincount(xc, r[xr], size) + penalty / m * np.bincount(dc, dv * change[dr], size), float(r.sum())

    for _ in range(steps):
        loss, g, gb = smooth(z, zb)
        while True:  # the step shrinks until the quadratic bound holds
            step = rate * scale
            new = z - step * g
            new = np.sign(new) * np.maximum(np.abs(new) - step * shrink, 0)
            nb = zb - rate * 4 * gb
            d = new - z
            bound = loss + float(g @ d) + gb * (nb - zb) + float((d * d / (2 * step)).sum()) + (nb - zb) ** 2 / (8 * rate)
            if smooth(new, nb)[0] <= bound + 1e-12 or rate < 1e-6:
                break
            rate /= 2
        small = np.abs(new - w).max(initial=0) < 1e-4 and abs(nb - b) < 1e-4
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = new + (t - 1) / t2 * (new - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = new, nb, t2
        if small:
            break
    return w, b


def training_rows(docs: DataFrame, labels: DataFrame, most: int, seed: int = 3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> list[tuple[str, int]]:
    """At most ``most`` labelled documents, those with the least seeded hashes of their ids; texts are whole. Of an id with several rows the least text counts."""
    y = F.col(f"`{label_col}`")
    own = labels.where(y.isNotNull() & F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast("long").alias("id")).agg(F.max(y.cast("int")).alias("y"))
    total = own.count()
    if not total:
        return []
    h = hash_id("id", seed)
    chosen = own.where(h < 1.2 * most / total + 20 / total).orderBy(h, "id").limit(most)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t")).where("t is not null")
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("t").alias("t")).toArrow().to_pylist()  # ``most`` rows of 12 bytes are broadcast, and as many texts come back
    rows.sort(key=lambda r: (r["id"], r["t"]))
    return [(r["t"], r["y"]) for r in rows]


def _apply(held, threshold: float):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights, bias = held.value
        dense = np.zeros(TIMES * DIMS)
        dense[words] = weights
        model = ToxicityModel(dense, bias)
        for batch in batches:
            for s in slices(batch, "t"):
                p = 1 / (1 + np.exp(-np.clip(model.scores(s.column(1)), -40, 40)))
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(2), pa.array(p), pa.array(p >= threshold)], ["doc_id", "known", "toxicity", "is_toxic"])

    return apply


def toxic_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.5, most: int = 4000, terms: dict[str, tuple[str, ...]] | None = None, penalty: float = 30.0, model: ToxicityModel | None = None) -> DataFrame:
    """Toxicity of every document.

    Returns ``doc_id, toxicity, is_toxic`` (probability, and whether it reaches ``threshold``). The classifier
    (see :func:`fit`) is trained on at most ``most`` labelled documents and applied to all distinct words of
    every whole text. Swapping identity terms (``terms``) in labelled sentences must not change their score, so
    a mention of a group isn't evidence.

    Near copies of a labelled text aren't trained on (:func:`distinct_texts`), and the terms are those of four languages.

    Without a labelled document of both kinds there is no model: toxicity is null and is_toxic false.

    Nulls: a null id stays null; a null text has toxicity null and isn't toxic; an empty one has the
    classifier's base score. Rows of labels with a null id or label are left out; of an id with several labels
    the highest counts, and of several texts under it the least. Repeated rows are scored each; ties don't occur. Texts of any
    length are scored whole. Empty tables give an empty result; other columns are
    ignored.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.lower(F.col(f"`{text_col}`")).alias("t"), F.col(f"`{text_col}`").isNotNull().alias("known"))
    if model is None:
        model = fit(training_rows(docs, labels, most, id_col=id_col, text_col=text_col, label_col=label_col), terms, penalty)
    if model is None:
        return source.select("doc_id", F.lit(None).cast("double").alias("toxicity"), F.lit(False).alias("is_toxic"))
    words = np.flatnonzero(model.weights)
    held = docs.sparkSession.sparkContext.broadcast((words, model.weights[words], model.bias))
    out = source.mapInArrow(_apply(held, threshold), "doc_id long, known boolean, toxicity double, is_toxic boolean")
    return out.select("doc_id", F.when(F.col("known"), F.col("toxicity")).alias("toxicity"), (F.col("known") & F.col("is_toxic")).alias("is_toxic"))
