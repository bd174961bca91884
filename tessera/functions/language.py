"""Language identification by ranked character n-gram profiles."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import sized_slices

#: n-grams that a task counts before it passes them on.
KEPT = 1 << 19


def profiles(docs: DataFrame, text: str = "text", language: str = "lang", n: int = 3, size: int = 400) -> dict[str, list[str]]:
    """The most frequent 1- to n-grams of each language's labelled texts, in the order of frequency.

    Counts cover all texts; what comes to the driver is ``size`` n-grams for each language.
    """
    from pyspark.sql import Window

    t = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), F.lit(" "))
    own = docs.where(F.col(text).isNotNull() & F.col(language).isNotNull()).select(F.col(language).alias("l"), t.alias("t"))
    counted = own.mapInArrow(_counted(n), "l string, g string, c long")
    top = counted.where("trim(g) <> ''").groupBy("l", "g").agg(F.sum("c").alias("c")).withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy(F.desc("c"), "g"))).where(F.col("r") <= size)
    out: dict[str, list[str]] = {}
    for r in top.orderBy("l", "r").toLocalIterator():
        out.setdefault(r["l"], []).append(r["g"])
    return out


def _grams(t: str, n: int) -> list[list[str]]:
    """All runs of 1 to n characters."""
    out = [list(t)]
    for k in range(1, n):
        out.append(list(map(add, out[-1], t[k:])))
    return out


def _counted(n: int):
    """n-grams of texts by language with their counts, which a task sums up; it holds about ``KEPT`` n-grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter[str]] = {}

        def packed() -> pa.RecordBatch:
            rows = [(lang, g, c) for lang, own in counts.items() for g, c in own.items()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))], ["l", "g", "c"])

        for part in (x for batch in batches for x in sized_slices(batch)):
            for lang, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = counts.setdefault(lang, Counter())
                for grams in _grams(t, n):
                    own.update(grams)
            if sum(map(len, counts.values())) > KEPT:
                yield packed()
                counts.clear()
        if any(counts.values()):
            yield packed()

    return count


def detector(ranked: dict[str, list[str]], n: int = 3, size: int = 400, fallback: str | None = None) -> Callable[[Column], Column]:
    """Text column to language column: the profile with the least sum of rank differences; ``fallback`` for texts without letters."""
    languages = sorted(ranked)
    number = {g: i for i, g in enumerate(dict.fromkeys(g for gs in ranked.values() for g in gs))}
    ranks = np.full((len(languages), len(number) + 1), -1)  # the last column: n-grams of no profile
    for i, lang in enumerate(languages):
        for r, g in enumerate(ranked[lang]):
            ranks[i, number[g]] = r
    letters = re.compile(r"[\W\d_]+")

    def one(text: str | None) -> str | None:
        t = " " + letters.sub(" ", (text or "").lower()) + " "
        if not t.strip():
            return fallback
        c: Counter[str] = Counter()
        for grams in _grams(t, n):
            c.update(grams)
        for k in range(1, n + 1):
            c.pop(" " * k, None)
        own = _most_frequent(c, size)
        if not languages:
            return fallback
        found = ranks[:, np.fromiter((number.get(g, -1) for g in own), np.int64, len(own))]
        cost = np.where(found >= 0, np.abs(found - np.arange(len(own))), size).sum(axis=1)
        return languages[int(cost.argmin())]  # of equals the first by name

    @F.pandas_udf("string")
    def detect(texts: pd.Series) -> pd.Series:
        known: dict[str | None, str | None] = {}
        return texts.map(lambda t: known[t] if t in known else known.setdefault(t, one(t)))

    return detect


def _most_frequent(counts: Counter[str], size: int) -> list[str]:
    """The first keys by falling count, then by name. Of the least count among them, which many have, only names are sorted."""
    least = sorted(counts.values(), reverse=True)[size - 1] if len(counts) > size else 1
    first = sorted((-x, g) for g, x in counts.items() if x > least)
    return [g for _, g in first] + sorted(g for g, x in counts.items() if x == least)[: size - len(first)]


def with_fallback(primary: Callable[[str], str], second: Callable[[str], str]) -> Callable[[Column], Column]:
    """Text column to language column: the first detector's answer, the second's where the first raises, and null where both do.

    Rows with null are those that can't be judged; filters drop them.
    """

    def one(text: str | None) -> str | None:
        for detect in (primary, second):
            try:
                return None if text is None else detect(text)
            except Exception:  # a detector of someone else's: whatever it raises means no answer
                continue
        return None

    @F.pandas_udf("string")
    def detect(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return detect
