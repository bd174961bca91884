"""Paragraphs that recur in the documents of a domain: decayed counts, selection, removal."""

from __future__ import annotations

import ast
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import stored
from . import dedup


def keep_for(k: float) -> float:
    """Decay with which a paragraph seen once falls below 1/2 after k - 1/2 documents."""
    return 0.5 ** (1 / (k - 0.5))


def positions(docs: DataFrame, domain: str = "domain", order: tuple[str, ...] = ("id",), pars: str = "paragraphs") -> DataFrame:
    """``domain, n_docs, t, p`` with the document's number in its domain from 1; each paragraph once a document.

    The windows number keys only; the text is joined back by key, which isn't skewed, and isn't part of the sort.
    """
    keys = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    names = [f"_o{i}" for i in range(len(order))]
    numbers = docs.select(F.col(domain).alias("domain"), *keys).distinct()
    numbers = numbers.withColumn("t", F.row_number().over(Window.partitionBy("domain").orderBy(*names)).cast("long"))
    sizes = numbers.groupBy("domain").agg(F.count(F.lit(1)).alias("n_docs"))
    text = docs.select(F.col(domain).alias("domain"), *keys, F.array_distinct(pars).alias("_p"))
    return numbers.join(sizes, "domain").join(text, ["domain", *names]).select("domain", "n_docs", "t", F.explode("_p").alias("p"))


def collect(docs: DataFrame, decay: float = 0.99, evict_below: float = 0.5, min_freq: int = 2, domain: str = "domain", order: tuple[str, ...] = ("id",), pars: str = "paragraphs", seeds: DataFrame | None = None, similar: tuple[int, int, int] | None = None) -> DataFrame:
    """Frequent paragraphs of each domain: ``domain, p, score, count, n_docs``.

    Scores fall by ``decay`` with each document of the domain, and a document with the paragraph adds 1 to score
    and count. A paragraph whose score is below ``evict_below`` after a document is forgotten and starts
    anew with 1 and 1. At the end those with ``count >= min_freq`` stay. Between its documents a paragraph's
    score only falls, so a fold over its sorted positions gives the same as going through the documents.

    seeds: scores and counts (``domain, p, score, count``) at the start, as if of a document 0.

    similar (permutations, bands, rows): near duplicates count as one paragraph, the first of them; see :func:`representatives`.
    """
    at = positions(docs, domain, order, pars)
    if similar:
        reps = representatives(at.groupBy("domain", "p").agg(F.min("t").alias("t")), *similar)
        at = at.join(reps, ["domain", "p"]).select("domain", "n_docs", "t", F.col("rep").alias("p")).distinct()
    seen = at.groupBy("domain", "p").agg(F.array_sort(F.collect_list("t")).alias("ts"), F.max("n_docs").alias("n_docs"))
    if seeds is None:
        seen = seen.withColumn("_s", F.lit(0.0)).withColumn("_c", F.lit(0).cast("long"))
    else:
        sizes = at.select("domain", "n_docs").distinct()
        old = seeds.select("domain", "p", F.col("score").cast("double").alias("_s"), F.col("count").cast("long").alias("_c"))
        seen = seen.join(old, ["domain", "p"], "full_outer").drop("n_docs").join(sizes, "domain", "left").select("domain", "p", F.coalesce("ts", F.array().cast("array<bigint>")).alias("ts"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("_s", F.lit(0.0)).alias("_s"), F.coalesce("_c", F.lit(0)).alias("_c"))
    d = F.lit(float(decay))

    def step(s, t):
        gap = (t - s["prev"]).cast("double")
        gone = (s["count"] == 0) | ((gap >= 2) & (s["score"] * F.pow(d, gap - 1) < evict_below))
        return F.struct(t.alias("prev"), F.when(gone, F.lit(1.0)).otherwise(s["score"] * F.pow(d, gap) + 1).alias("score"), F.when(gone, F.lit(1)).otherwise(s["count"] + 1).cast("long").alias("count"))

    start = F.struct(F.lit(0).cast("long").alias("prev"), F.col("_s").alias("score"), F.col("_c").alias("count"))
    out = seen.withColumn("s", F.aggregate("ts", start, step))
    left = (F.col("n_docs") - F.col("s.prev")).cast("double")
    score = F.col("s.score") * F.pow(d, left)
    alive = (left == 0) | (score >= evict_below)
    return out.where(alive & (F.col("s.count") >= min_freq)).select("domain", "p", score.alias("score"), F.col("s.count").alias("count"), "n_docs")


_FUNCTIONS = {"abs": F.abs, "min": F.least, "max": F.greatest, "round": F.round, "pow": F.pow, "len": F.length, "int": lambda c: c.cast("long"), "float": lambda c: c.cast("double"), "bool": lambda c: c.cast("boolean"), "str": lambda c: c.cast("string")}
_BINARY = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.Mod: operator.mod, ast.Pow: F.pow, ast.FloorDiv: lambda a, b: F.floor(a / b)}
_COMPARE = {ast.Lt: operator.lt, ast.LtE: operator.le, ast.Gt: operator.gt, ast.GtE: operator.ge, ast.Eq: operator.eq, ast.NotEq: operator.ne}


def predicate(expression: str, names: list[str]) -> Column:
    """A column from an expression over named variables: comparisons, arithmetic, and, or, not, constants and a few functions.

    Anything else, as an unknown name, attribute or function, is an error: an expression from a configuration can't do more.
    """

    def walk(e: ast.expr) -> Column:
        match e:
            case ast.Constant(value=v) if isinstance(v, (int, float, str, bool)):
                return F.lit(v)
            case ast.Name(id=n) if n in names:
                return F.col(f"`{n}`")
            case ast.BoolOp(op=op, values=vs):
                return reduce(operator.and_ if isinstance(op, ast.And) else operator.or_, map(walk, vs))
            case ast.UnaryOp(op=ast.Not(), operand=x):
                return ~walk(x)
            case ast.UnaryOp(op=ast.USub(), operand=x):
                return -walk(x)
            case ast.BinOp(left=a, op=op, right=b) if type(op) in _BINARY:
                return _BINARY[type(op)](walk(a), walk(b))
            case ast.Compare(left=a, ops=ops, comparators=cs) if all(type(o) in _COMPARE for o in ops):
                sides = [walk(x) for x in (a, *cs)]
                return reduce(operator.and_, [_COMPARE[type(o)](x, y) for o, x, y in zip(ops, sides, sides[1:])])
            case ast.Call(func=ast.Name(id=f), args=args, keywords=[]) if f in _FUNCTIONS:
                return _FUNCTIONS[f](*(x.value if f == "round" and i and isinstance(x, ast.Constant) else walk(x) for i, x in enumerate(args)))
        raise ValueError(f"not allowed in {expression!r}: {ast.unparse(e)}")

    return walk(ast.parse(expression, mode="eval").body)


def select(stats: DataFrame, *expressions: str) -> DataFrame:
    """Rows for which all expressions over ``score, count, n_docs`` and other columns hold; see :func:`predicate`."""
    return stats.where(reduce(operator.and_, [predicate(e, stats.columns) for e in expressions], F.lit(True)))


def merge(parts: list[DataFrame], where: str | None = None, domains: int | None = None) -> DataFrame:
    """Union of statistics of several runs, with an optional predicate; ``domains``: only the first so many by name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if where:
        out = select(out, where)
    if domains is not None:
        out = out.join(F.broadcast(out.select("domain").distinct().orderBy("domain").limit(domains)), "domain", "left_semi")
    return out


def remove(docs: DataFrame, new: DataFrame, old: DataFrame | None = None, min_freq: int = 2, domain: str = "domain", id_col: str = "id", order: tuple[str, ...] = ("id",), pars: str = "paragraphs", similar: tuple[int, int, int] | None = None) -> DataFrame:
    """Documents without frequent paragraphs; those left empty go.

    Of ``new`` (``domain, p``) the occurrences in the domain's first ``min_freq - 1`` documents stay, of ``old`` none.
    Only ids, paragraph numbers and paragraphs that are looked up are shuffled with the lists. similar (permutations, bands, rows):
    near duplicates of a listed paragraph count as it; of several the first by name, of those on both lists the old one.
    """
    w = Window.partitionBy("domain", "p").orderBy(*order)
    rows = docs.select(F.col(domain).alias("domain"), *{id_col, *order}, F.posexplode(pars).alias("i", "p"))
    keys = new.select("domain", "p").distinct().withColumn("_new", F.lit(True))
    if old is not None:
        keys = keys.join(old.select("domain", "p").distinct().withColumn("_old", F.lit(True)), ["domain", "p"], "full_outer")
    else:
        keys = keys.withColumn("_old", F.lit(False))
    if similar:
        keys = stored(keys, "listed")  # the lists may be long in the making, and are used three times
        rows = rows.join(listed(rows.select("domain", "p").distinct(), keys.select("domain", "p", F.coalesce("_old", F.lit(False)).alias("_old")), *similar), ["domain", "p"]).withColumn("p", F.col("_listed")).drop("_listed")
    hits = rows.join(keys, ["domain", "p"]).withColumn("_r", F.dense_rank().over(w))
    drop = hits.where(F.coalesce("_old", F.lit(False)) | (F.col("_r") >= min_freq)).groupBy(id_col).agg(F.collect_set("i").alias("_drop"))
    left = F.filter(pars, lambda _, i: ~F.array_contains(F.coalesce("_drop", F.array().cast("array<int>")), i))
    return docs.join(drop, id_col, "left").withColumn(pars, left).drop("_drop").where(F.size(pars) > 0)


def _banded(paragraphs: DataFrame, keys: list[str], perms: int, b: int, r: int) -> DataFrame:
    """keys and a hash ``g`` of domain and band for each band; a paragraph without n-grams is like its equals only."""
    sigs = dedup.signatures(paragraphs, keys, "p", perms) if "p" not in keys else dedup.signatures(paragraphs.withColumn("_t", F.col("p")), keys, "_t", perms)
    own = dedup.hashed(sigs.where(F.get("sig", F.lit(0)) != dedup.NO_SHINGLE), keys, b, r)
    return own.select(*keys, F.explode("_g").alias("g")).withColumn("g", F.xxhash64("domain", "g"))


def representatives(paragraphs: DataFrame, perms: int, b: int, r: int) -> DataFrame:
    """``domain, p, rep`` for distinct paragraphs with the document that has them first (``domain, p, t``).

    Keep-first in the order of documents (within one, of hashes): a paragraph whose band a kept one of its domain has is
    represented by the least such one, others by themselves. Hashes stand for paragraphs while bands move.
    """
    own = stored(paragraphs.withColumn("h", F.xxhash64("domain", "p")), "paragraphs")  # read three times
    banded = _banded(own, ["domain", "t", "h"], perms, b, r).select(F.struct("t", "h").alias("id"), "g")
    gone = dedup.keep_first(banded).select(F.col("n.h").alias("h"), F.col("rep.h").alias("_r"))
    reps = gone.join(own.select(F.col("h").alias("_r"), F.col("p").alias("rep")), "_r").select("h", "rep")
    return own.join(reps, "h", "left").select("domain", "p", F.coalesce("rep", "p").alias("rep"))


def listed(paragraphs: DataFrame, entries: DataFrame, perms: int, b: int, r: int) -> DataFrame:
    """``domain, p, _listed``: for distinct paragraphs the entry (``domain, p, _old``) that they equal or are near duplicates of, if any."""
    mine = _banded(paragraphs, ["domain", "p"], perms, b, r)
    theirs = _banded(entries, ["domain", "p", "_old"], perms, b, r).select("g", F.struct((~F.col("_old")).alias("new"), F.col("p").alias("entry")).alias("_e"))
    near = mine.join(theirs.groupBy("g").agg(F.min("_e").alias("_e")), "g").select("domain", "p", "_e")  # of a band the first entry
    equal = paragraphs.join(entries, ["domain", "p"]).select("domain", "p", F.struct((~F.col("_old")).alias("new"), F.col("p").alias("entry")).alias("_e"))
    return near.unionByName(equal).groupBy("domain", "p").agg(F.min("_e").alias("_e")).select("domain", "p", F.col("_e.entry").alias("_listed"))
