"""Counting, filtering and cleaning documents (``id``, ``paragraphs`` and any other columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def sized_join(left: DataFrame, right: DataFrame, on, how: str, most_bytes: int = 32 << 20) -> DataFrame:
    """A join with a list: it is broadcast if its values have at most ``most_bytes`` as text, else both sides are shuffled."""
    size = right.agg(F.sum(F.octet_length(F.concat_ws("", *(F.col(c).cast("string") for c in right.columns))) + 16)).first()[0] or 0
    return left.join(F.broadcast(right) if size <= most_bytes else right, on, how)


def explode_paragraphs(docs: DataFrame, pars: str = "paragraphs") -> DataFrame:
    """A row for each paragraph with its number from 1 (``p_no``, ``p``)."""
    rest = [c for c in docs.columns if c != pars]
    return docs.select(*rest, F.posexplode(pars).alias("p_no", "p")).withColumn("p_no", F.col("p_no") + 1)


def counts(docs: DataFrame, by: list[str] | None = None, pars: str = "paragraphs") -> DataFrame:
    """Documents, paragraphs, words and characters, of all or by group; sums of partial sums."""
    p = F.col(pars)
    big = lambda c, name: F.coalesce(F.sum(c.cast("long")), F.lit(0)).cast("long").alias(name)
    return docs.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("docs"), big(F.size(p), "paragraphs"), big(T.words_of(p), "words"), big(T.chars_of(p), "characters"))


def filter_length(docs: DataFrame, least: str, pars: str = "paragraphs") -> DataFrame:
    """Keeps documents of at least so many characters (``500c``) or words (``100w``)."""
    n, unit = least[:-1], least[-1:]
    if unit not in ("c", "w") or not n.isdigit():
        raise ValueError(f"a length is a number with c or w, not {least!r}")
    return docs.where((T.chars_of if unit == "c" else T.words_of)(F.col(pars)) >= int(n))


def filter_languages(docs: DataFrame, languages: list[str], detect, pars: str = "paragraphs") -> DataFrame:
    """Keeps documents in one of the languages. detect: text column to language column."""
    return docs.where(detect(T.content(F.col(pars))).isin(*languages))


def filter_paragraph_languages(docs: DataFrame, languages: list[str], detect, id_col: str = "id", pars: str = "paragraphs") -> DataFrame:
    """Keeps the paragraphs in one of the languages, and documents that have any left."""
    own = docs.select(F.col(id_col), F.posexplode(pars).alias("i", "p"))
    kept = own.where(detect(F.col("p")).isin(*languages)).groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("i", "p"))).alias("_k"))
    return docs.join(kept, id_col).withColumn(pars, F.col("_k.p")).drop("_k")


def drop_urls(docs: DataFrame, urls: DataFrame, id_col: str = "id", url_col: str = "url") -> DataFrame:
    """Documents that aren't on the list."""
    return sized_join(docs, urls.select(F.col(url_col).alias("_u")).distinct(), F.col(id_col) == F.col("_u"), "left_anti")


def keep_urls(docs: DataFrame, urls: DataFrame, id_col: str = "id", url_col: str = "url") -> DataFrame:
    """Documents on the list."""
    return sized_join(docs, urls.select(F.col(url_col).alias("_u")).distinct(), F.col(id_col) == F.col("_u"), "left_semi")


def filter_chain_counts(docs: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """How many documents pass each of the filters applied one after the other: ``stage, n_stage, kept``. One pass over the data."""
    passed, sums = F.lit(True), [F.count(F.lit(1)).alias("_0")]
    for i, (_, keep) in enumerate(stages, 1):
        passed = passed & F.coalesce(keep, F.lit(False))
        sums.append(F.coalesce(F.sum(passed.cast("long")), F.lit(0)).cast("long").alias(f"_{i}"))
    rows = [F.struct(F.lit(i).alias("n_stage"), F.lit(name).alias("stage"), F.col(f"_{i}").alias("kept")) for i, name in enumerate(["read", *(n for n, _ in stages)])]
    return docs.agg(*sums).select(F.inline(F.array(*rows)))


def remove_repeats(docs: DataFrame, pars: str = "paragraphs", least: int = 1) -> DataFrame:
    """Removes a document's paragraphs that it had before; those shorter than ``least`` characters stay."""
    p = F.col(pars)
    if least <= 1:
        return docs.withColumn(pars, F.array_distinct(p))
    first = F.filter(p, lambda x, i: (F.length(x) < least) | (F.array_position(p, x) == i + 1))
    return docs.withColumn(pars, first)


def repeat_statistics(docs: DataFrame, domain: str, id_col: str = "id", pars: str = "paragraphs", least: int = 1) -> DataFrame:
    """By domain with repeats: ``docs, paragraphs, affected_docs, repeated, surplus``.

    repeated: distinct paragraphs that occur again in their document, surplus: copies beyond the first.
    Everything but the last sum is local to a document, so it needs no shuffle of paragraphs.
    """
    p = F.filter(F.col(pars), lambda x: F.length(x) >= least)
    hashes = F.array_sort(F.transform(p, lambda x: F.xxhash64(x)))  # in order, equal ones are neighbours
    again = F.zip_with(F.slice(hashes, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(hashes, 1, F.greatest(F.size(p) - 1, F.lit(0))), lambda x, y: x == y)
    surplus = F.size(F.filter(again, lambda x: x))
    repeated = F.size(F.filter(again, lambda x, i: x & ((i == 0) | ~F.coalesce(F.get(again, i - 1), F.lit(False)))))
    per = docs.select(F.col(domain).alias("domain"), F.size(pars).alias("n"), surplus.alias("s"), F.when(surplus > 0, repeated).otherwise(0).alias("r"))
    out = per.groupBy("domain").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").cast("long").alias("paragraphs"), F.sum((F.col("s") > 0).cast("long")).alias("affected_docs"), F.sum("r").cast("long").alias("repeated"), F.sum("s").cast("long").alias("surplus"))
    return out.where("affected_docs > 0")


def clean(docs: DataFrame, patterns: list[str] = (), allowed: list[str] = (), escape: bool = False, pars: str = "paragraphs") -> DataFrame:
    """Pattern filter, token cleaning and escaping of paragraphs; empty ones go, and documents without any."""
    p = T.without_patterns(F.col(pars), list(patterns))
    p = F.transform(p, lambda x: T.clean_tokens(x, tuple(allowed)))
    if escape:
        p = F.transform(p, T.escape_xml)
    return docs.withColumn(pars, F.filter(p, lambda x: F.trim(x) != "")).where(F.size(pars) > 0)


def attributes(docs: DataFrame, names: list[str]) -> DataFrame:
    """Chosen attributes; ``url`` is the id, others are metadata (null if missing)."""
    return docs.select(*(F.col("id").alias(n) if n in ("url", "id") else F.col("meta").getItem(n).alias(n) for n in names))


def http_metadata(docs: DataFrame) -> DataFrame:
    """Date and content type of the response as metadata."""
    from ..functions.mime import header

    response = F.col("http_meta").getItem("response")
    new = F.create_map(F.lit("date"), header(response, "Date"), F.lit("content-type"), header(response, "Content-Type"))
    return docs.withColumn("meta", F.map_concat(F.coalesce("meta", F.create_map().cast("map<string,string>")), F.map_filter(new, lambda _, v: v.isNotNull())))


def select_parts(docs: DataFrame, attrs: bool = True, meta: list[str] | bool = True, content: bool = True) -> DataFrame:
    """Chosen parts of documents; meta may list fields."""
    out = docs
    if not attrs:
        out = out.withColumn("http_meta", F.lit(None).cast("map<string,string>"))
    if meta is False:
        out = out.withColumn("meta", F.lit(None).cast("map<string,string>"))
    elif meta is not True:
        out = out.withColumn("meta", F.map_filter("meta", lambda k, _: k.isin(*meta)))
    return out if content else out.withColumn("paragraphs", F.array().cast("array<string>"))


def serialized_size(docs: DataFrame) -> DataFrame:
    """Adds ``bytes``: the size of the document in the tagged format."""
    from ..sources.documents import to_tagged_rows

    return to_tagged_rows(docs, *docs.columns).withColumn("bytes", F.octet_length("value") + 1).drop("value")


def documents_at(docs: DataFrame, places: DataFrame, keys: tuple[str, ...] = ("file", "pos")) -> DataFrame:
    """The documents at given places (file and position in it), in the order of places; a place without document is an error."""
    found = places.select(*keys).distinct().join(docs.withColumn("_found", F.lit(True)), list(keys), "left")
    ok = F.when(F.col("_found"), F.lit(True)).otherwise(F.raise_error(F.concat_ws(":", F.lit("no document at "), *(F.col(k).cast("string") for k in keys))).cast("boolean"))
    return found.where(ok).drop("_found").sortWithinPartitions(*keys)


def top_tokens(tokens: DataFrame, n: int = 50_000, col: str = "token", lower: bool = False) -> DataFrame:
    """The n most frequent tokens; ties by token."""
    t = F.lower(col) if lower else F.col(col)
    return tokens.select(t.alias("token")).where("token is not null and token <> ''").groupBy("token").agg(F.count(F.lit(1)).alias("freq")).orderBy(F.desc("freq"), "token").limit(n)
