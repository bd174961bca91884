"""Crawl-index algebra: filters, keep-best, known URLs, ranges, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mime as M
from ..functions import url as U
from .corpus import sized_join


def basic_filter(index: DataFrame) -> DataFrame:
    """Status 200 and not a robots.txt. A status that isn't a number is an error."""
    status = F.when(F.col("status").cast("string").rlike(r"^-?\d+$"), F.col("status").cast("int")).otherwise(F.raise_error(F.concat(F.lit("bad status "), F.coalesce(F.col("status").cast("string"), F.lit("null")))).cast("int"))
    return index.where(~F.col("url").rlike(r"/robots\.txt") & (status == 200))


def mime_filter(index: DataFrame, allowed: DataFrame | list[str]) -> DataFrame:
    """Normalises MIME types and keeps allowed ones (a list, or a table with a column ``mime``)."""
    out = index.withColumn("mime", M.normalize_mime(F.col("mime")))
    return out.where(F.col("mime").isin(*allowed)) if isinstance(allowed, list) else sized_join(out, allowed.select("mime").distinct(), "mime", "left_semi")


def bad_index_filter(index: DataFrame, patterns: list[str]) -> DataFrame:
    """Drops rows whose fields, joined by spaces, one of the patterns matches in full."""
    if not patterns:
        return index
    line = F.concat_ws(" ", *(F.col(c).cast("string") for c in index.columns))
    return index.where(~line.rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$"))


def with_domain(index: DataFrame) -> DataFrame:
    return index.withColumn("domain", U.domain(F.col("url")))


def sort_in_files(index: DataFrame) -> DataFrame:
    """By domain and URL within each partition."""
    return index.sortWithinPartitions("domain", "url")


def by_warc(index: DataFrame) -> DataFrame:
    """By archive file and offset: the order in which pages are fetched."""
    return index.orderBy("warc", F.col("offset").cast("long"), F.col("length").cast("long"))


_BETTER = {"biggest": "length", "latest": "warc"}


def keep_best(index: DataFrame, rule: str = "biggest", key: str = "url", tie: tuple[str, ...] = ("warc", "offset"), by: str | None = None) -> DataFrame:
    """One row for each key: the longest (``biggest``) or the last archive's (``latest``); ties by the least of ``tie``.

    One aggregation: every task keeps, for each key, the least rows of the best value so far, and only those are shuffled.
    A numeric best value is negated, so that the least struct wins; of others each value keeps its row first, and the greatest
    value is taken then.
    """
    best = by or _BETTER[rule]
    rest = [c for c in index.columns if c != key]
    row = F.struct(*rest)
    if dict(index.dtypes)[best] in ("tinyint", "smallint", "int", "bigint", "float", "double") or dict(index.dtypes)[best].startswith("decimal"):
        order = F.struct(F.col(best).isNull(), -F.col(best), *tie)  # rows without a value come last
        return index.groupBy(key).agg(F.min_by(row, order).alias("_row")).select(key, "_row.*").select(*index.columns)
    each = index.groupBy(key, F.col(best).alias("_best")).agg(F.min_by(row, F.struct(*tie)).alias("_row"))
    return each.groupBy(key).agg(F.max_by("_row", F.struct(F.col("_best").isNotNull(), "_best")).alias("_row")).select(key, "_row.*").select(*index.columns)


def keep_winner_rows(index: DataFrame, winners: DataFrame, keys: tuple[str, ...] = ("url", "warc", "offset", "length")) -> DataFrame:
    """Rows equal to a winner, exact repeats too."""
    return index.join(winners.select(*keys).distinct(), list(keys), "left_semi")


def drop_known(index: DataFrame, known: DataFrame, key: str = "url", hashed: bool = False) -> DataFrame:
    """Rows whose URL isn't known. hashed: both sides are compared by 64-bit hash, for long lists of long URLs."""
    if not hashed:
        return sized_join(index, known.select(key).distinct(), key, "left_anti")
    return sized_join(index.withColumn("_h", F.xxhash64(key)), known.select(F.xxhash64(key).alias("_h")).distinct(), "_h", "left_anti").drop("_h")


def first_batches(index: DataFrame, batch: str = "batch", key: str = "url") -> DataFrame:
    """Rows in the first batch that has their URL: the result of removing known URLs batch after batch."""
    first = index.groupBy(key).agg(F.min(batch).alias("_first"))
    return index.join(first, key).where(F.col(batch) == F.col("_first")).drop("_first").select(*index.columns)


def url_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("url").agg(F.count(F.lit(1)).alias("n"))


def shares(index: DataFrame, key) -> DataFrame:
    """``key, n, percent`` by falling n, then key; the percentage has 3 decimals."""
    out = index.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    total = index.agg(F.count(F.lit(1)).alias("_total"))  # one row
    return out.crossJoin(F.broadcast(total)).withColumn("percent", F.round(F.col("n") * 100.0 / F.col("_total"), 3)).drop("_total").orderBy(F.desc("n"), "key")


def statistics(index: DataFrame) -> DataFrame:
    """Documents, total and mean length, distinct archives, documents in each."""
    return index.agg(F.count(F.lit(1)).alias("docs"), F.sum("length").cast("long").alias("total_length"), F.avg("length").alias("mean_length"), F.countDistinct("warc").alias("segments")).withColumn("docs_per_segment", F.col("docs") / F.col("segments"))


def matched_clusters(clusters: DataFrame, query: str) -> DataFrame:
    """Clusters that may hold lines of a domain: those that begin in it, and the last one that begins before its place.

    Clusters are ordered by (surt, path, offset); a cluster holds all lines up to the next one's begin. That one is a
    single row, found by a greatest value that every task forms by itself; a clusters' order isn't needed.
    """
    # the labels, not the string, decide the order: "a,b" and its subdomains come before "a,b-c"
    labels, q = F.split(F.col("surt"), ","), F.split(F.lit(query), ",")
    columns = F.struct(*clusters.columns)
    before = clusters.where(labels < q).agg(F.max_by(columns, F.struct(labels, "path", "offset")).alias("_c")).where("_c is not null").select("_c.*")
    return clusters.where(U.surt_matches(F.col("surt"), query)).unionByName(before)


def merge_ranges(ranges: DataFrame, most: int | None = None, file: str = "file", offset: str = "offset", length: str = "length") -> DataFrame:
    """Adjacent byte ranges of a file become one, of at most ``most`` ranges: ``file, offset, length, n``.

    Gaps and islands: a range that doesn't begin where the one before ended starts an island.
    """
    order = Window.partitionBy(file).orderBy(offset, length)
    gap = (F.coalesce(F.lag(F.col(offset) + F.col(length)).over(order) != F.col(offset), F.lit(True))).cast("int")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    begin = F.max(F.when(F.col("_gap") == 1, F.col("_at"))).over(so_far)  # a range's number in its island, by the same order: no second sort
    out = ranges.withColumns({"_gap": gap, "_at": F.row_number().over(order)})
    out = out.withColumns({"_island": F.sum("_gap").over(so_far), "_begin": begin})
    by = [file, "_island"]
    if most:
        out = out.withColumn("_part", F.floor((F.col("_at") - F.col("_begin")) / most))
        by.append("_part")
    return out.groupBy(*by).agg(F.min(offset).alias("offset"), F.sum(length).cast("long").alias("length"), F.count(F.lit(1)).alias("n")).select(F.col(file).alias("file"), "offset", "length", "n")


def line_filter(lines: DataFrame, surts: list[str], col: str = "line") -> DataFrame:
    """Index lines of the domains: they begin with one of the reversed hosts and then ``,`` or ``)``."""
    either = "|".join(s.replace(".", r"\.") for s in surts)
    return lines.where(F.col(col).rlike(f"^(?:{either})[,)]"))


def join_pages(index: DataFrame, pages: DataFrame, key: str = "url", same: tuple[str, ...] = ()) -> DataFrame:
    """Index rows with their pages, by fully decoded URL; repeated URLs are paired in the order of their positions (``pos``).

    same: columns in which an index row and its page agree too. Where pages are missing, the order alone would give a
    later page of the same URL to the index row of an earlier one. Index rows without a page go; a page without an index row is an error.
    """
    def numbered(df: DataFrame, n: str) -> DataFrame:
        k = F.struct(U.unquote_all(F.col(key)).alias("url"), *same) if same else U.unquote_all(F.col(key))
        return df.withColumn("_key", k).withColumn(n, F.row_number().over(Window.partitionBy("_key").orderBy("pos")))

    left = numbered(index, "_n").drop("pos")
    right = numbered(pages, "_n").drop(key, "pos").withColumn("_page", F.lit(True))
    out = left.withColumn("_row", F.lit(True)).join(right, ["_key", "_n"], "right")
    ok = F.when(F.col("_row"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("page without index row: "), F.col("_key.url" if same else "_key"))).cast("boolean"))
    return out.where(ok).drop("_key", "_n", "_row", "_page")


def corpus_order(docs: DataFrame, url: str = "url", file: str | None = None, pos: str | None = None) -> DataFrame:
    """Sorted by reversed host labels, URL without protocol, file and position."""
    keys = [U.surt_labels(U.host(F.col(url))), U.pure_url(F.col(url)), *(F.col(c) for c in (file, pos) if c)]
    return docs.orderBy(*keys)


def uniq_pure_urls(docs: DataFrame, url: str = "url", order: tuple[str, ...] = ("url",)) -> DataFrame:
    """Of the URLs that differ in protocol only, the first in ``order``, within their host."""
    w = Window.partitionBy(U.host(F.col(url)), U.pure_url(F.col(url))).orderBy(*order)
    return docs.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def order_files(docs: DataFrame, file: str = "file", url: str = "url", pos: str = "pos") -> DataFrame:
    """Files by the host and path of their first document: ``file, first_url, n`` (n from 1)."""
    first = docs.groupBy(file).agg(F.min_by(url, pos).alias("first_url"))
    order = Window.partitionBy(F.lit(0)).orderBy(U.host(F.col("first_url")), U.path(F.col("first_url")), file)  # one row for each file
    return first.withColumn("n", F.row_number().over(order))
