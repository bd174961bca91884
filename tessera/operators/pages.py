"""From archive records to pages and documents: downloads, audits, exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mime as M
from .corpus import http_metadata, sized_join
from .sampling import rotate


def archive_counts(records: DataFrame) -> DataFrame:
    """``docs, characters``: records and the bytes of their contents."""
    return records.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).cast("long").alias("characters"))


def filter_archive(records: DataFrame, deny: DataFrame | None = None, allow: DataFrame | None = None, kinds: tuple[str, ...] = ("html", "txt"), body: str = "body") -> DataFrame:
    """Records not on the list to drop, on the list to keep, and of a kind by their first characters; adds ``kind``."""
    out = records
    for urls, how in ((deny, "left_anti"), (allow, "left_semi")):
        if urls is not None:
            out = sized_join(out, urls.select("url").distinct(), "url", how)
    return out.withColumn("kind", M.sniff(F.col(body).cast("string"))).where(F.col("kind").isin(*kinds))


def kind_counts(records: DataFrame, body: str = "body") -> DataFrame:
    """Records by kind: ``kind, n``; ``none`` for what is neither HTML nor text."""
    return records.groupBy(F.coalesce(M.sniff(F.col(body).cast("string")), F.lit("none")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def content_type_audit(records: DataFrame, tag_mime: str = "mime") -> DataFrame:
    """Adds ``tag_type, identified_type, response_type, extension``: what the index, the archive, the response and an attachment's name say; ``-`` for nothing."""
    said = lambda c: F.coalesce(F.when(c != "", c), F.lit("-"))
    return records.withColumns({"tag_type": said(F.col(tag_mime)), "identified_type": said(F.col("identified")), "response_type": said(M.content_type(F.lit(None).cast("string"), F.col("http_header"))), "extension": F.coalesce(M.attachment_extension(F.col("http_header")), F.lit("-"))})


def output_documents(index: DataFrame, paragraphs: DataFrame, request: str | None = None, response: str | None = None, key: str = "url", same: tuple[str, ...] = ()) -> DataFrame:
    """Documents from index rows and the paragraphs of their pages: the URL is the id, other index fields are attributes.

    same: columns in which an index row and its page's paragraphs agree too, for URLs that come more than once; they are no attributes.
    request, response: columns with the headers, kept as HTTP metadata; date and content type of the response become
    attributes too. Index rows whose page has no paragraph left go.
    """
    rest = [c for c in index.columns if c not in (key, request, response, *same)]
    meta = F.map_from_arrays(F.array(*map(F.lit, rest)), F.array(*(F.col(c).cast("string") for c in rest))) if rest else F.create_map().cast("map<string,string>")
    http = [(n, c) for n, c in (("request", request), ("response", response)) if c]
    headers = F.map_from_arrays(F.array(*(F.lit(n) for n, _ in http)), F.array(*(F.trim(F.col(c)) for _, c in http))) if http else F.lit(None).cast("map<string,string>")
    docs = index.join(paragraphs.select(key, *same, "paragraphs"), [key, *same]).where(F.size("paragraphs") > 0)
    docs = docs.select(F.col(key).alias("id"), F.map_filter(meta, lambda _, v: v.isNotNull()).alias("meta"), headers.alias("http_meta"), "paragraphs")
    return http_metadata(docs) if response else docs


def download(index: DataFrame, fetch: Callable[[str, int, int], bytes | None], tasks: int | None = None, most_bytes: int = 99_000_000) -> tuple[DataFrame, DataFrame]:
    """Fetches the pages of an index, in the order of archives and offsets, and numbers the files of ``data`` for each task.

    Returns the rows with ``data`` (compressed records), ``part`` and ``file_no`` (files of at most ``most_bytes``), and those that
    couldn't be had. To be written with :func:`write_rotated`.
    """
    from ..sources.crawl import fetch_ranges
    from ..sources.storage import stored

    got = stored(fetch_ranges(index, fetch, tasks).withColumn("part", F.spark_partition_id()), "download")
    there = got.where("data is not null")
    return rotate(there, most_bytes, F.octet_length("data"), ["warc", "offset"], ["part"], first=0), got.where("data is null").drop("data", "part")


def write_rotated(rows: DataFrame, folder: str, name: str = "pages", extension: str = "warc.gz", data: str = "data", order: tuple[str, ...] = ("warc", "offset"), digits: int = 2) -> DataFrame:
    """Writes each (part, file_no) as one file ``name_part_no.extension`` of the rows' data, one after the other, and returns ``file, n, bytes``.

    Data goes to the file as it streams by, in the order of ``order``; a file is written under another name first, so that a
    repeated task replaces it. Empty files aren't made.
    """
    import pandas as pd

    from ..sources.storage import open_output, rename_output

    def write(frames):
        key, out, n, size, path = None, None, 0, 0, ""

        def close():
            out.close()
            rename_output(path + ".part", path)
            return pd.DataFrame({"file": [path], "n": [n], "bytes": [size]})

        for f in frames:
            for part, number, d in zip(f["part"], f["file_no"], f["data"]):
                if (part, number) != key:
                    if out is not None:
                        yield close()
                    key, n, size, path = (part, number), 0, 0, f"{folder.rstrip('/')}/{name}_{part:03d}_{number:0{digits}d}.{extension}"
                    out = open_output(path + ".part")
                out.write(bytes(d))
                n, size = n + 1, size + len(d)
        if out is not None:
            yield close()

    placed = rows.repartition("part", "file_no").sortWithinPartitions("part", "file_no", *order).select("part", "file_no", F.col(data).alias("data"))
    return placed.mapInPandas(write, "file string, n long, bytes long")


def page_files(records: DataFrame, most: int | None = None, digits: int = 3, body: str = "body") -> DataFrame:
    """Pages to be exported as files: ``name, url, html``. Each archive's first ``most`` usable pages, named by archive and record number."""
    stem = F.regexp_replace("file", r"^.*/|\.[^./]*$", "")
    out = records.withColumn("html", M.normalize_page(F.col(body).cast("string"))).where("html is not null")
    if most is not None:
        out = out.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy("pos"))).where(F.col("_n") <= most)
    return out.select(F.concat(stem, F.lit("_"), F.lpad((F.col("pos") + 1).cast("string"), digits, "0"), F.lit(".html")).alias("name"), "url", "html")


def write_page_files(pages: DataFrame, folder: str) -> DataFrame:
    """One file for each row of ``name, url, html``; returns the mapping ``name, url``."""
    import pandas as pd

    from ..sources.storage import open_output

    def write(frames):
        for f in frames:
            for name, html in zip(f["name"], f["html"]):
                with open_output(f"{folder.rstrip('/')}/{name}") as out:
                    out.write(html.encode())
            yield pd.DataFrame({"name": f["name"], "url": f["url"]})

    return pages.select("name", "url", "html").mapInPandas(write, "name string, url string")


def pages_of(records: DataFrame, urls: DataFrame) -> DataFrame:
    """Records of the given URLs with a file ``name``: the URL with underscores for slashes, without those at its end."""
    found = sized_join(records, urls.select("url").distinct(), "url", "left_semi")
    return found.withColumn("name", F.replace(F.regexp_replace("url", "/+$", ""), F.lit("/"), F.lit("_")))


def emptied_urls(log: DataFrame, is_start, is_end, by: str = "pid", order: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """``url``: pages of which boilerplate removal left nothing, from the messages between an archive's start and end lines."""
    from .logs import sessions

    own = sessions(log, is_start, is_end, by, order).where("session is not null")
    url = F.regexp_extract("message", r"^Nothing's left of (\S+) after", 1)
    return own.select(url.alias("url")).where("url <> ''").distinct()


def kept_urls(index: DataFrame, path: str) -> None:
    """Adds the URLs of kept records to a list, one a line."""
    index.select("url").write.mode("append").text(path)
