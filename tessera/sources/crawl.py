"""Crawl data: index lines, cluster indexes, byte ranges, archive records, lists."""

from __future__ import annotations

import gzip
import json
import time
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import CLUSTER, INDEX


def parse_index(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Raw index lines (reversed host, time, JSON) in columns, and the lines that aren't such.

    A missing status is 0 and a missing type unknown/unknown; a line without one of the other fields is rejected.
    """
    part = F.split(col, " ", 3)
    j = F.from_json(F.get(part, F.lit(2)), "url string, filename string, offset string, length string, status string, mime string")
    rows = lines.select("*", F.get(part, F.lit(0)).alias("surt"), F.get(part, F.lit(1)).alias("timestamp"), j.alias("_j"))
    ok = F.coalesce(F.col("_j.url").isNotNull() & F.col("_j.filename").isNotNull() & F.col("_j.offset").rlike(r"^\d+$") & F.col("_j.length").rlike(r"^\d+$"), F.lit(False))
    good = rows.where(ok).select(
        "surt", "timestamp", F.col("_j.url").alias("url"), F.col("_j.filename").alias("warc"), F.col("_j.offset").cast("long").alias("offset"), F.col("_j.length").cast("long").alias("length"), F.coalesce("_j.status", F.lit("0")).alias("status"), F.coalesce("_j.mime", F.lit("unknown/unknown")).alias("mime")
    )
    return good, rows.where(~ok).select(col)


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_index(spark.read.text(path))


def project_json(line, fields: list[str]):
    """An index line with chosen fields of its JSON part only."""
    part = F.split(line, " ", 3)
    kept = F.map_filter(F.from_json(F.get(part, F.lit(2)), "map<string,string>"), lambda k, _: k.isin(*fields))
    return F.concat_ws(" ", F.get(part, F.lit(0)), F.get(part, F.lit(1)), F.to_json(kept))


def parse_filtered(lines: DataFrame, col: str = "value") -> DataFrame:
    """Filtered index lines; the leading domain may be missing."""
    f = F.split(col, " ")
    six = F.slice(f, F.greatest(F.least(F.size(f), F.lit(7)) - 5, F.lit(1)), F.lit(6))
    domain = F.when(F.size(f) >= 7, F.get(f, F.lit(0)))
    at = lambda i: F.get(six, F.lit(i))
    return lines.select(domain.alias("domain"), at(0).alias("url"), at(1).alias("warc"), at(2).cast("long").alias("offset"), at(3).cast("long").alias("length"), at(4).cast("int").alias("status"), at(5).alias("mime"))


def read_filtered(spark: SparkSession, path: str) -> DataFrame:
    return parse_filtered(spark.read.text(path))


def write_index(index: DataFrame, path: str, compression: str = "gzip") -> None:
    columns = [c.split()[0] for c in INDEX.split(", ")]
    index.select(F.concat_ws(" ", *(F.col(c).cast("string") for c in columns)).alias("value")).write.option("compression", compression).text(path)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """The cluster index: ``surt(domain)/path``, file, offset and length, separated by tabs."""
    f = F.split("value", "\t")
    head = F.split(F.regexp_replace(F.get(f, F.lit(0)), r" .*$", ""), r"\)", 2)
    return spark.read.text(path).where("value <> ''").select(F.get(head, F.lit(0)).alias("surt"), F.get(head, F.lit(1)).alias("path"), F.get(f, F.lit(1)).alias("file"), F.get(f, F.lit(2)).cast("long").alias("offset"), F.get(f, F.lit(3)).cast("long").alias("length")).to(_schema(CLUSTER))


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def inflate(data: bytes) -> Iterator[str]:
    """Lines of one or more gzip or zlib members, one after the other."""
    rest, text = data, b""
    while rest:
        d = zlib.decompressobj(zlib.MAX_WBITS | 32)
        text += d.decompress(rest) + d.flush()
        rest = d.unused_data
    for line in text.decode("utf-8", "replace").splitlines():
        if line:
            yield line


def file_ranges(root: str) -> Callable[[str, int, int], bytes | None]:
    """A fetcher that reads from files below a folder: for tests, and for mirrors."""

    def fetch(name: str, offset: int, length: int) -> bytes | None:
        try:
            with open(f"{root.rstrip('/')}/{name}", "rb") as f:
                f.seek(offset)
                return f.read(length)
        except FileNotFoundError:
            return None

    return fetch


def http_ranges(base: str, retries: int = 5, delay: float = 1.0, opener: Callable | None = None, sleep: Callable[[float], None] = time.sleep) -> Callable[[str, int, int], bytes | None]:
    """A fetcher of HTTP byte ranges (from offset to offset + length - 1).

    404 gives null; a whole answer (200) or an error is tried again after a delay that grows by its first value; with no tries left it raises.
    """
    from urllib.error import HTTPError, URLError
    from urllib.request import Request, urlopen

    def fetch(name: str, offset: int, length: int) -> bytes | None:
        why = ""
        for attempt in range(retries + 1):
            try:
                with (opener or urlopen)(Request(f"{base.rstrip('/')}/{name}", headers={"Range": f"bytes={offset}-{offset + length - 1}"})) as answer:
                    if answer.status == 206:
                        return answer.read()
                    why = f"status {answer.status}"
            except HTTPError as e:
                if e.code == 404:
                    return None
                why = str(e)
            except URLError as e:
                why = str(e)
            if attempt < retries:
                sleep(delay * (attempt + 1))
        raise OSError(f"{name} at {offset}: {why}")

    return fetch


def fetch_ranges(ranges: DataFrame, fetch: Callable[[str, int, int], bytes | None], tasks: int | None = None, file: str = "warc") -> DataFrame:
    """Adds ``data``, the bytes of each range (null if the file is missing). Each task reads neighbouring ranges in order."""
    placed = ranges.repartitionByRange(*([tasks] if tasks else []), file, "offset").sortWithinPartitions(file, "offset")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(data=[fetch(w, int(o), int(n)) for w, o, n in zip(f[file], f["offset"], f["length"])])

    return placed.mapInPandas(read, f"{_ddl(ranges)}, data binary")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def range_lines(fetched: DataFrame) -> DataFrame:
    """A row ``value`` for each line of fetched index ranges."""

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for data in f["data"]:
                if data is not None:
                    yield pd.DataFrame({"value": list(inflate(data))})

    return fetched.select("data").mapInPandas(lines, "value string")


def index_lines(clusters: DataFrame, patterns: list[str], fetch: Callable[[str, int, int], bytes | None], fields: list[str], most: int = 100) -> DataFrame:
    """Index lines of domains (``a.b`` or ``*.a.b``): matching clusters, merged ranges, their lines, and those of the domains."""
    from functools import reduce

    from ..operators.index import line_filter, matched_clusters, merge_ranges

    surts = [",".join(reversed([x for i, x in enumerate(p.split(".")) if not (i == 0 and (x == "*" or x in ("www", *(f"www{d}" for d in range(1, 10)))))])) for p in patterns]
    found = reduce(lambda a, b: a.unionByName(b), [matched_clusters(clusters, s) for s in surts]).distinct()
    lines = range_lines(fetch_ranges(merge_ranges(found, most), fetch, file="file"))
    return line_filter(lines, surts, "value").distinct().select(project_json(F.col("value"), fields).alias("value"))


def warc_records(data: bytes) -> Iterator[tuple[str | None, str | None, dict[str, str], bytes, bytes]]:
    """(type, target URI, headers, HTTP header, body) of the records of an archive file, compressed as a whole, by record or not at all."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])}
        n = int(head.get("content-length", 0))
        block = data[end + 4 : end + 4 + n]
        http, sep, body = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
        yield head.get("warc-type"), head.get("warc-target-uri"), head, http, body
        at = end + 4 + n


def parse_warcs(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Records of archive files (binary column): ``file, pos, type, url, identified, http_header, body``."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, data in zip(f[path], f[content]):
                rows = [(name, i, t, u, h.get("warc-identified-payload-type"), http.decode("utf-8", "replace"), body) for i, (t, u, h, http, body) in enumerate(warc_records(bytes(data)))]
                yield pd.DataFrame(rows, columns=["file", "pos", "type", "url", "identified", "http_header", "body"])

    return files.select(path, content).mapInPandas(parse, "file string, pos long, type string, url string, identified string, http_header string, body binary")


def read_warcs(spark: SparkSession, path: str, glob: str = "*.warc*") -> DataFrame:
    return parse_warcs(spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path))


def decode_body(body, http_header):
    """Text of a body in the character set of its header, UTF-8 without one; signs that aren't valid are replaced."""

    @F.pandas_udf("string")
    def decode(bodies: pd.Series, headers: pd.Series) -> pd.Series:
        import re

        def one(b, h):
            if b is None:
                return None
            m = re.search(r"(?im)^content-type:.*?charset=[\"']?([\w-]+)", h or "")
            try:
                return bytes(b).decode(m[1] if m else "utf-8", "replace")
            except LookupError:
                return bytes(b).decode("utf-8", "replace")

        return pd.Series([one(b, h) for b, h in zip(bodies, headers)], dtype=object)

    return decode(body, http_header)


def read_list(spark: SparkSession, path: str, name: str = "url", first_field: bool = False) -> DataFrame:
    """One value a line; ``first_field``: what follows a tab is left out."""
    v = F.split("value", "\t")[0] if first_field else F.col("value")
    return spark.read.text(path).where("trim(value) <> ''").select(v.alias(name))


def add_to_list(spark: SparkSession, path: str, new: DataFrame, out: str, name: str = "url") -> None:
    """Writes a sorted list of the old and new values; repeats stay."""
    read_list(spark, path, name).unionByName(new.select(name)).orderBy(name).write.text(out)


def rewrite_lines(spark: SparkSession, path: str, out: str, compression: str) -> None:
    """The same lines with another compression."""
    spark.read.text(path).write.option("compression", compression).text(out)


def new_dumps(page: str, known: list[str], pattern: str = r"([A-Z][a-z]+) (\d{4})") -> list[str]:
    """Names yyyy_mm of the dumps that a list page names by month (or season) and year, without known ones."""
    import re

    months = {m: i for i, m in enumerate("January February March April May June July August September October November December".split(), 1)}
    months |= {"Winter": 1, "Spring": 4, "Summer": 7, "Autumn": 10, "Fall": 10}
    found = {f"{y}_{months[m]:02d}" for m, y in re.findall(pattern, page) if m in months}
    return sorted(found - set(known))


def to_json_line(surt: str, timestamp: str, **fields: str) -> str:
    """An index line, for fixtures."""
    return f"{surt} {timestamp} {json.dumps(fields)}"
