"""Reading and writing corpora: JSON lines and the older tagged format."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content, escape_xml, paragraphs
from ..model import DOCUMENT, DOCUMENT_JSON
from ..operators.sampling import rechunk
from .storage import file_lines, list_files

#: Characters of the documents of one batch.
CHARS = 4 << 20


def read_jsonl(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """Documents of ``.jsonl``, ``.jsonl.gz`` or ``.jsonl.bz2`` files, with ``file``. Columns that aren't used aren't parsed."""
    raw = spark.read.schema(DOCUMENT_JSON).option("recursiveFileLookup", recursive).json(path)
    return raw.select("id", "meta", F.lit(None).cast("map<string,string>").alias("http_meta"), paragraphs(F.coalesce("text", F.lit(""))).alias("paragraphs"), F.col("_metadata.file_path").alias("file"))


_TAG = re.compile(r"""([\w:-]+)="([^"]*)\"""")


def parse_tagged(text: str | Iterable[str], name: str = "") -> Iterator[tuple[str, dict, dict, list[str]]]:
    """(id, attributes, HTTP metadata, paragraphs) of ``<doc>`` elements; each tag has a line of its own.

    An element out of place is an error that names file and line.
    """
    attrs: dict | None = None
    block: str | None = None
    meta: dict[str, str] = {}
    pars: list[str] = []
    lines: list[str] = []

    def bad(n: int, why: str) -> ValueError:
        return ValueError(f"{name}:{n}: {why}")

    n = 0
    for n, line in enumerate(text.split("\n") if isinstance(text, str) else text, 1):
        tag = line.strip()
        if tag.startswith("<doc ") or tag == "<doc>":
            if attrs is not None:
                raise bad(n, "a document within a document")
            attrs, meta, pars = {k: html.unescape(v) for k, v in _TAG.findall(tag)}, {}, []
        elif tag == "</doc>":
            if attrs is None or block:
                raise bad(n, "unexpected </doc>")
            yield attrs.get("url", attrs.get("id", "")), {k: v for k, v in attrs.items() if k not in ("url", "id")}, meta, pars
            attrs = None
        elif attrs is None:
            if tag and not re.fullmatch(r"<\?xml.*\?>|</?corpus.*>", tag):
                raise bad(n, "text outside a document")
        elif block is None and tag in ("<meta>", "</meta>", ""):
            continue
        elif block is None and (m := re.fullmatch(r"<(\w+)>", tag)):
            block, lines = m[1], []
        elif block and tag == f"</{block}>":
            value = html.unescape("\n".join(lines))
            if block == "p":
                pars.append(value)
            else:
                meta[block] = value
            block = None
        elif block:
            lines.append(line)
        else:
            raise bad(n, f"unexpected {tag[:40]}")
    if attrs is not None:
        raise bad(n, "the document isn't closed")


def read_tagged(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """Documents of tagged files: plain, ``.gz`` or ``.bz2``. A worker reads a file line by line and holds about ``CHARS`` characters."""
    pairs = pa.map_(pa.string(), pa.string())
    kinds = [("id", pa.string()), ("meta", pairs), ("http_meta", pairs), ("paragraphs", pa.list_(pa.string())), ("file", pa.string())]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = [[list(x.items()) for x in c] if t == pairs else c for c, (_, t) in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [n for n, _ in kinds])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in (f for b in batches for f in b.column(0).to_pylist()):
            rows, held = [], 0
            for d in parse_tagged(file_lines(file), file):
                rows.append((*d, file))
                held += 200 + sum(map(len, d[3]))
                if held > CHARS:
                    yield packed(rows)
                    rows, held = [], 0
            if rows:
                yield packed(rows)

    return list_files(spark, path, recursive).mapInArrow(parse, f"{DOCUMENT}, file string")


def read_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Chooses the format by name: ``.jsonl`` among the suffixes, else tagged."""
    json = [p for p in paths if ".jsonl" in p.rsplit("/", 1)[-1] or p.endswith("*.jsonl*")]
    rest = [p for p in paths if p not in json]
    parts = ([read_jsonl(spark, json)] if json else []) + ([read_tagged(spark, rest)] if rest else [])
    if not parts:
        raise ValueError("no input")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def to_json_rows(docs: DataFrame) -> DataFrame:
    return docs.select("id", "meta", content(F.col("paragraphs")).alias("text"))


def to_tagged_rows(docs: DataFrame, *keep: str) -> DataFrame:
    """``value``: each document in the tagged format, and columns to keep. Attributes are in the order of their names."""
    quoted = lambda v: F.replace(escape_xml(v), F.lit('"'), F.lit("&quot;"))
    attrs = F.transform(F.array_sort(F.map_entries(F.coalesce("meta", F.create_map().cast("map<string,string>")))), lambda e: F.concat(F.lit(" "), e["key"], F.lit('="'), quoted(e["value"]), F.lit('"')))
    head = F.concat(F.lit('<doc url="'), quoted(F.col("id")), F.lit('"'), F.array_join(attrs, ""), F.lit(">"))
    http = F.transform(F.array_sort(F.map_entries(F.coalesce("http_meta", F.create_map().cast("map<string,string>")))), lambda e: F.concat(F.lit("<"), e["key"], F.lit(">\n"), e["value"], F.lit("\n</"), e["key"], F.lit(">\n")))
    meta = F.when(F.size(http) > 0, F.concat(F.lit("<meta>\n"), F.array_join(http, ""), F.lit("</meta>\n"))).otherwise("")
    pars = F.transform("paragraphs", lambda p: F.concat(F.lit("<p>\n"), _escaped(p), F.lit("\n</p>\n")))
    return docs.select(F.concat(head, F.lit("\n"), meta, F.array_join(pars, ""), F.lit("</doc>")).alias("value"), *keep)


def _escaped(text):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def write_documents(docs: DataFrame, path: str, form: str = "jsonl", per_file: int | None = None, order: list[str] | None = None, compression: str = "gzip") -> None:
    """Writes documents; with ``per_file`` in numbered batches of so many, in order (by default of ids)."""
    rows = to_json_rows if form == "jsonl" else to_tagged_rows
    if per_file is None:
        out = rows(docs).write
    else:
        batched = rechunk(docs, per_file, order or ["id"]).repartition("batch").sortWithinPartitions("batch", *(order or ["id"]))
        packed = F.to_json(F.struct("id", "meta", content(F.col("paragraphs")).alias("text")))
        values = batched.select(packed.alias("value"), "batch") if form == "jsonl" else to_tagged_rows(batched, "batch")
        values.write.partitionBy("batch").option("compression", compression).text(path)
        return
    (out.option("compression", compression).json if form == "jsonl" else out.option("compression", compression).text)(path)
