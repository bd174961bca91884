"""Annotated texts in columns: reading and writing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.tokens import token_runs
from .storage import file_lines, list_files

#: Token rows of one batch.
ROWS = 10_000
_TOKEN = "file string, doc_id string, par_id string, par long, sent long, text string, tok long, fields array<string>"


def parse_text(text: str | Iterable[str], header: bool = True) -> Iterator[tuple]:
    """(document, paragraph id, paragraph, sentence, sentence text, token, fields): numbers from 1; paragraphs and sentences count within the document."""
    doc = par_id = raw = None
    par = sent = tok = 0
    for line in text.split("\n") if isinstance(text, str) else text:
        if header:
            header = False
        elif line.startswith("# newdoc id ="):
            doc, par, sent, tok, raw = line[13:].strip(), 0, 0, 0, None
        elif line.startswith("# newpar id ="):
            par, par_id = par + 1, line[13:].strip()
        elif line.startswith("# text ="):
            raw = line[8:].strip()
        elif not line.strip():
            tok, raw = 0, raw if not tok else None
        elif doc is not None and not (line.startswith("# ") and "\t" not in line):
            if tok == 0:
                sent += 1
            tok += 1
            yield doc, par_id, max(par, 1), sent, raw, tok, line.split("\t")


def read_tsv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Token rows of annotated files, which a worker reads line by line: it holds some thousand rows at a time."""
    kinds = [("file", pa.string()), ("doc_id", pa.string()), ("par_id", pa.string()), ("par", pa.int64()), ("sent", pa.int64()), ("text", pa.string()), ("tok", pa.int64()), ("fields", pa.list_(pa.string()))]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in (f for b in batches for f in b.column(0).to_pylist()):
            rows = parse_text(file_lines(file), header)
            while part := list(islice(rows, ROWS)):
                columns = [[file] * len(part), *zip(*part)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [n for n, _ in kinds])

    return list_files(spark, path).mapInArrow(parse, _TOKEN)


def to_lines(tokens: DataFrame) -> DataFrame:
    """``doc_id, value``: each document in the annotated format, without the header row. Runs of tokens are lines before they are shuffled."""
    tokens = token_runs(tokens.withColumn("_f", F.array_join("fields", "\t")), ("doc_id", "par", "sent"), "tok", "_f", "\n", ("par_id", "text"))
    first = Window.partitionBy("doc_id").orderBy("par", "sent", "tok")
    prev_par, prev_sent = F.lag("par").over(first), F.lag("sent").over(first)
    new_sent = prev_sent.isNull() | (prev_sent != F.col("sent")) | (prev_par != F.col("par"))
    head = F.concat(
        F.when(prev_par.isNull(), F.concat(F.lit("# newdoc id = "), "doc_id", F.lit("\n"))).when(new_sent, "\n").otherwise(""),
        F.when(prev_par.isNull() | (prev_par != F.col("par")), F.concat(F.lit("# newpar id = "), F.coalesce("par_id", F.lit("")), F.lit("\n"))).otherwise(""),
        F.when(new_sent & F.col("text").isNotNull(), F.concat(F.lit("# text = "), "text", F.lit("\n"))).otherwise(""),
    )
    rows = tokens.withColumn("_l", F.concat(head, "_f", F.lit("\n")))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("par", "sent", "tok", "_l"))), lambda x: x["_l"]), "").alias("value"))
