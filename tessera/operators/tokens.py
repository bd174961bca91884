"""Annotated texts as token rows, training text, vocabularies and wordpieces."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_tag, normalize, sized_slices

UNKNOWN = "[UNK]"
#: Words whose pieces are kept within a batch.
KNOWN_WORDS = 1 << 17


def field(name: str, header: list[str]):
    """A token's field by column name."""
    return F.element_at("fields", header.index(name) + 1)


def glf(lemma, tag):
    """Lemma and suffix tags as tokens: ``ház [/N][Pl]`` becomes ``ház [Pl]``; the part of speech goes, and so does an empty suffix."""
    suffixes = F.filter(F.regexp_extract_all(tag, F.lit(r"(\[[^\]]*\])"), 1), lambda t: ~t.startswith("[/") & (t != "[]"))
    return F.array_join(F.concat(F.array(lemma), suffixes), " ")


def fix_rows(tokens: DataFrame, columns: int = 4) -> DataFrame:
    """Rows of one field get ``form, [], form, [/N][Nom]``; any other width than ``columns`` is an error."""
    form = F.element_at("fields", 1)
    n = F.size("fields")
    fixed = F.when(n == columns, F.col("fields")).when(n == 1, F.array(form, F.lit("[]"), form, F.lit("[/N][Nom]")))
    wrong = F.raise_error(F.concat(F.lit("a row has "), n.cast("string"), F.lit(" fields"))).cast("array<string>")
    return tokens.withColumn("fields", F.coalesce(fixed, wrong))


def fix_tags(tokens: DataFrame, column: int) -> DataFrame:
    """Repairs the tags in a field (number from 1)."""
    return tokens.withColumn("fields", F.transform("fields", lambda x, i: F.when(i == column - 1, clean_tag(x)).otherwise(x)))


def add_space_after(tokens: DataFrame, form: str = "form", text: str = "text", keys: tuple[str, ...] = ("doc_id", "par", "sent"), order: str = "tok") -> DataFrame:
    """Adds ``wsafter``: the white space that follows a token in its sentence's text.

    Tokens are found one after the other: a token's place is the sum of the lengths before it and of the
    spaces between. The last token of a sentence gets an escaped newline, of a paragraph two.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.coalesce(F.sum(F.length(form)).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    # the n-th sign that isn't space ends the token; what follows it up to the next one is its space
    rest = F.regexp_replace(F.col(text), F.concat(F.lit(r"^\s*(?:\S\s*?){"), before.cast("string"), F.lit("}")), "")
    space = F.regexp_extract(rest, r"^(\s*)", 1)
    ends = F.lead(form).over(w).isNull()
    last_sentence = F.lead(keys[-1]).over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1], order)).isNull()
    return tokens.withColumn("wsafter", F.when(last_sentence, "\\n\\n").when(ends, "\\n").otherwise(space))


def token_runs(tokens: DataFrame, keys: tuple[str, ...], order: str, token: str, between: str = " ", rest: tuple[str, ...] = ()) -> DataFrame:
    """``keys, order, rest, token``: tokens of equal keys that follow each other, in the rows and by number, as one string; order and rest are the first one's.

    Where the tokens of a sentence stand together they are one row before anything is shuffled; wherever they stand, runs don't
    overlap. A null token is a run of its own.
    """
    rows = tokens.select(*keys, F.col(order).cast("long").alias(order), *rest, token)
    n = len(keys)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                there = x.column(x.num_columns - 1).is_valid().to_numpy(zero_copy_only=False)
                same = (np.diff(x.column(n).to_numpy(zero_copy_only=False)) == 1) & there[1:] & there[:-1]
                for c in x.columns[:n]:
                    same &= pc.fill_null(pc.equal(c.slice(1), c.slice(0, len(c) - 1)), False).to_numpy(zero_copy_only=False)
                first = np.append(0, np.flatnonzero(~same) + 1)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, x.num_rows).astype(np.int32)), x.column(x.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(first)) for c in x.columns[:-1]), pc.binary_join(lists, between)], x.schema.names)

    return rows.mapInArrow(joined, ", ".join(f"`{c}` {t}" for c, t in rows.dtypes))


def sentence_text(tokens: DataFrame, token: str = "token", order: str = "tok") -> DataFrame:
    """``doc_id, par, sent, text``: tokens of each sentence joined by spaces."""
    return tokens.groupBy("doc_id", "par", "sent").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, token))), lambda x: x[token]), " ").alias("text"))


def export_text(tokens: DataFrame, style: str = "bert", token: str = "token", form: str | None = None, lower: bool = False) -> DataFrame:
    """``doc_id, text`` for training: ``bert`` has a sentence a line; ``lm`` a paragraph a line after ``<newdoc>``.

    form: a Unicode normal form. Documents are to be written with an empty line between them.
    """
    t = F.col(token)
    t = normalize(t, form, lower) if form else F.lower(t) if lower else t
    runs = token_runs(tokens.withColumn(token, t), ("doc_id", "par", "sent"), "tok", token)
    sents = sentence_text(runs.repartition("doc_id"), token)  # one shuffle for sentences, paragraphs and documents
    ordered = lambda c, *o: F.transform(F.array_sort(F.collect_list(F.struct(*o, c))), lambda x: x[c])
    if style == "bert":
        return sents.groupBy("doc_id").agg(F.array_join(ordered("text", "par", "sent"), "\n").alias("text"))
    pars = sents.groupBy("doc_id", "par").agg(F.array_join(ordered("text", "sent"), " ").alias("text"))
    return pars.groupBy("doc_id").agg(F.concat(F.lit("<newdoc>\n"), F.array_join(ordered("text", "par"), "\n")).alias("text"))


def filter_sentences(tokens: DataFrame, most: int = 500) -> DataFrame:
    """Leaves out sentences of more than so many tokens."""
    n = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "par", "sent"))
    return tokens.withColumn("_n", n).where(F.col("_n") <= most).drop("_n")


def punctuation_runs(toks: str, most: int = 3):
    """An array column of tokens without those beyond ``most`` signs in a row: what an analyser gets."""
    sign = lambda t: t.rlike(r"^[^\p{L}\p{N}\s]+$")
    start = F.struct(F.lit(0).alias("run"), F.array().cast("array<string>").alias("out"))

    def step(s, t):
        run = F.when(sign(t), s["run"] + 1).otherwise(0)
        return F.struct(run.alias("run"), F.when(run > most, s["out"]).otherwise(F.concat(s["out"], F.array(t))).alias("out"))

    return F.aggregate(toks, start, step, lambda s: s["out"])


def raw_sentence_tokens(text: str):
    """Tokens of a sentence's raw text, as its comment has it: cut at single spaces."""
    return F.split(F.regexp_replace(text, r"^# text =\s?", ""), " ")


def xml_sentences(xml: str, most: int = 3):
    """Sentences of a tokeniser's XML: ``raw`` has all tokens (``w`` and ``c`` elements) with their white space, ``tokens`` those for an analyser.

    Of signs in a row only the first ``most`` go to the analyser.
    """
    sentences = F.regexp_extract_all(xml, F.lit(r"(?s)<s>(.*?)</s>"), F.lit(1))
    plain = lambda c: reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")], c)
    toks = lambda s: F.transform(F.regexp_extract_all(s, F.lit(r"(?s)<[wc]>(.*?)</[wc]>"), F.lit(1)), plain)
    return F.transform(sentences, lambda s: F.struct(plain(F.regexp_replace(s, r"</?(?:w|c|ws)>", "")).alias("raw"), punctuation_runs(toks(s), most).alias("tokens")))


def analyze(sentences: DataFrame, analyzer, schema: str, most: int = 500, tokens: str = "tokens") -> DataFrame:
    """Runs an external analyser (``iterator of pandas frames -> iterator of pandas frames``) over sentences of at most ``most`` tokens."""
    return sentences.where(F.size(tokens) <= most).mapInPandas(analyzer, schema)


def wordpiece(word: str, vocabulary: frozenset[str], most: int = 100) -> list[str]:
    """Greedy longest pieces from the left; pieces within a word begin with ``##``."""
    if len(word) > most:
        return [UNKNOWN]
    out, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            if piece in vocabulary:
                break
        else:
            return [UNKNOWN]
        out.append(piece)
        at = end
    return out


def wordpieces(df: DataFrame, vocabulary: list[str], text: str = "text", name: str = "pieces") -> DataFrame:
    """Adds the wordpieces of a text's words. The vocabulary, a fixed list, is broadcast; each distinct word of a batch is cut once."""
    held = df.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    @F.arrow_udf("array<string>")
    def pieces(texts: pa.Array) -> pa.Array:
        known: dict[str, list[str]] = {}

        def one(t: str | None) -> list[str] | None:
            if t is None:
                return None
            out: list[str] = []
            for w in t.split():
                if w not in known:
                    if len(known) >= KNOWN_WORDS:
                        known.clear()
                    known[w] = wordpiece(w, held.value)
                out += known[w]
            return out

        kind = pa.list_(pa.string())
        parts = [pa.array([one(t) for t in x.column(0).to_pylist()], kind) for x in sized_slices(pa.RecordBatch.from_arrays([texts], ["t"]))]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return df.withColumn(name, pieces(text))


def convert_vocabulary(vocabulary: DataFrame, unused: int = 0, tags: list[str] = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"), piece: str = "piece", order: str = "n") -> DataFrame:
    """``id, piece``: pieces with a word-initial mark lose it, others get ``##``; special and empty ones go. Tags and ``[unusedN]`` come first."""
    spark = vocabulary.sparkSession
    head = [*tags, *(f"[unused{i}]" for i in range(unused))]
    p = F.col(piece)
    body = vocabulary.where(~p.rlike(r"^<.*>$") & (p != "▁")).select(F.lit(1).alias("part"), F.col(order).cast("long").alias("n"), F.when(p.startswith("▁"), F.substring(p, 2, 1 << 20)).otherwise(F.concat(F.lit("##"), p)).alias("piece"))
    first = spark.createDataFrame([(0, i, t) for i, t in enumerate(head)], "part int, n bigint, piece string")
    w = Window.partitionBy(F.lit(0)).orderBy("part", "n")  # a vocabulary: tens of thousands of rows
    return first.unionByName(body).select((F.row_number().over(w) - 1).cast("long").alias("id"), "piece")
