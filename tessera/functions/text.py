"""Text expressions. All but :func:`normalize` stay in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Bytes of text, about, that become Python strings at once.
TEXT_BYTES = 8 << 20


def sized_slices(batch: pa.RecordBatch, most_bytes: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about so many bytes, a row at least."""
    rows = max(1, batch.num_rows * most_bytes // max(1, batch.nbytes))
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


#: Signs that are neither letters, digits, underscores nor white space, three or more in a row.
PUNCTUATION_RUN = r"[^\p{L}\p{N}_\s]{3,}"


def paragraphs(text: Column) -> Column:
    """Lines of a text; the empty text is one empty paragraph."""
    return F.split(text, "\n")


def content(pars: Column) -> Column:
    return F.array_join(pars, "\n")


def n_words(text: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def words_of(pars: Column) -> Column:
    return F.aggregate(pars, F.lit(0), lambda n, p: n + n_words(p))


def chars_of(pars: Column) -> Column:
    """Characters of the paragraphs and the newlines between them; 0 without paragraphs."""
    return F.length(content(pars))


def escape_xml(text: Column) -> Column:
    """Escapes &, < and > (in this order) and makes any white space one space, none at the ends."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def good_token(token: Column, allowed: list[str] | tuple[str, ...] = ()) -> Column:
    """Allowed tokens, words with three dots after them, and tokens without three signs in a row."""
    listed = token.isin(*allowed) if allowed else F.lit(False)
    return listed | token.rlike(r"^[\p{L}\p{N}_]+\.\.\.$") | ~token.rlike(PUNCTUATION_RUN)


def clean_tokens(text: Column, allowed: list[str] | tuple[str, ...] = ()) -> Column:
    return F.array_join(F.filter(F.split(text, " "), lambda t: good_token(t, allowed)), " ")


def without_patterns(pars: Column, patterns: list[str]) -> Column:
    """Paragraphs that none of the regular expressions matches, whatever the case."""
    if not patterns:
        return pars
    either = "(?i)" + "|".join(f"(?:{p})" for p in patterns)
    return F.filter(pars, lambda p: ~p.rlike(either))


def is_punctuation(text: Column) -> Column:
    """Whether a string has no letter, digit or white space; true for the empty one."""
    return text.rlike(r"^[^\p{L}\p{N}\s]*$")


def is_blank(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit(""))) == ""


def shingles(text: Column, n: int = 5) -> Column:
    """All runs of n characters; none of a shorter text. One pass of a regular expression: substrings would be found from the start each."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))


def clean_tag(tag: Column) -> Column:
    """Repairs a morphological tag: no brackets within brackets, no doubled separators, none at the ends."""
    steps = [(r"\[\[", "["), (r"\]\]", "]"), (r"\]\s*\[", "]["), (r"\|{2,}", "|"), (r"^\||\|$", "")]
    return reduce(lambda c, s: F.regexp_replace(c, *s), steps, F.trim(tag))


def _normalized(s: pa.Array, form: str) -> pa.Array:
    """Texts in a normal form; some MB of them at a time are Python strings."""
    one = lambda t: t if t is None else unicodedata.normalize(form, t)
    parts = [pa.array([one(t) for t in x.column(0).to_pylist()], pa.string()) for x in sized_slices(pa.RecordBatch.from_arrays([s], ["t"]))]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


@F.arrow_udf(StringType())
def _nfc(s: pa.Array) -> pa.Array:
    return _normalized(s, "NFC")


@F.arrow_udf(StringType())
def _nfd(s: pa.Array) -> pa.Array:
    return _normalized(s, "NFD")


@F.arrow_udf(StringType())
def _nfkc(s: pa.Array) -> pa.Array:
    return _normalized(s, "NFKC")


@F.arrow_udf(StringType())
def _nfkd(s: pa.Array) -> pa.Array:
    return _normalized(s, "NFKD")


def normalize(text: Column, form: str = "NFC", lower: bool = False) -> Column:
    """A Unicode normal form (NFC, NFD, NFKC, NFKD), in lower case if asked for; Spark has no built-in function for it."""
    text = {"NFC": _nfc, "NFD": _nfd, "NFKC": _nfkc, "NFKD": _nfkd}[form](text)
    return F.lower(text) if lower else text
