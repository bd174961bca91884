"""Main text of HTML pages, and feeds and bibliographies as text.

Pages are cut into blocks by a parser in Arrow batches; classification of the blocks is built-in expressions
and windows within a page. The rules follow the published method of stop-word and link density with context.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sized_slices

#: Bytes of pages, about, that are cut into blocks at once.
PAGE_BYTES = 2 << 20
BLOCK_TAGS = frozenset("address article aside blockquote body button canvas caption center col colgroup dd div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li link main meta nav noscript ol optgroup option p pre section table tbody td textarea tfoot th thead title tr ul".split())
SKIPPED_TAGS = frozenset("script style noscript template head select textarea button svg iframe object".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Frequent words of the languages at hand; a parameter of the classifier.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he this are or his from at which but have an they you were had their one all we can there been if more when will would who so no out".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont ont avec son aux été cette être ses leur mais comme ou nous sa fait tout".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy".split(),
}
_LANG = re.compile(r"<html\b[^>]*?\s(?:xml:)?lang\s*=\s*[\"']?\s*([a-z]{2,3})(?![a-z])", re.I)
_NO_WORD = r"[^\p{L}\p{N}']+"
_BLOCKS = "i long, path string, text string, heading boolean, link_chars long"


class _Segmenter(HTMLParser):
    """Blocks of a page: text between block tags, two line breaks in a row too."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, str, str, bool, int]] = []
        self.path: list[str] = []
        self.skip = self.links = self.chars_in_links = self.breaks = 0
        self.parts: list[str] = []

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((len(self.blocks), ".".join(self.path), text, any(t in HEADINGS for t in self.path), min(self.chars_in_links, len(text))))
        self.parts, self.chars_in_links, self.breaks = [], 0, 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in SKIPPED_TAGS:
            self.skip += 1
            return
        if tag in BLOCK_TAGS:
            self._flush()
            if tag not in ("hr", "col", "link", "meta"):
                self.path.append(tag)
        elif tag == "br":
            self.breaks += 1
            if self.breaks > 1:
                self._flush()
            else:
                self.parts.append(" ")
        elif tag == "a":
            self.links += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED_TAGS:
            self.skip = max(0, self.skip - 1)
        elif tag in BLOCK_TAGS:
            self._flush()
            if tag in self.path:
                while self.path.pop() != tag:
                    pass
        elif tag == "a":
            self.links = max(0, self.links - 1)

    def handle_data(self, data: str) -> None:
        if self.skip or not data:
            return
        if data.strip():
            self.breaks = 0
        self.parts.append(data)
        if self.links:
            self.chars_in_links += len(" ".join(data.split()))


def segment(html: str | None) -> list[tuple[int, str, str, bool, int]]:
    """(number, tag path, text, in a heading, characters in links) of a page's blocks."""
    s = _Segmenter()
    s.feed(html or "")
    s.close()
    s._flush()
    return s.blocks


def stated_language(html: str | None) -> str | None:
    """First part of the lang attribute of the html element."""
    m = _LANG.search(html or "")
    return m[1].lower() if m else None


def segments(pages: DataFrame, id_col: str, html: str = "html", language: bool = False) -> DataFrame:
    """A row for each block: ``id_col, i, path, text, heading, link_chars``, and the page's stated ``language`` if asked for. A page without text has none."""
    kind = dict(pages.dtypes)[id_col]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for batch in batches for x in sized_slices(batch, PAGE_BYTES)):
            rows = [(n, *b, *([stated_language(h)] if language else [])) for n, h in enumerate(part.column(1).to_pylist()) for b in segment(h)]
            if rows:
                own, *columns = zip(*rows)
                arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string()])]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own)), *arrays], [id_col, "i", "path", "text", "heading", "link_chars", "language"][: 1 + len(arrays)])

    return pages.select(F.col(id_col).alias("k"), F.col(html).alias("h")).mapInArrow(cut, f"{id_col} {kind}, {_BLOCKS}" + ", language string" * language)


def page_language(blocks: DataFrame, id_col: str, lists: dict[str, list[str]] = STOP_WORDS) -> DataFrame:
    """Makes ``language`` one of the lists': the stated one, else that with most stop words in the page's blocks, the first by name of equals."""
    names = sorted(lists)
    stated = F.when(F.col("language").isin(names), F.col("language"))
    words = F.split(F.lower("text"), _NO_WORD)
    count = lambda own: F.size(F.filter(words, lambda w: w.isin(*own)))
    found = [F.when(stated.isNull(), count(lists[k])) for k in names]
    page = Window.partitionBy(id_col)
    out = blocks.withColumns({f"_n_{k}": F.sum(c).over(page) for k, c in zip(names, found)})
    guess = F.coalesce(*(F.when(F.col(f"_n_{k}") == F.greatest(*(f"_n_{x}" for x in names)), k) for k in names))
    return out.withColumn("language", F.coalesce(stated, guess)).drop(*(f"_n_{k}" for k in names))


def classify(blocks: DataFrame, id_col: str, stop_words: list[str] | dict[str, list[str]], short: int = 70, long: int = 200, low: float = 0.30, high: float = 0.32, links: float = 0.2, near_heading: int = 200) -> DataFrame:
    """Adds ``kind``: ``good`` or ``bad``.

    stop_words: one list for all, or lists by language for blocks with a ``language``.

    Blocks with many characters in links are bad; short ones are undecided; others are good, near-good or bad by
    the share of stop words. Then the undecided take the kind of their neighbours: between two good or two
    bad blocks theirs, else bad unless a neighbour is near-good; near-good blocks are bad between bad ones only.
    A short or near-good heading is good if a good block follows within ``near_heading`` characters.
    """
    n = F.length("text")
    words = F.split(F.lower("text"), _NO_WORD)
    if isinstance(stop_words, dict):
        frequent = lambda w: F.coalesce(*(F.when(F.col("language") == k, w.isin(*own)) for k, own in stop_words.items()), F.lit(False))
    else:
        frequent = lambda w: w.isin(*stop_words)
    density = F.size(F.filter(words, frequent)) / F.greatest(F.size(F.filter(words, lambda w: w != "")), F.lit(1))
    link = F.col("link_chars") / F.greatest(n, F.lit(1))
    first = (
        F.when((link > links) | F.col("text").contains("©"), "bad")
        .when(n < short, F.when(F.col("link_chars") > 0, "bad").otherwise("short"))
        .when(density >= high, F.when(n > long, "good").otherwise("near"))
        .when(density >= low, "near")
        .otherwise("bad")
    )
    w = Window.partitionBy(id_col).orderBy("i")
    back, ahead = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    out = blocks.withColumn("_c", first).withColumn("_end", F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # a heading near good text counts as near-good
    good_at = F.first(F.when(F.col("_c") == "good", F.col("_end") - n), ignorenulls=True).over(ahead)
    out = out.withColumn("_c", F.when(F.col("heading") & (F.col("_c") == "short") & (good_at - F.col("_end") <= near_heading), "near").otherwise(F.col("_c")))
    firm = lambda *kinds: F.when(F.col("_c").isin(*kinds), F.col("_c"))
    near_edges = lambda frame, pick: F.coalesce(pick(firm("good", "bad", "near"), ignorenulls=True).over(frame), F.lit("bad"))
    edges = lambda frame, pick: F.coalesce(pick(firm("good", "bad"), ignorenulls=True).over(frame), F.lit("bad"))
    out = out.withColumns({"_p": edges(back, F.last), "_n": edges(ahead, F.first), "_pn": near_edges(back, F.last), "_nn": near_edges(ahead, F.first)})
    both = (F.col("_p") == "good") & (F.col("_n") == "good")
    short_ok = both | ((F.col("_p") == "good") & (F.col("_nn") == "near")) | ((F.col("_n") == "good") & (F.col("_pn") == "near"))
    good_after = F.first(F.when(F.col("_c") == "good", F.col("_end") - n), ignorenulls=True).over(ahead)
    near_ok = (F.col("_p") == "good") | (F.col("_n") == "good") | (F.col("heading") & F.coalesce(good_after - F.col("_end") <= near_heading, F.lit(False)))
    kind = F.when(F.col("_c") == "good", "good").when(F.col("_c") == "near", F.when(near_ok, "good").otherwise("bad")).when(F.col("_c") == "short", F.when(short_ok, "good").otherwise("bad")).otherwise("bad")
    return out.withColumn("kind", kind).drop("_c", "_end", "_p", "_n", "_pn", "_nn")


def _collected(blocks: DataFrame, id_col: str) -> DataFrame:
    return blocks.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda x: x["text"]).alias("paragraphs"))


def density_text(pages: DataFrame, id_col: str, html: str = "html", language: str | None = None, **options) -> DataFrame:
    """``id_col, paragraphs`` of the good blocks; pages without any go. Each page is judged in its own language, unless one is given for all."""
    if language is None:
        blocks = classify(page_language(segments(pages, id_col, html, language=True), id_col), id_col, STOP_WORDS, **options)
    else:
        blocks = classify(segments(pages, id_col, html), id_col, STOP_WORDS[language], **options)
    return _collected(blocks.where("kind = 'good'"), id_col)


def all_text(pages: DataFrame, id_col: str, html: str = "html") -> DataFrame:
    """All blocks, to see what a remover removes."""
    return _collected(segments(pages, id_col, html), id_col)


def tree_text(pages: DataFrame, id_col: str, html: str = "html", least: int = 25) -> DataFrame:
    """Paragraphs, lists and headings in the page's main part; not in navigation, headers, footers, asides, forms or tables.

    Pages with an article or main element are read there only. Headings and list items may be short, other text
    has ``least`` characters.
    """
    b = segments(pages, id_col, html).where(~F.col("path").rlike(r"(?:^|\.)(?:nav|header|footer|aside|form|table|fieldset)(?:\.|$)") & (F.col("link_chars") <= 0.5 * F.length("text")))
    b = b.withColumn("_main", F.col("path").rlike(r"(?:^|\.)(?:article|main)(?:\.|$)"))
    b = b.withColumn("_has", F.max("_main").over(Window.partitionBy(id_col)))
    keep = (F.col("_main") | ~F.col("_has")) & (F.col("heading") | F.col("path").rlike(r"(?:^|\.)(?:li|dd|dt)$") | (F.length("text") >= least))
    return _collected(b.where(keep), id_col)


#: Boilerplate removers by name; more can be added: (pages, id column, html column) to ``id, paragraphs``.
REMOVERS: dict[str, Callable[..., DataFrame]] = {"density": density_text, "tree": tree_text, "none": all_text}


# ---- other kinds of content ----


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _plain(markup: str | None) -> str:
    return "\n".join(b[2] for b in segment(markup))


def _child(e, name: str) -> str:
    return next((_plain("".join(c.itertext())) for c in e if _local(c.tag) == name), "")


def convert_atom(body: str) -> list[str]:
    """Title, summary and content of the entries that have the last two."""
    out = []
    for e in ElementTree.fromstring(body).iter():
        if _local(e.tag) == "entry" and (s := _child(e, "summary")) and (c := _child(e, "content")):
            out.append("\n".join(x for x in (_child(e, "title"), s, c) if x))
    return out


def convert_rss(body: str) -> list[str]:
    """Title and description of the items that have both; the feed's own come first."""
    out = []
    root = ElementTree.fromstring(body)
    for e in root.iter():
        if _local(e.tag) in ("channel", "item"):
            t, d = _child(e, "title"), _child(e, "description")
            if t and d:
                out.append(f"{t}\n{d}")
    return out


_ENTRY = re.compile(r"@\w+\s*\{", re.S)
_FIELD = re.compile(r"(\w+)\s*=\s*")


def _braced(s: str, at: int) -> int:
    depth = 0
    for i in range(at, len(s)):
        depth += (s[i] == "{") - (s[i] == "}")
        if depth == 0:
            return i
    return len(s)


def convert_bibtex(body: str) -> list[str]:
    """Title and abstract of the entries with an abstract, without tags and TeX commands. Entries that can't be read are left out."""
    out = []
    for m in _ENTRY.finditer(body):
        entry = body[m.end() : _braced(body, m.end() - 1)]
        fields, at = {}, 0
        while f := _FIELD.search(entry, at):
            v = f.end()
            if v < len(entry) and entry[v] == "{":
                at = _braced(entry, v) + 1
                value = entry[v + 1 : at - 1]
            elif v < len(entry) and entry[v] == '"':
                at = entry.find('"', v + 1) + 1 or len(entry)
                value = entry[v + 1 : at - 1]
            else:
                at = entry.find(",", v)
                at = len(entry) if at < 0 else at
                value = entry[v:at]
            fields[f[1].lower()] = " ".join(re.sub(r"<[^>]*>|\\[a-zA-Z]+\s?|[{}\\$]", "", value).split())
        if fields.get("abstract"):
            out.append("\n".join(x for x in (fields.get("title", ""), fields["abstract"]) if x))
    return out


def convert_content(records: DataFrame, kind: str = "kind", body: str = "body") -> DataFrame:
    """Replaces ``body`` by rows of text (``chunk`` from 0) for atom, rss and bibtex records, and passes others through.

    Empty chunks go; a feed that isn't well-formed has none.
    """
    converters = {"atom": convert_atom, "rss": convert_rss, "bibtex": convert_bibtex}

    @F.pandas_udf("array<string>")
    def convert(kinds: pd.Series, bodies: pd.Series) -> pd.Series:
        def one(k, b):
            try:
                return [c for c in converters[k](b) if c.strip()] if b is not None else []
            except ElementTree.ParseError:
                return []

        return pd.Series([one(k, b) for k, b in zip(kinds, bodies)], dtype=object)

    special = records.where(F.col(kind).isin(*converters)).withColumn("_c", convert(kind, body))
    rest = [c for c in records.columns if c != body]
    done = special.select(*rest, F.posexplode("_c").alias("chunk", body))
    plain = records.where(~F.coalesce(F.col(kind).isin(*converters), F.lit(False)) & (F.trim(body) != "")).select(*rest, F.lit(0).alias("chunk"), body)
    return done.unionByName(plain)
