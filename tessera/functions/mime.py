"""MIME expressions: normal form, sniffing, HTTP headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BY_EXTENSION = {"html": "text/html", "htm": "text/html", "txt": "text/plain", "xml": "application/xml", "pdf": "application/pdf", "json": "application/json", "jpg": "image/jpeg", "png": "image/png", "gif": "image/gif", "css": "text/css", "js": "text/javascript", "doc": "application/msword", "rtf": "application/rtf"}


def normalize_mime(mime: Column) -> Column:
    """Strips slashes, backslashes and quotes at the ends, cuts at ``,`` or ``;`` and turns backslashes round.

    What still isn't type/subtype is guessed from its file extension, else stays.
    """
    end = r"[/\\\\'\"\s]+"
    m = F.regexp_replace(F.regexp_replace(mime, f"^{end}", ""), f"{end}$", "")
    m = F.regexp_replace(F.regexp_extract(m, "^([^,;]*)", 1), f"{end}$", "")
    m = F.translate(m, "\\", "/")
    guess = F.create_map(*[F.lit(x) for kv in _BY_EXTENSION.items() for x in kv])
    extension = F.lower(F.regexp_extract(m, r"\.([a-zA-Z0-9]+)$", 1))
    return F.when(m.rlike(r"^[^/\s]+/[^/\s]+$"), m).otherwise(F.coalesce(F.try_element_at(guess, extension), m))


def sniff(text: Column, length: int = 2048) -> Column:
    """``html``, ``txt`` or null (binary, or nothing) from the first ``length`` characters: a property of a file's head."""
    head = F.substring(text, 1, length)
    html = head.rlike(r"(?i)^\s*(?:<\?xml[^>]*>\s*)?(?:<!--.*?-->\s*)*<(?:!doctype html|html|head|body|title|script|table|div|p|h1|a|br|iframe|style|b|font)[\s>]")
    binary = head.rlike(r"[\x00-\x08\x0b\x0e-\x1a\x1c-\x1f]|^%PDF|^PK\x03|^GIF8|^\{\\\\rtf")
    return F.when(head.isNull() | (F.trim(head) == "") | binary, F.lit(None).cast("string")).when(html, "html").otherwise("txt")


def header(response: Column, name: str) -> Column:
    """The first header of this name, whatever its case; null if there is none."""
    value = F.regexp_extract(response, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", F.trim(value))


def content_type(identified: Column, response: Column) -> Column:
    """The type that the archive identified, else the one in the HTTP header, in lower case and without parameters."""
    return F.lower(F.trim(F.regexp_extract(F.coalesce(identified, header(response, "Content-Type")), "^([^;,]*)", 1)))


def content_kind(identified: Column, response: Column) -> Column:
    """``atom``, ``rss``, ``bibtex`` (by type, or by an attachment's name) or ``html`` for anything else."""
    t = F.coalesce(content_type(identified, response), F.lit(""))
    bib = t.contains("bibtex") | (attachment_extension(response) == "bib")
    return F.when(bib, "bibtex").when(t.contains("atom"), "atom").when(t.contains("rss"), "rss").otherwise("html")


def normalize_page(page: Column) -> Column:
    """A page as HTML: HTML as it is, within html and body elements if it lacks them; text within them, escaped; else null."""
    kind = sniff(page)
    text = F.replace(F.replace(F.replace(page, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    wrap = lambda c: F.concat(F.lit("<html><body>"), c, F.lit("</body></html>"))
    whole = page.rlike(r"(?i)<(?:html|body)[\s>]")
    return F.when(kind == "html", F.when(whole, page).otherwise(wrap(page))).when(kind == "txt", wrap(text))


def attachment_extension(response: Column) -> Column:
    """Extension of an attachment's file name: ``-`` without an attachment, ``no_extension`` without a dot."""
    name = F.regexp_extract(response, r"(?im)^Content-Disposition:.*?filename=[\"']?([^\"'\r\n;]+)", 1)
    return F.when(name == "", "-").when(~name.contains("."), "no_extension").otherwise(F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)))
