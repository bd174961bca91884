"""Schemas of the records that the operators read and write."""

from __future__ import annotations

#: A document: its URL, free metadata, HTTP headers (request, response), and paragraphs.
DOCUMENT = "id string, meta map<string,string>, http_meta map<string,string>, paragraphs array<string>"
#: A document as it is stored: paragraphs are joined by newlines.
DOCUMENT_JSON = "id string, meta map<string,string>, text string"
#: A line of a crawl index after filtering.
INDEX = "domain string, url string, warc string, offset bigint, length bigint, status int, mime string"
#: A line of the index of an index: reversed host labels, path, and the byte range of a block of lines.
CLUSTER = "surt string, path string, file string, offset bigint, length bigint"
#: A token of an annotated text.
TOKEN = "doc_id string, par_id string, par bigint, sent bigint, tok bigint, fields array<string>"
