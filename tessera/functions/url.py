"""URL expressions: hosts, domains, reversed hosts, percent-decoding."""

from __future__ import annotations

from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_AUTHORITY = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"


def authority(url: Column) -> Column:
    """Host with user and port, as far as there are any; '' if the URL has none."""
    return F.regexp_extract(url, _AUTHORITY, 1)


def host(url: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(authority(url), "^.*@", ""), r":\d*$", ""))


def domain(url: Column) -> Column:
    """Authority without a leading www., ww2., ww3., www2. or www3."""
    return F.regexp_replace(authority(url), r"^(?:www|ww2|ww3|www2|www3)\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def surt_labels(host_name: Column) -> Column:
    """Host labels in reverse, without a leading ``*`` or ``www`` (also with a digit)."""
    return F.reverse(F.split(F.regexp_replace(host_name, r"^(?:\*|www[1-9]?)\.", ""), r"\."))


def surt(host_name: Column) -> Column:
    return F.array_join(surt_labels(host_name), ",")


def surt_matches(surt_col: Column, query: str) -> Column:
    """The domain itself and its subdomains; a prefix test, which the scan of a sorted table can use."""
    return (surt_col == query) | surt_col.startswith(query + ",")


def pure_url(url: Column) -> Column:
    """The URL without protocol; one without ``://`` stays whole."""
    return F.regexp_replace(url, r"^.*?://", "")


def registered_domain(host_name: Column, suffixes: tuple[str, ...] = ()) -> Column:
    """The label before the public suffix, and the suffix: of ``suffixes`` the longest that fits, else the last label."""
    out = F.regexp_extract(host_name, r"([^.]+\.[^.]+)$", 1)
    for s in sorted(suffixes, key=lambda s: s.count(".")):
        out = F.when(host_name.endswith("." + s), F.regexp_extract(host_name, r"([^.]+\." + s.replace(".", r"\.") + ")$", 1)).otherwise(out)
    return F.when(out == "", host_name).otherwise(out)


def _to_fixpoint(u: str | None) -> str | None:
    while u is not None and (v := unquote(u)) != u:
        u = v
    return u


@F.pandas_udf(StringType())
def _unquoted(urls: pd.Series) -> pd.Series:
    return urls.map(_to_fixpoint, na_action="ignore")


def unquote_all(url: Column) -> Column:
    """Percent-decodes until nothing changes. Only URLs with a percent sign go to Python."""
    return F.when(url.contains("%"), _unquoted(F.when(url.contains("%"), url))).otherwise(url)
