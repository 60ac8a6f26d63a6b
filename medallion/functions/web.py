"""URL pieces with plain string functions (no scheme required)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _strip(x: Column, prefixes) -> Column:
    for p in prefixes:
        x = F.replace(x, F.lit(p), F.lit(""))
    return x


def url_host(url) -> Column:
    """Host: scheme markers removed, cut at the first '/' then at '?'."""
    s = _strip(_col(url), ("android-app://", "http://", "https://"))
    return F.split_part(F.split_part(s, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(url) -> Column:
    """Path without its leading '/', cut at '?'.

    No '/' and no '?' → the whole (scheme-stripped) text; no '/' but a '?' → ''."""
    s = _strip(_col(url), ("http://", "https://"))
    first = F.coalesce(F.nullif(F.locate("/", s), F.lit(0)), F.locate("?", s) - 1)
    return F.split_part(F.right(s, F.length(s) - first), F.lit("?"), F.lit(1))


def url_parameter(url, name: str, strict: bool = False) -> Column:
    """Value of query parameter ``name``; NULL when absent or empty.

    The default matches ``name=`` anywhere (so ``page=`` also matches inside
    ``mypage=``); ``strict=True`` only after '?' or '&'."""
    u = _col(url)
    if strict:
        u = F.concat(F.lit("&"), F.split_part(u, F.lit("?"), F.lit(2)))
        key = "&" + name + "="
    else:
        key = name + "="
    return F.nullif(F.split_part(F.split_part(u, F.lit(key), F.lit(2)), F.lit("&"), F.lit(1)), F.lit(""))
