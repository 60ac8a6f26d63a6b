"""Date-part arithmetic shared by the series, recency and sequence operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = {
    "year": "YEAR", "quarter": "QUARTER", "month": "MONTH", "week": "WEEK",
    "day": "DAY", "hour": "HOUR", "minute": "MINUTE", "second": "SECOND",
}
DATE_PARTS = frozenset(_PARTS)


def _part(datepart: str) -> str:
    p = datepart.lower()
    if p not in _PARTS:
        raise ValueError(f"unsupported date part {datepart!r}; use one of {sorted(_PARTS)}")
    return p


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def date_add_part(datepart: str, n, ts) -> Column:
    """``ts + n datepart`` (n may be a Column).  Dates stay dates for day and
    coarser parts; finer parts give a timestamp."""
    p = _part(datepart)
    n_c = n if isinstance(n, Column) else F.lit(n)
    t = _col(ts)
    return F.timestamp_add(_PARTS[p], n_c, t)


def date_floor(datepart: str, ts) -> Column:
    """Start of the period holding ``ts`` (weeks start on Monday)."""
    return F.date_trunc(_part(datepart), _col(ts))


def intervals_between(start, end, datepart: str) -> Column:
    """Number of ``datepart`` boundaries crossed from ``start`` to ``end``.

    Both sides are floored to the period first, so 23:59 → 00:01 is one day."""
    p = _part(datepart)
    s, e = date_floor(p, start), date_floor(p, end)
    if p == "week":
        return F.floor(F.timestamp_diff("DAY", s, e) / 7)
    return F.timestamp_diff(_PARTS[p], s, e)
