"""Numeric expressions: engine-stable rounding, exact means, null-safe
arithmetic, bucketing and great-circle distance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def snap_round(c: ColumnOrName, digits: int = 2) -> Column:
    """Round half away from zero on the value's decimal text.

    ``round`` on a double rounds either the shortest decimal text (Spark) or the
    binary value (other engines); ties such as 512.325 then disagree.  Going
    through ``decimal(28,10)`` makes every engine round the same decimal.
    """
    x = _col(c)
    # decimal(28,10) holds 18 digits before the point; NaN and larger values
    # have no such text and are rounded as they are
    return F.when(F.abs(x) < F.lit(1e17), F.round(x.cast("decimal(28,10)"), digits).cast("double")).otherwise(
        F.round(x.cast("double"), digits))


def exact_avg(c: ColumnOrName, scale: int = 2) -> Column:
    """Mean whose sum is exact where the values have at most ``scale`` decimals
    (scores, money), so it does not depend on task order.

    Each such value is scaled to an integer and summed as a long — several times
    faster than a decimal buffer; ``sum / 10^scale`` is the rounded exact sum.
    Every row is checked: one value with more decimals, one outside the exact range
    of a double or an overflowing sum and the plain ``avg`` is the result."""
    x = _col(c).cast("double")
    scaled = x * F.lit(float(10 ** scale))
    whole = F.rint(scaled)
    fits = (F.abs(scaled) < F.lit(9e15)) & (F.abs(scaled - whole) <= F.lit(1e-5))
    total = F.try_sum(F.when(fits, whole.cast("long"))).cast("double") / F.lit(float(10 ** scale))
    return (F.when(F.bool_or(~fits), F.avg(x))
            .otherwise(F.coalesce(total / F.nullif(F.count(x), F.lit(0)), F.avg(x))))


def rounded_avg(c: ColumnOrName, digits: int = 2, scale: int = 2) -> Column:
    """``round(avg(c), digits)`` with an exact sum and engine-stable rounding."""
    return snap_round(exact_avg(c, scale), digits)


def pct_of_total(cond: Column, digits: int = 1) -> Column:
    """``100 * sum(case when cond then 1 else 0) / count(*)`` as a double.

    A double 100 keeps the result a double (``100.0`` would make a decimal)."""
    hits = F.sum(F.when(cond, 1).otherwise(0))
    return snap_round(F.lit(100.0).cast("double") * hits / F.count(F.lit(1)), digits)


def mean_of(cols: Sequence[ColumnOrName], digits: int | None = 2) -> Column:
    """Row-wise mean of several columns; any NULL makes the mean NULL."""
    if not cols:
        raise ValueError("mean_of needs at least one column")
    total = reduce(lambda a, b: a + b, [_col(c) for c in cols])
    m = total / F.lit(len(cols))
    return m if digits is None else snap_round(m, digits)


def weighted_mean(weights: Mapping[str, float] | Sequence[tuple[ColumnOrName, float]],
                  digits: int | None = 2) -> Column:
    """``sum(col * w) / sum(w)``; any NULL input gives NULL."""
    items = list(weights.items()) if isinstance(weights, Mapping) else list(weights)
    if not items:
        raise ValueError("weighted_mean needs at least one column")
    terms = [(_col(c) if w == 1 else _col(c) * F.lit(w)) for c, w in items]
    m = reduce(lambda a, b: a + b, terms) / F.lit(sum(w for _, w in items))
    return m if digits is None else snap_round(m, digits)


def _as_list(cols, name: str) -> list[Column]:
    if isinstance(cols, (str, Column)) or not isinstance(cols, Sequence):
        raise TypeError(f"{name} takes a list of columns, got {type(cols).__name__}")
    if not cols:
        raise ValueError(f"{name} needs at least one column")
    return [_col(c) for c in cols]


def safe_add(cols: Sequence[ColumnOrName]) -> Column:
    """Sum treating NULL as 0; all NULL gives 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in _as_list(cols, "safe_add")])


def safe_subtract(cols: Sequence[ColumnOrName]) -> Column:
    """Left-to-right difference treating NULL as 0."""
    return reduce(lambda a, b: a - b, [F.coalesce(c, F.lit(0)) for c in _as_list(cols, "safe_subtract")])


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator / denominator``; a zero or NULL denominator gives NULL."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def null_if_zero(c: ColumnOrName) -> Column:
    return F.nullif(_col(c), F.lit(0))


def width_bucket(x: ColumnOrName, lo, hi, n, compat: bool = False) -> Column:
    """Equal-width bucket number.

    Default: the documented rule — 0 below ``lo``, ``n + 1`` at or above ``hi``,
    otherwise ``floor(n * (x - lo) / (hi - lo)) + 1`` (Spark's built-in).
    ``compat=True``: the portable formula ``least(ceil((x-lo)/bin), n+1)`` plus
    one when ``x`` is an exact multiple of the bin width."""
    xc = _col(x)
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    n_c = n if isinstance(n, Column) else F.lit(n)
    if not compat:
        return F.width_bucket(xc, lo_c, hi_c, n_c)
    bin_size = (hi_c - lo_c) / n_c
    on_edge = F.when(F.try_mod(xc.cast("decimal(28,6)"), bin_size.cast("decimal(28,6)")) == 0, 1).otherwise(0)
    return on_edge + F.least(F.ceil((xc - lo_c) / bin_size), (n_c + 1).cast("bigint"))


def degrees_to_radians(c: ColumnOrName) -> Column:
    return F.radians(_col(c))


_EARTH_RADIUS_MI = 3961
_KM_PER_MI = 1.60934


def haversine(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName,
              lon2: ColumnOrName, unit: str = "mi") -> Column:
    """Great-circle distance with an earth radius of 3961 miles."""
    if unit == "mi":
        rate = 1.0
    elif unit == "km":
        rate = _KM_PER_MI
    else:
        raise ValueError(f"unit must be one of 'mi' or 'km', got {unit!r}")
    la1, lo1, la2, lo2 = (_col(c) for c in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(F.radians((la2 - la1) / 2)), 2)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2))
         * F.pow(F.sin(F.radians((lo2 - lo1) / 2)), 2))
    d = F.lit(2 * _EARTH_RADIUS_MI) * F.asin(F.sqrt(a))
    return d if rate == 1.0 else d * F.lit(rate)
