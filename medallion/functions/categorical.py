"""Conditional labelling expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def band(c, thresholds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose threshold the value reaches (``>=``), tried in order.

    NULL reaches no threshold, so it falls to ``otherwise``."""
    if not thresholds:
        return F.lit(otherwise)
    x = _col(c)
    (t0, l0), *rest = thresholds
    expr = F.when(x >= F.lit(t0), F.lit(l0))
    for t, label in rest:
        expr = expr.when(x >= F.lit(t), F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def flag_contains(c, substring: str) -> Column:
    """1 when the text contains ``substring``, else 0 (NULL gives 0)."""
    return F.when(_col(c).contains(substring), F.lit(1)).otherwise(F.lit(0))


def map_groups(c, groups: Mapping[str, Sequence], otherwise: str) -> Column:
    """Label by membership: the first group whose value list holds the value.

    NULL belongs to no list, so it gets ``otherwise``."""
    x = _col(c)
    expr = None
    for label, values in groups.items():
        cond = x.isin(list(values))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))
