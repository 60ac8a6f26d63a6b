"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the NULL stand-in used inside surrogate keys, so keys computed
# by other tools from the same columns are equal.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(cols: Sequence, nulls_as_empty: bool = False) -> Column:
    """md5 of the columns' text joined by '-', NULL replaced by a fixed token.

    ``nulls_as_empty=True`` is the legacy mode where NULL becomes ''.
    Doubles print differently across engines; cast them to decimal first when
    another engine must produce the same key."""
    if isinstance(cols, (str, Column)) or not cols:
        raise TypeError("surrogate_key takes a non-empty list of columns")
    token = "" if nulls_as_empty else SURROGATE_NULL_TOKEN
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(token))
             for c in cols]
    return F.md5(F.concat_ws("-", *parts))
