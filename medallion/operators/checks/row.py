"""Checks on the rows or groups of one table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.dates import date_add_part
from medallion.operators.checks.core import Check, col, filtered, where_col
from medallion.operators.marts import first_non_null
from medallion.session import ntz_literal


def _fixed_width(df: DataFrame, column) -> bool:
    if not isinstance(column, str) or column not in df.columns:
        return False
    t = df.schema[column].dataType
    if isinstance(t, T.DecimalType):
        return t.precision <= 18
    return isinstance(t, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))


def _sum_if(pred: Column) -> Column:
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0)))


def _value_text(*columns) -> Column:
    """One text per combination of values, NULLs told apart."""
    return F.to_json(F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})


def not_null(df: DataFrame, column: str, where=None, relation: str = "model") -> Check:
    """Rows whose ``column`` is NULL."""
    pred = col(column).isNull()
    return Check(f"not_null_{column}", relation, lambda: filtered(df, where).where(pred),
                 source=df, fused=_sum_if(where_col(where) & pred))


def accepted_values(df: DataFrame, column: str, values: Sequence, where=None,
                    relation: str = "model") -> Check:
    """One row per value outside ``values`` with its row count (C2); NULL passes."""
    bad = ~col(column).isin(list(values))

    def rows():
        return (filtered(df, where).groupBy(col(column).alias("value_field"))
                .agg(F.count(F.lit(1)).alias("n_records")).where(~F.col("value_field").isin(list(values))))
    # not fused: a distinct count would turn the shared aggregate into a
    # distinct aggregation; alone it is one hash aggregate keyed by the value
    return Check(f"accepted_values_{column}", relation, rows,
                 keyed=(F.when(where_col(where) & bad, _value_text(column)), lambda n: n > 0))


def unique(df: DataFrame, column: str, where=None, relation: str = "model") -> Check:
    """Values held by more than one row (C3); NULLs ignored."""
    def rows():
        return (filtered(df, where).where(col(column).isNotNull())
                .groupBy(col(column).alias("unique_field")).agg(F.count(F.lit(1)).alias("n_records"))
                .where(F.col("n_records") > 1))
    return Check(f"unique_{column}", relation, rows,
                 keyed=(F.when(where_col(where) & col(column).isNotNull(), _value_text(column)), lambda n: n > 1))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True,
                   where=None, relation: str = "model") -> Check:
    """Rows outside [min, max] (C4).  Bounds may be Columns or SQL text; NULL
    passes; no bound never fails."""
    x = col(column)

    def bound(b):
        return b if isinstance(b, Column) else (F.expr(b) if isinstance(b, str) else F.lit(b))
    pred = F.lit(False)
    if min_value is not None:
        pred = pred | ~((x >= bound(min_value)) if inclusive else (x > bound(min_value)))
    if max_value is not None:
        pred = pred | ~((x <= bound(max_value)) if inclusive else (x < bound(max_value)))
    return Check(f"accepted_range_{column}", relation, lambda: filtered(df, where).where(pred),
                 source=df, fused=_sum_if(where_col(where) & pred))


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = (), where=None,
                 relation: str = "model") -> Check:
    """Fails when the column (per group) holds no non-NULL value.

    Without groups the scan stops at the first non-NULL row (``limit 1``)."""
    if group_by:
        def rows():
            return (filtered(df, where).groupBy(*group_by).agg(F.count(col(column)).alias("filler_column"))
                    .where(F.col("filler_column") == 0))
        return Check(f"at_least_one_{column}", relation, rows)

    def rows():
        first = first_non_null(filtered(df, where), column)   # stops at the first hit
        return first.agg(F.count(col(column)).alias("filler_column")).where(F.col("filler_column") == 0)
    held = F.count(F.when(where_col(where), col(column)))
    return Check(f"at_least_one_{column}", relation, rows, source=df, fused=F.when(held == 0, 1).otherwise(0),
                 state={"n": (held, "sum")}, verdict=lambda s: F.when(s("n") == 0, 1).otherwise(0))


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = (), where=None,
                 relation: str = "model") -> Check:
    """Fails when the column (per group) holds exactly one distinct non-NULL
    value (C6); all-NULL passes.  Computed as ``min = max`` over non-NULLs, so
    no distinct aggregate (and no per-value shuffle) is needed."""
    x = col(column)
    one_value = (F.count(x) > 0) & (F.min(x) == F.max(x))

    def rows():
        return (filtered(df, where).groupBy(*group_by)
                .agg(F.when(one_value, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("filler_column"))
                .where(F.col("filler_column") == 1))
    fused = state = None
    if not group_by:
        w = where_col(where)
        xw = F.when(w, x)
        state = {"n": (F.count(xw), "sum"), "lo": (F.min(xw), "min"), "hi": (F.max(xw), "max")}
        # min/max buffers of fixed width keep the shared aggregate a hash
        # aggregate; a text column would force a sort-based one for all checks
        if _fixed_width(df, column):
            fused = F.when((F.count(xw) > 0) & (F.min(xw) == F.max(xw)), 1).otherwise(0)
    return Check(f"not_constant_{column}", relation, rows, source=df if fused is not None else None,
                 fused=fused, state=state, verdict=lambda s: F.when((s("n") > 0) & (s("lo") == s("hi")), 1).otherwise(0))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0,
                        group_by: Sequence[str] = (), where=None, relation: str = "model") -> Check:
    """Fails when the share of non-NULL rows (per group) is outside
    [at_least, at_most], both ends inclusive (C7)."""
    prop = (F.sum(F.when(col(column).isNull(), 0).otherwise(1)).cast("double")
            / F.count(F.lit(1)).cast("double"))

    def rows():
        return (filtered(df, where).groupBy(*group_by).agg(prop.alias("not_null_proportion"))
                .where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most)))
    fused = state = None

    def outside(held: Column, n: Column) -> Column:
        p = held.cast("double") / F.nullif(n, F.lit(0)).cast("double")  # no row, no share: passes
        return F.when((p < at_least) | (p > at_most), 1).otherwise(0)
    if not group_by:
        w = where_col(where)
        state = {"held": (_sum_if(w & col(column).isNotNull()), "sum"), "n": (_sum_if(w), "sum")}
        fused = outside(state["held"][0], state["n"][0])
    return Check(f"not_null_proportion_{column}", relation, rows, source=df if fused is not None else None,
                 fused=fused, state=state, verdict=lambda s: outside(s("held"), s("n")))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True, where=None,
                     relation: str = "model") -> Check:
    """Rows whose (blank-trimmed) text is '' (C8); NULL passes; tabs are not trimmed."""
    v = F.trim(col(column)) if trim_whitespace else col(column)
    pred = v == F.lit("")
    return Check(f"not_empty_string_{column}", relation,
                 lambda: filtered(df, where).select(v.alias(column)).where(F.col(column) == ""),
                 source=df, fused=_sum_if(where_col(where) & pred))


def not_accepted_values(df: DataFrame, column: str, values: Sequence, quote: bool = True,
                        where=None, relation: str = "model") -> Check:
    """Distinct values found in the forbidden list (C9).  ``quote=False``
    treats the values as SQL expressions."""
    vals = [F.lit(v) for v in values] if quote else [F.expr(str(v)) for v in values]

    def rows():
        return (filtered(df, where).select(col(column).alias("value_field")).distinct()
                .where(F.col("value_field").isin(*vals)))
    return Check(f"not_accepted_values_{column}", relation, rows,
                 keyed=(F.when(where_col(where) & col(column).isin(*vals), _value_text(column)), lambda n: n > 0))


def unique_combination(df: DataFrame, columns: Sequence[str], where=None,
                       relation: str = "model") -> Check:
    """Key combinations held by more than one row (C11); NULLs group together."""
    def rows():
        return (filtered(df, where).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > 1).drop("_n"))
    return Check("unique_combination_of_" + "_".join(columns), relation, rows,
                 keyed=(F.when(where_col(where), _value_text(*columns)), lambda n: n > 1))


def expression_is_true(df: DataFrame, expression: str | Column, column: str | None = None,
                       where=None, relation: str = "model") -> Check:
    """Rows where the expression is false (C12); NULL passes.  With ``column``
    the text is ``column <expression>``."""
    if isinstance(expression, Column):
        e = expression
    else:
        e = F.expr(f"{column} {expression}" if column else expression)
    return Check("expression_is_true", relation, lambda: filtered(df, where).where(~e),
                 source=df, fused=_sum_if(where_col(where) & ~e))


def recency(df: DataFrame, field: str, datepart: str, interval: int, as_of=None,
            ignore_time_component: bool = False, group_by: Sequence[str] = (), where=None,
            relation: str = "model") -> Check:
    """Fails when the newest ``field`` (per group) is older than ``as_of -
    interval datepart`` (C15; strict ``<``; an empty table passes).  ``as_of``
    defaults to now; pass it for repeatable runs."""
    now = F.current_timestamp() if as_of is None else (
        ntz_literal(as_of) if isinstance(as_of, (dt.datetime, str)) else as_of)
    thr = date_add_part(datepart, -interval, now)
    thr = thr.cast("date") if ignore_time_component else thr.cast("timestamp_ntz")
    newest = F.max(col(field))
    newest = newest.cast("date") if ignore_time_component else newest.cast("timestamp_ntz")

    def rows():
        return (filtered(df, where).groupBy(*group_by).agg(newest.alias("most_recent"))
                .select(*group_by, "most_recent", thr.alias("threshold"))
                .where(F.col("most_recent") < F.col("threshold")))
    latest = F.max(F.when(where_col(where), col(field)))
    latest = latest.cast("date") if ignore_time_component else latest.cast("timestamp_ntz")
    return Check(f"recency_{field}", relation, rows, state=None if group_by else {"newest": (latest, "max")},
                 verdict=lambda s: F.when(s("newest") < thr, 1).otherwise(0))


def assert_equal(df: DataFrame, actual: str, expected: str, relation: str = "model") -> Check:
    """Rows where ``actual != expected`` (C21); NULL on either side passes."""
    pred = col(actual) != col(expected)
    return Check(f"assert_equal_{actual}", relation, lambda: df.where(pred), source=df, fused=_sum_if(pred))
