"""Order-dependent checks (C13, C14), planned with range buckets so that a
check without groups does not run in one task (see ``plans.ranged``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.dates import date_add_part
from medallion.functions.names import normalized_alias
from medallion.operators.checks.core import Check
from medallion.plans.ranged import ranged_shift

_GAPS = {"not_allowed": ("=", "equal_to"), "allowed": ("<=", "less_than_or_equal_to"),
         "required": ("<", "less_than")}


def _cmp(op, a, b):
    return {"=": a == b, "<=": a <= b, "<": a < b}[op]


def mutually_exclusive_ranges(df: DataFrame, lower_bound_column: str, upper_bound_column: str,
                              partition_by: str | None = None, gaps: str = "allowed",
                              zero_length_range_allowed: bool = False, n_buckets: int | None = None,
                              relation: str = "model") -> Check:
    """Ranges (per partition) that overlap, or break the gap rule, or are
    empty / reversed (C13).  A NULL bound fails."""
    if gaps not in _GAPS:
        raise ValueError("gaps must be one of ['not_allowed', 'allowed', 'required']")
    if zero_length_range_allowed not in (True, False):
        raise ValueError("zero_length_range_allowed must be true or false")
    gap_op, gap_words = _GAPS[gaps]
    zl_op, zl_words = ("<=", "less_than_or_equal_to") if zero_length_range_allowed else ("<", "less_than")

    def rows():
        parts = [partition_by] if partition_by else []
        base = df.select(*([F.col(partition_by).alias("partition_by_col")] if partition_by else []),
                         F.col(lower_bound_column).alias("lower_bound"),
                         F.col(upper_bound_column).alias("upper_bound"),
                         F.xxhash64(*[F.col(c) for c in df.columns]).alias("_row_h"))
        pcols = ["partition_by_col"] if parts else []
        # the next lower bound, and whether a next row exists at all (its
        # bound may itself be NULL)
        w = ranged_shift(base, "lower_bound", ["lower_bound", "upper_bound"], "next_lower_bound", "lead",
                         pcols, n_buckets, exists_col="_has_next")
        calc = w.withColumn("is_last_record", ~F.col("_has_next")).drop("_has_next", "_row_h")
        c1 = f"lower_bound_{zl_words}_upper_bound"
        c2 = f"upper_bound_{gap_words}_next_lower_bound"
        calc = (calc.withColumn(c1, F.coalesce(_cmp(zl_op, F.col("lower_bound"), F.col("upper_bound")), F.lit(False)))
                    .withColumn(c2, F.coalesce(_cmp(gap_op, F.col("upper_bound"), F.col("next_lower_bound")),
                                               F.col("is_last_record"), F.lit(False))))
        return calc.where(~(F.col(c1) & F.col(c2)))
    return Check("mutually_exclusive_ranges", relation, rows)


def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
                      group_by: Sequence[str] = (), n_buckets: int | None = None,
                      relation: str = "model") -> Check:
    """Rows whose value is not the previous value (in order, per group) plus
    ``interval`` (C14); the first row passes."""
    prev = "previous_" + normalized_alias(column)

    def rows():
        # the hash of the whole input row travels along, so rows that only
        # share the checked value still get different tie-breaks (and a hot
        # value is spread over several buckets)
        base = df.select(*group_by, column, F.xxhash64(*[F.col(c) for c in df.columns]).alias("_row_h"))
        w = ranged_shift(base, column, [column], prev, "lag", list(group_by), n_buckets).drop("_row_h")
        if datepart:
            nxt = date_add_part(datepart, interval, F.col(prev)).cast("timestamp")
            ok = F.col(column).cast("timestamp") == nxt
        else:
            ok = F.col(column) == F.col(prev) + F.lit(interval)
        return w.where(~ok)
    return Check(f"sequential_values_{column}", relation, rows)
