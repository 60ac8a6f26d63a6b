"""Checks that compare two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.checks.core import Check, col, where_col
from medallion.operators.sets import A_MINUS_B, B_MINUS_A, symmetric_difference


def relationships_where(df: DataFrame, column: str, to: DataFrame, field: str,
                        from_condition=None, to_condition=None, relation: str = "model") -> Check:
    """Child ids (non-NULL, meeting ``from_condition``) with no parent among
    ``to``'s non-NULL ``field`` values meeting ``to_condition`` (C10).

    Written as a left-anti join; the parent side is reduced to distinct ids
    first (map-side), so duplicate parents are not shuffled."""
    def rows():
        left = df.where(col(column).isNotNull() & where_col(from_condition)).select(col(column).alias("id"))
        right = to.where(col(field).isNotNull() & where_col(to_condition)).select(col(field).alias("id")).distinct()
        return left.join(right, "id", "left_anti").select("id", F.lit(None).cast(left.schema["id"].dataType)
                                                          .alias("right_id"))
    return Check(f"relationships_where_{column}", relation, rows)


def columns_match_set(df: DataFrame, names: Sequence[str]) -> list[tuple[str, str]]:
    """Column-name differences, case-insensitive (C20): ``[(side, name)]``
    where side is 'missing' (expected, absent) or 'unexpected'."""
    have = {c.lower(): c for c in df.columns}
    want = {n.lower(): n for n in names}
    out = [("missing", want[k]) for k in sorted(set(want) - set(have))]
    out += [("unexpected", have[k]) for k in sorted(set(have) - set(want))]
    return out


def _compare_columns(a: DataFrame, b: DataFrame, compare_columns, exclude_columns):
    if compare_columns and exclude_columns:
        raise ValueError("give either compare_columns or exclude_columns, not both")
    if compare_columns:
        return list(compare_columns)
    ex = {c.lower() for c in (exclude_columns or [])}
    ca = [c for c in a.columns if c.lower() not in ex]
    cb = [c for c in b.columns if c.lower() not in ex]
    diff = columns_match_set(b.select(*cb), ca)
    if diff:
        raise ValueError(f"compare model has different columns: {diff}")
    return ca


def equality(a: DataFrame, b: DataFrame, compare_columns: Sequence[str] | None = None,
             exclude_columns: Sequence[str] | None = None, precision: int | None = None,
             strategy: str = "digest", relation: str = "model") -> Check:
    """Rows found in only one table, labelled ``which_diff`` (C16).  By default digests
    of row buckets are compared first, since the tables are expected to be equal.

    Distinct semantics (like ``EXCEPT``): duplicates collapse, NULL equals NULL.
    ``precision`` rounds numeric columns as decimals before comparing.  The
    failures measure is the number of such rows plus |a_minus_b − b_minus_a|."""
    cols = _compare_columns(a, b, compare_columns, exclude_columns)

    def prep(df):
        if precision is None:
            return df.select(*cols)
        out = []
        for c in cols:
            dtype = df.schema[c].dataType
            if isinstance(dtype, T.NumericType):
                out.append(F.round(F.col(c).cast("decimal(38,10)"), precision).cast(f"decimal(38,{precision})")
                           .alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)

    def measure(rows):
        a_ = F.sum(F.when(F.col("which_diff") == A_MINUS_B, 1).otherwise(0))
        b_ = F.sum(F.when(F.col("which_diff") == B_MINUS_A, 1).otherwise(0))
        return F.count(F.lit(1)) + F.coalesce(F.abs(a_ - b_), F.lit(0))
    return Check("equality", relation, lambda: symmetric_difference(prep(a), prep(b), strategy=strategy),
                 measure=measure)


# Names of the constant join-key columns in the row-count
# comparison outputs (kept equal to other tools' output columns).
EQUAL_ROWCOUNT_KEY = "id_dbtutils_test_equal_rowcount"
FEWER_ROWS_KEY = "id_dbtutils_test_fewer_rows_than"


def _counts(df: DataFrame, group_by: Sequence[str], fake: str, count_col: str) -> DataFrame:
    return df.groupBy(*group_by).agg(F.count(F.lit(1)).alias(count_col)).withColumn(fake, F.lit(1))


def _full_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str], fake: str, ca: str, cb: str) -> DataFrame:
    # both sides are aggregated first, so this join is between two small tables
    left = _counts(a, group_by, fake, ca).select(*[F.col(c).alias(f"{c}_a") for c in [fake, *group_by]], ca)
    right = _counts(b, group_by, fake, cb).select(*[F.col(c).alias(f"{c}_b") for c in [fake, *group_by]], cb)
    cond = F.col(f"{fake}_a") == F.col(f"{fake}_b")
    for c in group_by:
        cond = cond & (F.col(f"{c}_a") == F.col(f"{c}_b"))
    j = left.join(right, cond, "full")
    order = []
    for c in [fake, *group_by]:
        order += [f"{c}_a", f"{c}_b"]
    return j.select(*order, ca, cb)


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = (), strict_groups: bool = False,
                   relation: str = "model") -> Check:
    """Row counts (per group) compared with a full join of the two count
    tables (C17).  Measure ``sum(coalesce(diff_count, 0))``: a group present on
    one side only counts 0 unless ``strict_groups=True``."""
    fake = EQUAL_ROWCOUNT_KEY

    def rows():
        j = _full_counts(a, b, group_by, fake, "count_a", "count_b")
        return j.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))

    def measure(rows):
        d = F.coalesce(F.col("count_a"), F.lit(0)) - F.coalesce(F.col("count_b"), F.lit(0)) \
            if strict_groups else F.col("diff_count")
        return F.sum(F.coalesce(F.abs(d), F.lit(0)))
    return Check("equal_rowcount", relation, rows, measure=measure)


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = (),
                    relation: str = "model") -> Check:
    """``a`` must have fewer rows than ``b`` (per group) (C18).  Delta: more
    rows → the excess; equal → 1; fewer or a missing side → 0."""
    fake = FEWER_ROWS_KEY

    def rows():
        j = _full_counts(a, b, group_by, fake, "count_our_model", "count_comparison_model")
        our, cmp_ = F.col("count_our_model"), F.col("count_comparison_model")
        return j.withColumn("row_count_delta", F.when(our > cmp_, our - cmp_).when(our == cmp_, F.lit(1))
                            .otherwise(F.lit(0)).cast("bigint"))
    return Check("fewer_rows_than", relation, rows,
                 measure=lambda r: F.sum(F.coalesce(F.col("row_count_delta"), F.lit(0))))


def cardinality_equality(a: DataFrame, column: str, b: DataFrame, field: str,
                         relation: str = "model") -> Check:
    """(value, row count) pairs found in only one table."""
    def rows():
        ca = a.groupBy(col(column).alias(column)).agg(F.count(F.lit(1)).alias("num_rows"))
        cb = b.groupBy(col(field).alias(column)).agg(F.count(F.lit(1)).alias("num_rows"))
        return symmetric_difference(ca, cb).drop("which_diff")
    return Check(f"cardinality_equality_{column}", relation, rows)
