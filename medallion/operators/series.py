"""Number series and date spines (G1–G3), generated by ``spark.range`` so the
rows are made in parallel, never by a single-task window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.dates import DATE_PARTS, date_add_part, intervals_between
from medallion.session import ntz_literal


def generate_series(spark: SparkSession, n: int) -> DataFrame:
    """``generated_number`` 1..n (G1)."""
    if n is None or int(n) <= 0:
        raise ValueError("generate_series needs n >= 1")
    return spark.range(1, int(n) + 1).select(F.col("id").alias("generated_number"))


def _lit(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.datetime):
        return ntz_literal(v)
    if isinstance(v, dt.date):
        return F.lit(v)
    return F.lit(v)


def date_spine(spark: SparkSession, datepart: str, start, end) -> DataFrame:
    """One row per period from ``start`` (inclusive) to ``end`` (exclusive),
    column ``date_<datepart>`` (G2).  The count of periods is computed once on
    the driver from the two bounds; the rows come from ``spark.range``."""
    p = datepart.lower()
    if p not in DATE_PARTS:
        raise ValueError(f"unsupported date part {datepart!r}")
    row = spark.range(1).select(intervals_between(_lit(start), _lit(end), p).alias("k")).first()
    k = int(row["k"]) if row and row["k"] is not None else 0
    out_col = f"date_{p}"
    if k <= 0:
        return spark.range(0).select(_lit(start).alias(out_col))
    start_c = _lit(start)
    value = date_add_part(p, F.col("id").cast("int"), start_c)
    if p in ("day", "week", "month", "quarter", "year") and not isinstance(start, dt.datetime):
        value = value.cast("date")
    return spark.range(k).select(value.alias(out_col)).where(F.col(out_col) <= _lit(end))


def date_spine_over(df: DataFrame, column: str, datepart: str = "day") -> DataFrame:
    """Spine covering the periods of ``column`` in ``df``: from the first
    period to one past the last (so the last period is included)."""
    spark = df.sparkSession
    p = datepart.lower()
    b = df.agg(F.date_trunc(p, F.min(column)).alias("lo"),
               date_add_part(p, 1, F.date_trunc(p, F.max(column))).alias("hi")).first()
    if b is None or b["lo"] is None:
        return spark.range(0).select(F.lit(None).cast("date").alias(f"date_{p}"))
    lo, hi = b["lo"], b["hi"]
    if p in ("day", "week", "month", "quarter", "year"):
        lo, hi = lo.date(), hi.date()
    return date_spine(spark, p, lo, hi)
