"""Read-side marts behind the report pages.

Everything stays in Spark: the page only renders the small result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions import exact_avg, rounded_avg, snap_round


def latest_period(df: DataFrame, col: str = "ano") -> DataFrame:
    """Rows of the latest period (L5): max as a one-row aggregate, broadcast
    back (one row is a proven size bound), no driver round trip."""
    top = df.agg(F.max(col).alias("_latest"))
    return df.join(F.broadcast(top), F.col(col) == F.col("_latest")).drop("_latest")


def for_period(df: DataFrame, col: str = "ano", value=None) -> DataFrame:
    """Rows of one period; ``value=None`` means the latest."""
    return latest_period(df, col) if value is None else df.where(F.col(col) == F.lit(value))


def overview_kpis(mart: DataFrame, ano=None, weighted: bool = False, approx: bool = False) -> DataFrame:
    """Headline numbers of one year of the state mart.

    The means are *unweighted* means of state means unless ``weighted=True``
    (then each state counts with its number of candidates).  ``approx=True``
    counts distinct states with ``approx_count_distinct`` (HyperLogLog)."""
    m = for_period(mart, "ano", ano)
    if weighted:
        n = F.sum("total_candidatos")

        def mean(c: str) -> Column:
            return snap_round(F.sum(F.col(c).cast("decimal(18,2)") * F.col("total_candidatos"))
                              .cast("double") / n, 2)
    else:
        def mean(c: str) -> Column:
            return rounded_avg(c)
    return m.agg(F.sum("total_candidatos").alias("total_candidatos"),
                 mean("media_geral").alias("media_geral"),
                 mean("media_matematica").alias("media_matematica"),
                 mean("pct_escola_publica").alias("pct_escola_publica"),
                 (F.approx_count_distinct("uf") if approx else F.count_distinct("uf")).alias("n_uf"))


def region_means(mart: DataFrame, ano=None) -> DataFrame:
    """Mean of state means and total candidates per region, best first."""
    return (for_period(mart, "ano", ano)
            .groupBy("regiao")
            .agg(rounded_avg("media_geral").alias("media"), F.sum("total_candidatos").alias("n"))
            .orderBy(F.col("media").desc(), F.col("regiao")))


def group_mean_sorted(df: DataFrame, key: str, value: str, alias: str | None = None,
                      digits: int = 2) -> DataFrame:
    """Mean of ``value`` per ``key``, ascending."""
    a = alias or value
    return df.groupBy(key).agg(rounded_avg(value, digits).alias(a)).orderBy(F.col(a), F.col(key))


def cross_tab_mean(df: DataFrame, rows: str | Sequence[str], cols: str, value: str,
                   values: Sequence | None = None, digits: int = 2) -> DataFrame:
    """Mean of ``value`` with ``rows`` down and one column per ``cols`` value
    (A16); a missing cell is NULL.  Pass ``values`` to skip the distinct pass."""
    rows = [rows] if isinstance(rows, str) else list(rows)
    g = df.groupBy(*rows)
    p = g.pivot(cols, list(values)) if values is not None else g.pivot(cols)
    return p.agg(rounded_avg(value, digits))


def density_grid(df: DataFrame, x: str, y: str, z: str, agg: str = "avg",
                 digits: int = 2) -> DataFrame:
    """Heat-map cells in long form: one row per (x, y) with agg(z)."""
    fns = {"avg": lambda c: rounded_avg(c, digits), "sum": F.sum, "count": F.count,
           "min": F.min, "max": F.max}
    if agg not in fns:
        raise ValueError(f"agg must be one of {sorted(fns)}")
    return df.groupBy(x, y).agg(fns[agg](z).alias(z))


def ranking(mart: DataFrame, ano=None, ascending: bool = False, by: str = "media_geral",
            rank_col: str = "rank") -> DataFrame:
    """States of one year with their rank by ``by`` (L2)."""
    m = for_period(mart, "ano", ano)
    o = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    w = Window.partitionBy("ano").orderBy(o)
    return m.withColumn(rank_col, F.rank().over(w)).orderBy(rank_col, "uf")


def first_non_null(df: DataFrame, col: str) -> DataFrame:
    """At most one row with a non-NULL ``col``; stops scanning early (L4)."""
    return df.select(col).where(F.col(col).isNotNull()).limit(1)


def column_summary(df: DataFrame, col: str, digits: int = 2, scale: int = 2) -> DataFrame:
    """Row count and rounded mean of one column."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  snap_round(exact_avg(col, scale), digits).alias(f"avg_{col}"))
