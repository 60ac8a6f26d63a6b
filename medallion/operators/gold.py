"""Gold tier: grouped marts and period-over-period change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions import pct_of_total, rounded_avg, snap_round


def _valid(silver: DataFrame) -> DataFrame:
    # the filter is on the input column, not on the output alias of the same name
    return silver.where(F.col("media_geral").isNotNull())


def performance_by_uf(silver: DataFrame) -> DataFrame:
    """State × region × year mart (A1)."""
    return (_valid(silver)
            .groupBy(F.col("sg_uf_residencia").alias("uf"), "regiao", "ano")
            .agg(F.count(F.lit(1)).alias("total_candidatos"),
                 rounded_avg("media_geral").alias("media_geral"),
                 rounded_avg("nu_nota_redacao", scale=1).alias("media_redacao"),
                 rounded_avg("nu_nota_mt", scale=1).alias("media_matematica"),
                 rounded_avg("nu_nota_cn", scale=1).alias("media_ciencias"),
                 rounded_avg("nu_nota_ch", scale=1).alias("media_humanas"),
                 rounded_avg("nu_nota_lc", scale=1).alias("media_linguagens"),
                 rounded_avg("percentil_nacional", scale=1).alias("percentil_medio"),
                 F.sum("fl_escola_publica").alias("n_escola_publica"),
                 pct_of_total(F.col("fl_escola_publica") == 1).alias("pct_escola_publica"),
                 pct_of_total(F.col("faixa_desempenho") == "Excelente").alias("pct_excelente")))


def performance_by_income(silver: DataFrame) -> DataFrame:
    """Year × income group × school type × public flag mart (A2)."""
    return (_valid(silver)
            .groupBy("ano", "grupo_renda", "tp_escola", "fl_escola_publica")
            .agg(F.count(F.lit(1)).alias("total_candidatos"),
                 rounded_avg("media_geral").alias("media_geral"),
                 rounded_avg("nu_nota_redacao", scale=1).alias("media_redacao"),
                 rounded_avg("nu_nota_mt", scale=1).alias("media_matematica"),
                 rounded_avg("percentil_nacional", scale=1).alias("percentil_medio"),
                 pct_of_total(F.col("faixa_desempenho").isin("Excelente", "Bom"))
                 .alias("pct_bom_ou_excelente")))


def yearly_base(silver: DataFrame) -> DataFrame:
    """Year × region base (A3)."""
    return (_valid(silver)
            .groupBy("ano", "regiao")
            .agg(rounded_avg("media_geral").alias("media_geral"),
                 rounded_avg("nu_nota_redacao", scale=1).alias("media_redacao"),
                 rounded_avg("nu_nota_mt", scale=1).alias("media_matematica"),
                 F.count(F.lit(1)).alias("n_candidatos")))


def period_change(df: DataFrame, partition_by: Sequence[str], order_by: str, value: str,
                  prev_col: str | None = None, delta_col: str = "variacao_yoy",
                  pct_col: str = "variacao_yoy_pct", delta_digits: int = 2, pct_digits: int = 1) -> DataFrame:
    """Previous row's value, absolute change and % change.

    "Previous" is the previous row in order, not ``order - 1``; the first row
    gets NULLs; a previous value of 0 gives a NULL percentage."""
    prev_col = prev_col or f"{value}_ano_anterior"
    w = Window.partitionBy(*partition_by).orderBy(F.col(order_by).asc_nulls_first())
    prev: Column = F.lag(value).over(w)
    return (df.withColumn(prev_col, prev)
              .withColumn(delta_col, snap_round(F.col(value) - F.col(prev_col), delta_digits))
              .withColumn(pct_col, snap_round(F.lit(100.0).cast("double") * (F.col(value) - F.col(prev_col))
                                              / F.nullif(F.col(prev_col), F.lit(0)), pct_digits)))


def yearly_evolution(silver: DataFrame) -> DataFrame:
    """Year × region mart with year-over-year change (A3 + W2)."""
    base = yearly_base(silver)
    out = period_change(base, ["regiao"], "ano", "media_geral")
    return out.select("ano", "regiao", "n_candidatos", "media_geral", "media_redacao", "media_matematica",
                      "media_geral_ano_anterior", "variacao_yoy", "variacao_yoy_pct")


def order_marts(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Presentation sort (L1); a sort is not kept by a stored table."""
    return df.orderBy(*keys)
