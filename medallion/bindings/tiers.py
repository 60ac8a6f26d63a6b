"""Silver and gold queries on the ``scored`` binding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.bindings.common import pct_sql, rounded_avg_sql, snap_sql
from medallion.bindings.scored import SILVER_ARGS, SILVER_SQL, scored
from medallion.operators import gold
from medallion.operators.silver import national_percentile, percent_rank_pct, transform_silver

SILVER_COLUMNS = [
    "nu_inscricao", "ano", "sg_uf_residencia", "regiao", "tp_sexo", "nu_idade", "tp_escola",
    "renda_familiar", "in_treineiro", "tp_presenca", "nu_nota_cn", "nu_nota_ch", "nu_nota_lc",
    "nu_nota_mt", "nu_nota_redacao", "dt_carga", "media_objetivas", "media_geral",
    "faixa_desempenho", "fl_escola_publica", "grupo_renda",
]


def silver(spark: SparkSession, sf_dir: str, audit: bool = False) -> DataFrame:
    return transform_silver(scored(spark, sf_dir), audit=audit, **SILVER_ARGS)


def silver_pct(spark: SparkSession, sf_dir: str, strategy: str = "histogram") -> DataFrame:
    if strategy == "histogram":
        return national_percentile(silver(spark, sf_dir))
    return percent_rank_pct(silver(spark, sf_dir), ["ano"], "media_geral", strategy=strategy)


def q_silver_scored(spark, sf_dir):
    return silver(spark, sf_dir).select(*SILVER_COLUMNS)


def q_silver_bands(spark, sf_dir):
    return (silver(spark, sf_dir)
            .groupBy("ano", "faixa_desempenho", "grupo_renda")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("fl_escola_publica").alias("n_escola_publica")))


def _pr(strategy):
    def q(spark, sf_dir):
        return silver_pct(spark, sf_dir, strategy).select("nu_inscricao", "ano", "media_geral",
                                                          "percentil_nacional")
    return q


def q_gold_by_uf(spark, sf_dir):
    return gold.performance_by_uf(silver_pct(spark, sf_dir))


def q_gold_by_income(spark, sf_dir):
    return gold.performance_by_income(silver_pct(spark, sf_dir))


def q_gold_yoy(spark, sf_dir):
    return gold.yearly_evolution(silver(spark, sf_dir))


QUERIES = {
    "silver_scored": q_silver_scored,
    "silver_bands": q_silver_bands,
    "percent_rank_window": _pr("window"),
    "percent_rank_histogram": _pr("histogram"),
    "percent_rank_bucketed": lambda s, d: percent_rank_pct(silver(s, d), ["ano"], "media_geral", n_buckets=None)
    .select("nu_inscricao", "ano", "media_geral", "percentil_nacional"),
    "gold_by_uf": q_gold_by_uf,
    "gold_by_income": q_gold_by_income,
    "gold_yoy": q_gold_yoy,
}

_W = "WITH " + SILVER_SQL

GOLD_UF_SQL = f"""
gold_uf AS (
  SELECT sg_uf_residencia AS uf, regiao, ano, COUNT(*) AS total_candidatos,
    {rounded_avg_sql('media_geral')} AS media_geral,
    {rounded_avg_sql('nu_nota_redacao')} AS media_redacao,
    {rounded_avg_sql('nu_nota_mt')} AS media_matematica,
    {rounded_avg_sql('nu_nota_cn')} AS media_ciencias,
    {rounded_avg_sql('nu_nota_ch')} AS media_humanas,
    {rounded_avg_sql('nu_nota_lc')} AS media_linguagens,
    {rounded_avg_sql('percentil_nacional')} AS percentil_medio,
    CAST(SUM(fl_escola_publica) AS BIGINT) AS n_escola_publica,
    {pct_sql('fl_escola_publica = 1')} AS pct_escola_publica,
    {pct_sql("faixa_desempenho = 'Excelente'")} AS pct_excelente
  FROM silver_pct WHERE media_geral IS NOT NULL
  GROUP BY 1, 2, 3
)"""

GOLD_INCOME_SQL = f"""
gold_income AS (
  SELECT ano, grupo_renda, tp_escola, fl_escola_publica, COUNT(*) AS total_candidatos,
    {rounded_avg_sql('media_geral')} AS media_geral,
    {rounded_avg_sql('nu_nota_redacao')} AS media_redacao,
    {rounded_avg_sql('nu_nota_mt')} AS media_matematica,
    {rounded_avg_sql('percentil_nacional')} AS percentil_medio,
    {pct_sql("faixa_desempenho IN ('Excelente', 'Bom')")} AS pct_bom_ou_excelente
  FROM silver_pct WHERE media_geral IS NOT NULL
  GROUP BY 1, 2, 3, 4
)"""

GOLD_YOY_SQL = f"""
base AS (
  SELECT ano, regiao,
    {rounded_avg_sql('media_geral')} AS media_geral,
    {rounded_avg_sql('nu_nota_redacao')} AS media_redacao,
    {rounded_avg_sql('nu_nota_mt')} AS media_matematica,
    COUNT(*) AS n_candidatos
  FROM silver WHERE media_geral IS NOT NULL GROUP BY ano, regiao
),
gold_yoy AS (
  SELECT ano, regiao, n_candidatos, media_geral, media_redacao, media_matematica,
    LAG(media_geral) OVER (PARTITION BY regiao ORDER BY ano) AS media_geral_ano_anterior,
    {snap_sql('media_geral - LAG(media_geral) OVER (PARTITION BY regiao ORDER BY ano)', 2)} AS variacao_yoy,
    {snap_sql('CAST(100.0 AS DOUBLE) * (media_geral - LAG(media_geral) OVER (PARTITION BY regiao ORDER BY ano)) / NULLIF(LAG(media_geral) OVER (PARTITION BY regiao ORDER BY ano), 0)', 1)} AS variacao_yoy_pct
  FROM base
)"""

_COLS = ", ".join(SILVER_COLUMNS)

ORACLE = {
    "silver_scored": f"{_W} SELECT {_COLS} FROM silver",
    "silver_bands": f"""{_W} SELECT ano, faixa_desempenho, grupo_renda, COUNT(*) AS n,
        CAST(SUM(fl_escola_publica) AS BIGINT) AS n_escola_publica
        FROM silver GROUP BY 1, 2, 3""",
    "percent_rank_window": f"{_W} SELECT nu_inscricao, ano, media_geral, percentil_nacional FROM silver_pct",
    "percent_rank_histogram": f"{_W} SELECT nu_inscricao, ano, media_geral, percentil_nacional FROM silver_pct",
    "percent_rank_bucketed": f"{_W} SELECT nu_inscricao, ano, media_geral, percentil_nacional FROM silver_pct",
    "gold_by_uf": f"{_W}, {GOLD_UF_SQL} SELECT * FROM gold_uf",
    "gold_by_income": f"{_W}, {GOLD_INCOME_SQL} SELECT * FROM gold_income",
    "gold_yoy": f"{_W}, {GOLD_YOY_SQL} SELECT * FROM gold_yoy",
}
