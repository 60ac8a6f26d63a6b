"""Report-page queries over the gold marts."""

from __future__ import annotations


from medallion.bindings.common import rounded_avg_sql
from medallion.bindings.tiers import GOLD_INCOME_SQL, GOLD_UF_SQL, _W, silver_pct
from medallion.operators import gold, marts

# The customer segments of the test tables (pivot columns).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _uf(spark, sf_dir):
    return gold.performance_by_uf(silver_pct(spark, sf_dir))


def _income(spark, sf_dir):
    return gold.performance_by_income(silver_pct(spark, sf_dir))


QUERIES = {
    "kpis": lambda s, d: marts.overview_kpis(_uf(s, d)),
    "kpis_weighted": lambda s, d: marts.overview_kpis(_uf(s, d), weighted=True),
    "region_means": lambda s, d: marts.region_means(_uf(s, d)),
    "income_means": lambda s, d: marts.group_mean_sorted(marts.latest_period(_income(s, d)),
                                                         "grupo_renda", "media_geral"),
    "school_crosstab": lambda s, d: marts.cross_tab_mean(marts.latest_period(_income(s, d)),
                                                         "grupo_renda", "tp_escola", "media_geral",
                                                         values=SEGMENTS),
    "density_grid": lambda s, d: marts.density_grid(marts.latest_period(_income(s, d)),
                                                    "grupo_renda", "tp_escola", "pct_bom_ou_excelente"),
    "ranking": lambda s, d: marts.ranking(_uf(s, d)),
    "latest_year": lambda s, d: marts.latest_period(_uf(s, d)),
    "column_summary": lambda s, d: marts.column_summary(silver_pct(s, d), "media_geral"),
}

_UF = f"{_W}, {GOLD_UF_SQL}, uf_latest AS (SELECT * FROM gold_uf WHERE ano = (SELECT max(ano) FROM gold_uf))"
_INC = (f"{_W}, {GOLD_INCOME_SQL}, inc_latest AS "
        f"(SELECT * FROM gold_income WHERE ano = (SELECT max(ano) FROM gold_income))")
_pivot_cols = ", ".join(
    f"{rounded_avg_sql(f'CASE WHEN tp_escola = {chr(39)}{v}{chr(39)} THEN media_geral END')} AS \"{v}\""
    for v in SEGMENTS)
_wmean = ("CAST(ROUND(CAST(CAST(SUM(CAST({c} AS DECIMAL(18,2)) * total_candidatos) AS DOUBLE) "
          "/ SUM(total_candidatos) AS DECIMAL(28,10)), 2) AS DOUBLE)")

ORACLE = {
    "kpis": f"""{_UF} SELECT CAST(SUM(total_candidatos) AS BIGINT) AS total_candidatos,
        {rounded_avg_sql('media_geral')} AS media_geral, {rounded_avg_sql('media_matematica')} AS media_matematica,
        {rounded_avg_sql('pct_escola_publica')} AS pct_escola_publica, COUNT(DISTINCT uf) AS n_uf FROM uf_latest""",
    "kpis_weighted": f"""{_UF} SELECT CAST(SUM(total_candidatos) AS BIGINT) AS total_candidatos,
        {_wmean.format(c='media_geral')} AS media_geral, {_wmean.format(c='media_matematica')} AS media_matematica,
        {_wmean.format(c='pct_escola_publica')} AS pct_escola_publica, COUNT(DISTINCT uf) AS n_uf FROM uf_latest""",
    "region_means": f"""{_UF} SELECT regiao, {rounded_avg_sql('media_geral')} AS media,
        CAST(SUM(total_candidatos) AS BIGINT) AS n FROM uf_latest GROUP BY regiao""",
    "income_means": f"""{_INC} SELECT grupo_renda, {rounded_avg_sql('media_geral')} AS media_geral
        FROM inc_latest GROUP BY grupo_renda""",
    "school_crosstab": f"{_INC} SELECT grupo_renda, {_pivot_cols} FROM inc_latest GROUP BY grupo_renda",
    "density_grid": f"""{_INC} SELECT grupo_renda, tp_escola,
        {rounded_avg_sql('pct_bom_ou_excelente')} AS pct_bom_ou_excelente FROM inc_latest GROUP BY 1, 2""",
    "ranking": f"""{_UF} SELECT *, CAST(RANK() OVER (PARTITION BY ano ORDER BY media_geral DESC NULLS LAST) AS INTEGER)
        AS rank
        FROM uf_latest""",
    "latest_year": f"{_UF} SELECT * FROM uf_latest",
    "column_summary": f"""{_W} SELECT COUNT(*) AS n_rows, {rounded_avg_sql('media_geral')} AS avg_media_geral
        FROM silver_pct""",
}
