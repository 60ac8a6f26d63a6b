"""The ``scored`` binding: a table shaped like the 16-column bronze input,
derived from orders ⋈ customer ⋈ nation ⋈ region, left-joined with per-order
lineitem means (orders without lines get NULL scores)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.bindings.common import exact_avg_sql, snap_sql, table
from medallion.functions import exact_avg, snap_round

# How the test tables stand in for the silver rules' inputs.
PRESENCE = "F"                      # o_orderstatus kept by the row filter
SCHOOL_MARK = "BUILD"               # c_mktsegment substring flagged as public
INCOME_GROUPS = {"Baixa": ["4-NOT SPECIFIED", "5-LOW"], "Média": ["2-HIGH", "3-MEDIUM"]}
SILVER_ARGS = dict(presence=PRESENCE, school_mark=SCHOOL_MARK, income_groups=INCOME_GROUPS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(snap_round(exact_avg("l_quantity", 4) * 20, 1).alias("nu_nota_cn"),
               snap_round(exact_avg("l_discount", 4) * 10000, 1).alias("nu_nota_ch"),
               snap_round(exact_avg("l_tax", 4) * 12500, 1).alias("nu_nota_lc"),
               snap_round(exact_avg("l_extendedprice", 4) / 105, 1).alias("nu_nota_mt")))
    geo = (table(spark, sf_dir, "nation")
           .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    base = (o.join(c, o.o_custkey == c.c_custkey)
             .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    return base.select(
        F.col("o_orderkey").cast("string").alias("nu_inscricao"),
        F.year("o_orderdate").alias("ano"),
        F.col("n_name").alias("sg_uf_residencia"),
        F.col("r_name").alias("regiao"),
        F.when(F.col("c_acctbal") >= 5000, "F").otherwise("M").alias("tp_sexo"),
        F.least(F.lit(65), F.lit(14) + F.floor(F.abs("c_acctbal") / 200).cast("int")).alias("nu_idade"),
        F.col("c_mktsegment").alias("tp_escola"),
        F.col("o_orderpriority").alias("renda_familiar"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("in_treineiro"),
        F.col("o_orderstatus").alias("tp_presenca"),
        "nu_nota_cn", "nu_nota_ch", "nu_nota_lc", "nu_nota_mt",
        (F.floor(F.col("o_totalprice") / 500 / 40) * 40).cast("double").alias("nu_nota_redacao"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("dt_carga"),
    )


SCORED_SQL = f"""
li AS (
  SELECT l_orderkey,
    {snap_sql(exact_avg_sql('l_quantity', 4) + ' * 20', 1)} AS nu_nota_cn,
    {snap_sql(exact_avg_sql('l_discount', 4) + ' * 10000', 1)} AS nu_nota_ch,
    {snap_sql(exact_avg_sql('l_tax', 4) + ' * 12500', 1)} AS nu_nota_lc,
    {snap_sql(exact_avg_sql('l_extendedprice', 4) + ' / 105', 1)} AS nu_nota_mt
  FROM lineitem GROUP BY l_orderkey
),
scored AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS nu_inscricao,
    CAST(year(o_orderdate) AS INTEGER) AS ano,
    n_name AS sg_uf_residencia, r_name AS regiao,
    CASE WHEN c_acctbal >= 5000 THEN 'F' ELSE 'M' END AS tp_sexo,
    least(65, 14 + CAST(floor(abs(c_acctbal) / 200) AS INTEGER)) AS nu_idade,
    c_mktsegment AS tp_escola, o_orderpriority AS renda_familiar,
    CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS in_treineiro,
    o_orderstatus AS tp_presenca,
    nu_nota_cn, nu_nota_ch, nu_nota_lc, nu_nota_mt,
    CAST(floor(o_totalprice / 500 / 40) * 40 AS DOUBLE) AS nu_nota_redacao,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dt_carga
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN li ON o_orderkey = l_orderkey
)"""

SILVER_SQL = SCORED_SQL + f""",
silver AS (
  SELECT s.*,
    CASE WHEN media_geral >= 700 THEN 'Excelente' WHEN media_geral >= 600 THEN 'Bom'
         WHEN media_geral >= 500 THEN 'Regular' WHEN media_geral >= 400 THEN 'Abaixo da Média'
         ELSE 'Insuficiente' END AS faixa_desempenho,
    CASE WHEN contains(tp_escola, 'BUILD') THEN 1 ELSE 0 END AS fl_escola_publica,
    CASE WHEN renda_familiar IN ('4-NOT SPECIFIED', '5-LOW') THEN 'Baixa'
         WHEN renda_familiar IN ('2-HIGH', '3-MEDIUM') THEN 'Média' ELSE 'Alta' END AS grupo_renda
  FROM (
    SELECT m.*, {snap_sql('(media_objetivas * 4 + nu_nota_redacao) / 5', 2)} AS media_geral
    FROM (
      SELECT scored.*, {snap_sql('(nu_nota_cn + nu_nota_ch + nu_nota_lc + nu_nota_mt) / 4', 2)} AS media_objetivas
      FROM scored WHERE tp_presenca = 'F' AND in_treineiro = 0
    ) m
  ) s
),
silver_pct AS (
  SELECT silver.*,
    {snap_sql('percent_rank() OVER (PARTITION BY ano ORDER BY media_geral ASC NULLS FIRST) * 100', 1)}
      AS percentil_nacional
  FROM silver
)"""
