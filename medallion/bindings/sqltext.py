"""Queries written as SQL text over registered views, with the library's SQL functions
(S8, E1–E10), and the jobs behind the report pages (K5, L1)."""

from __future__ import annotations

from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import functions as F

from medallion import jobs
from medallion.bindings import pages as page_queries
from medallion.bindings import scalars
from medallion.bindings.common import table
from medallion.bindings.tiers import GOLD_UF_SQL, _W, silver_pct
from medallion.functions.sql import register_functions
from medallion.operators import gold, marts
from medallion.session import checkpointed
from medallion.sources.tables import register_view


@contextmanager
def _view(df):
    """The name of a view of ``df``, which is gone once the query is analysed."""
    name = f"v_{uuid4().hex[:12]}"
    register_view(name, df)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


def _mean(c: str, scale: int) -> str:
    return f"snap_round_2(safe_divide(CAST(sum(CAST({c} AS DECIMAL(18,{scale}))) AS DOUBLE), count({c})))"


_GOLD = f"""
    SELECT sg_uf_residencia AS uf, regiao, ano, count(*) AS total_candidatos,
           {_mean('media_geral', 2)} AS media_geral, {_mean('nu_nota_redacao', 1)} AS media_redacao,
           {_mean('nu_nota_mt', 1)} AS media_matematica, {_mean('nu_nota_cn', 1)} AS media_ciencias,
           {_mean('nu_nota_ch', 1)} AS media_humanas, {_mean('nu_nota_lc', 1)} AS media_linguagens,
           {_mean('percentil_nacional', 1)} AS percentil_medio, sum(fl_escola_publica) AS n_escola_publica,
           pct_of(sum(CASE WHEN fl_escola_publica = 1 THEN 1 ELSE 0 END), count(*)) AS pct_escola_publica,
           pct_of(sum(CASE WHEN faixa_desempenho = 'Excelente' THEN 1 ELSE 0 END), count(*)) AS pct_excelente
    FROM {{view}} WHERE media_geral IS NOT NULL GROUP BY ALL"""


def q_gold_by_uf_sql(s, d):
    register_functions(s)
    with _view(silver_pct(s, d)) as v:
        return s.sql(_GOLD.format(view=v))


def q_scalars_sql(s, d):
    register_functions(s)
    with _view(table(s, d, "lineitem").selectExpr("*", "nullif(l_discount, 0.0D) AS disc", "nullif(l_tax, 0.0D) AS tax")) as v:
        return s.sql(f"""
            SELECT l_orderkey, l_linenumber, safe_add(disc, tax, l_quantity) AS safe_add, safe_subtract(l_quantity, disc, tax) AS safe_subtract,
                   safe_divide(l_extendedprice, disc) AS price_per_disc, width_bucket_compat(l_quantity, 0, 40, 8) AS qty_bucket,
                   surrogate_key(array(string(l_orderkey), string(l_linenumber), nullif(l_returnflag, 'N'))) AS sk
            FROM {v}""")


def q_url_parts_sql(s, d):
    register_functions(s)
    with _view(table(s, d, "pages")) as v:
        return s.sql(f"""SELECT page_id, url_host(url) AS host, url_path(url) AS path, url_parameter(url, 'page') AS page,
                                url_parameter(url, 'ref') AS ref FROM {v}""")


def q_haversine_sql(s, d):
    register_functions(s)
    with _view(scalars._geo(s, d)) as v:
        return s.sql(f"""SELECT c_custkey, snap_round_4(haversine(lat1, lon1, lat2, lon2)) AS dist_mi,
                                snap_round_4(haversine(lat1, lon1, lat2, lon2, 'km')) AS dist_km FROM {v}""")


def _page(name):
    """One page of the job that gathers all of them (K5)."""
    def q(s, d):
        return jobs.pages(jobs.gold_marts(checkpointed(silver_pct(s, d))))[name]
    return q


def q_kpis_approx(s, d):
    """The headline numbers with an approximate count of states, and whether that is
    within its bound (relative error 0.05, so three of these)."""
    uf = gold.performance_by_uf(silver_pct(s, d))
    n = marts.overview_kpis(uf).select(F.col("n_uf").alias("exact"))
    k = marts.overview_kpis(uf, approx=True).join(F.broadcast(n))
    return k.withColumn("n_uf_within", F.abs(F.col("n_uf") - F.col("exact")) <= F.col("exact") * 0.15).drop("n_uf", "exact")


def q_gold_ordered(s, d):
    """The state mart in its presentation order, with the place of each row (L1)."""
    ordered = gold.order_marts(gold.performance_by_uf(silver_pct(s, d)), F.col("ano"), F.col("media_geral").desc_nulls_last(), F.col("uf"))
    # the mart has a row per state, region and year: its order fits one list
    rows = ordered.agg(F.collect_list(F.struct("ano", "uf", "media_geral")).alias("r"))
    return rows.select(F.posexplode("r").alias("place", "r")).select("place", "r.ano", "r.uf", "r.media_geral")


QUERIES = {
    "gold_by_uf_sql": q_gold_by_uf_sql,
    "scalars_sql": q_scalars_sql,
    "url_parts_sql": q_url_parts_sql,
    "haversine_sql": q_haversine_sql,
    "kpis_approx": q_kpis_approx,
    "gold_ordered": q_gold_ordered,
    "pages_kpis": _page("kpis"),
    "pages_region_means": _page("region_means"),
    "pages_income_means": _page("income_means"),
    "pages_density": _page("density"),
}

ORACLE = {
    "gold_by_uf_sql": f"{_W}, {GOLD_UF_SQL} SELECT * FROM gold_uf",
    "scalars_sql": f"""SELECT l_orderkey, l_linenumber, coalesce(disc, 0) + coalesce(tax, 0) + coalesce(l_quantity, 0) AS safe_add,
        coalesce(l_quantity, 0) - coalesce(disc, 0) - coalesce(tax, 0) AS safe_subtract, l_extendedprice / NULLIF(disc, 0) AS price_per_disc,
        CASE WHEN CAST(l_quantity AS DECIMAL(28,6)) % CAST((40 - 0) / 8 AS DECIMAL(28,6)) = 0 THEN 1 ELSE 0 END
        + least(CAST(ceil((l_quantity - 0) / ((40 - 0) / 8)) AS BIGINT), 8 + 1) AS qty_bucket,
        md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
            coalesce(NULLIF(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_'))) AS sk FROM {scalars._LI}""",
    "url_parts_sql": scalars.ORACLE["url_parts"],
    "haversine_sql": scalars.ORACLE["haversine"],
    "kpis_approx": f"SELECT * EXCLUDE (n_uf), true AS n_uf_within FROM ({page_queries.ORACLE['kpis']})",
    "gold_ordered": f"""{_W}, {GOLD_UF_SQL} SELECT CAST(row_number() OVER (ORDER BY ano, media_geral DESC NULLS LAST, uf) - 1 AS INTEGER) AS place,
        ano, uf, media_geral FROM gold_uf""",
    "pages_kpis": page_queries.ORACLE["kpis"],
    "pages_region_means": page_queries.ORACLE["region_means"],
    "pages_income_means": page_queries.ORACLE["income_means"],
    "pages_density": page_queries.ORACLE["density_grid"],
}
