"""Composite jobs — the user entry points (K1–K5)."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from medallion.operators import checks as C
from medallion.operators import gold, marts
from medallion.operators.silver import national_percentile, percent_rank_pct, transform_silver
from medallion.session import checkpointed
from medallion.sources.csv import enforce_schema, with_audit
from medallion.sources.snapshots import SnapshotTable
from medallion.sources.tables import drop_partitions, observed, overwrite_partitions

# The 16-column raw schema of the yearly extracts.
BRONZE_SCHEMA = T.StructType([
    T.StructField("nu_inscricao", T.StringType(), False),
    T.StructField("ano", T.IntegerType(), False),
    T.StructField("sg_uf_residencia", T.StringType()),
    T.StructField("regiao", T.StringType()),
    T.StructField("tp_sexo", T.StringType()),
    T.StructField("nu_idade", T.IntegerType()),
    T.StructField("tp_escola", T.StringType()),
    T.StructField("renda_familiar", T.StringType()),
    T.StructField("in_treineiro", T.IntegerType()),
    T.StructField("tp_presenca", T.StringType()),
    T.StructField("nu_nota_cn", T.DoubleType()),
    T.StructField("nu_nota_ch", T.DoubleType()),
    T.StructField("nu_nota_lc", T.DoubleType()),
    T.StructField("nu_nota_mt", T.DoubleType()),
    T.StructField("nu_nota_redacao", T.DoubleType()),
    T.StructField("dt_carga", T.StringType()),
])


def bronze(spark: SparkSession, paths: str | Sequence[str], target: str,
           schema: T.StructType = BRONZE_SCHEMA, rejects: str | None = None) -> dict:
    """K1: one scan over all years' files (a glob or a list, see
    ``csv.existing_year_paths``, which skips absent years with a warning) →
    typed rows, rejects kept apart → audit columns → reload of exactly the
    years present (dynamic partition overwrite).  Rejected rows always go to
    ``rejects`` (default: ``<target>_rejects``), one partition per file, and are
    counted."""
    good, rejected = enforce_schema(spark, paths, schema, mode="quarantine")
    rows, obs = observed(with_audit(good))
    overwrite_partitions(rows, target, ["ano"])
    # a reload of a file replaces that file's rejects
    bad, bad_obs = observed(rejected)
    rejects = rejects or f"{target.rstrip('/')}_rejects"
    drop_partitions(spark, rejects, [{"_source_file": unquote(f.rsplit("/", 1)[-1])} for f in good.inputFiles()])
    overwrite_partitions(bad, rejects, ["_source_file"])
    return {"rows": obs.get.get("rows", 0), "rejected": bad_obs.get.get("rows", 0)}


def silver(spark: SparkSession, bronze_df: DataFrame, table: SnapshotTable,
           keys: Sequence[str] = ("nu_inscricao", "ano"), percentile_strategy: str = "histogram",
           **silver_args) -> int:
    """K2: silver rows upserted by key into the snapshot table, then the
    percentile added as a schema-evolving new version.  Running it twice with
    the same input gives the same rows."""
    rows = transform_silver(bronze_df, **silver_args)
    table.upsert(rows, keys, by_partition=True)

    def with_pct(df: DataFrame) -> DataFrame:
        base = df.drop("percentil_nacional")
        if percentile_strategy == "histogram":
            return national_percentile(base)
        return percent_rank_pct(base, ["ano"], "media_geral", strategy=percentile_strategy)
    return table.add_column(with_pct)


def gold_marts(silver_df: DataFrame) -> dict[str, DataFrame]:
    """K3: the three marts over the silver table."""
    return {"gold_uf": gold.performance_by_uf(silver_df),
            "gold_income": gold.performance_by_income(silver_df),
            "gold_yoy": gold.yearly_evolution(silver_df)}


def quality(m: dict[str, DataFrame]) -> DataFrame:
    """K4: the declared checks on the marts as one report.  The marts (a few hundred rows)
    are written once, so that fused and single checks do not compute them again."""
    m = {k: checkpointed(df) for k, df in m.items()}
    uf, inc, yoy = m["gold_uf"], m["gold_income"], m["gold_yoy"]
    checks = [C.not_null(uf, c, relation="gold_uf") for c in
              ("uf", "ano", "total_candidatos", "media_geral", "pct_escola_publica")]
    checks += [C.accepted_range(uf, "pct_escola_publica", 0, 100, relation="gold_uf"),
               C.not_null(inc, "grupo_renda", relation="gold_income"),
               C.accepted_values(inc, "grupo_renda", ["Baixa", "Média", "Alta"], relation="gold_income"),
               C.not_null(inc, "media_geral", relation="gold_income"),
               C.not_null(yoy, "regiao", relation="gold_yoy"),
               C.not_null(yoy, "ano", relation="gold_yoy")]
    return C.run_checks(checks)


def pages(m: dict[str, DataFrame], table: SnapshotTable | None = None) -> dict[str, DataFrame]:
    """K5: the data behind each report page (no rendering)."""
    uf, inc = m["gold_uf"], m["gold_income"]
    latest_inc = marts.latest_period(inc)
    out = {"kpis": marts.overview_kpis(uf), "region_means": marts.region_means(uf),
           "ranking": marts.ranking(uf),
           "income_means": marts.group_mean_sorted(latest_inc, "grupo_renda", "media_geral"),
           "school_crosstab": marts.cross_tab_mean(latest_inc, "grupo_renda", "tp_escola", "media_geral"),
           "density": marts.density_grid(latest_inc, "grupo_renda", "tp_escola", "pct_bom_ou_excelente"),
           "yearly": m["gold_yoy"]}
    if table is not None:
        out["history"] = table.history()
        out["schema_by_version"] = table.schema_by_version()
        out["file_stats"] = table.file_stats()
    return out


__all__ = ["bronze", "silver", "gold_marts", "quality", "pages", "BRONZE_SCHEMA"]

