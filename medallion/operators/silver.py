"""Silver tier: row filter, derived scores, bands, flags, income groups and the
per-period percentile (P1–P7, P15, W1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions import band, flag_contains, map_groups, mean_of, snap_round, weighted_mean
from medallion.plans.ranged import _null_safe_join, ranged_prefix_sum
from medallion.session import checkpointed

# Labels, thresholds and groupings of the silver rules.
PRESENT = "Presente"
OBJECTIVE_SCORES = ["nu_nota_cn", "nu_nota_ch", "nu_nota_lc", "nu_nota_mt"]
ESSAY_SCORE = "nu_nota_redacao"
BANDS = [(700, "Excelente"), (600, "Bom"), (500, "Regular"), (400, "Abaixo da Média")]
BAND_OTHERWISE = "Insuficiente"
PUBLIC_SCHOOL_MARK = "Pública"
INCOME_GROUPS = {"Baixa": ["Nenhuma", "Até 1 SM"], "Média": ["1-2 SM", "2-5 SM"]}
INCOME_OTHERWISE = "Alta"
AUDIT_COLUMNS = ("_bronze_loaded_at", "_source_file")


def keep_valid(df: DataFrame, presence: str = PRESENT, trainee: int = 0,
               presence_col: str = "tp_presenca", trainee_col: str = "in_treineiro") -> DataFrame:
    """Keep present, non-trainee rows; NULL in either column drops the row."""
    return df.filter((F.col(presence_col) == F.lit(presence)) & (F.col(trainee_col) == F.lit(trainee)))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*names)


def ensure_columns(df: DataFrame, target_schema) -> DataFrame:
    """Add the target's missing columns as NULLs of the target's type."""
    have = {c.lower() for c in df.columns}
    for f in target_schema.fields:
        if f.name.lower() not in have:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df


def transform_silver(df: DataFrame, income_groups=None, school_mark: str = PUBLIC_SCHOOL_MARK,
                     presence: str = PRESENT, audit: bool = True, income_col: str = "renda_familiar",
                     school_col: str = "tp_escola") -> DataFrame:
    """Bronze → silver rows (without the percentile, which needs the whole table)."""
    groups = INCOME_GROUPS if income_groups is None else income_groups
    out = (keep_valid(df, presence=presence)
           .withColumn("media_objetivas", mean_of(OBJECTIVE_SCORES, 2))
           .withColumn("media_geral", weighted_mean([("media_objetivas", 4), (ESSAY_SCORE, 1)], 2))
           .withColumn("faixa_desempenho", band("media_geral", BANDS, BAND_OTHERWISE))
           .withColumn("fl_escola_publica", flag_contains(school_col, school_mark))
           .withColumn("grupo_renda", map_groups(income_col, groups, INCOME_OTHERWISE)))
    if audit:
        out = out.withColumn("_silver_updated_at", F.current_timestamp())
    return out.drop(*AUDIT_COLUMNS)


# Fixed value: the overall score has 2 decimals within [0, 1000], so a year
# holds at most 100,001 distinct scores — a bound on the rank histogram per
# year that does not grow with the data; one window task per year suffices.
SCORE_RANK_BUCKETS = 1


def national_percentile(df: DataFrame, out_col: str = "percentil_nacional") -> DataFrame:
    """The silver percentile column (W1): percent rank of ``media_geral``
    within each year, histogram strategy with the score-domain bound above."""
    return percent_rank_pct(df, ["ano"], "media_geral", out_col, strategy="histogram",
                            n_buckets=SCORE_RANK_BUCKETS)


def percent_rank_pct(df: DataFrame, partition_by: Sequence[str] = ("ano",), order_by: str = "media_geral",
                     out_col: str = "percentil_nacional", digits: int = 1,
                     strategy: str = "histogram", n_buckets: int | None = None) -> DataFrame:
    """``round(percent_rank() over (partition by … order by … nulls first) * 100, digits)``.

    ``strategy="window"`` is the plain window: one task sorts a whole partition
    (a whole year).  ``strategy="histogram"`` counts rows per (partition, value)
    with a map-side partial aggregate, takes an exclusive running count over the
    distinct values and joins it back: ``(rows before) / (n - 1)``, 0 for a
    one-row partition.  A partition with more distinct values than one bucket's
    share (``n_buckets``, default: the shuffle partitions) has its running
    count range-bucketed (``plans.ranged``); ``n_buckets=1`` never cuts."""
    parts = list(partition_by)
    if strategy == "window":
        w = Window.partitionBy(*parts).orderBy(F.col(order_by).asc_nulls_first())
        return df.withColumn(out_col, snap_round(F.percent_rank().over(w) * 100, digits))
    if strategy != "histogram":
        raise ValueError("strategy must be 'histogram' or 'window'")
    hist = df.groupBy(*parts, order_by).agg(F.count(F.lit(1)).alias("_pr_c"))
    if n_buckets == 1:
        # one window task per partition over its distinct values; running and
        # total counts share the partitioning and the sort
        run = Window.partitionBy(*parts).orderBy(F.col(order_by).asc_nulls_first()) \
                    .rowsBetween(Window.unboundedPreceding, -1)
        hist = (hist.withColumn("_pr_before", F.coalesce(F.sum("_pr_c").over(run), F.lit(0)))
                    .withColumn("_pr_n", F.sum("_pr_c").over(Window.partitionBy(*parts))))
    else:
        # the histogram is read several times (sizing the buckets, the running
        # count, the totals): materialise it once in the shared checkpoint
        # folder so the input's lineage is evaluated once for it; partitions
        # with more distinct values than one bucket's share are range-bucketed
        counts = checkpointed(hist)
        hist = ranged_prefix_sum(counts, "_pr_c", order_by, "_pr_before", parts, n_buckets)
        totals = counts.groupBy(*parts).agg(F.sum("_pr_c").alias("_pr_n"))
        hist = _null_safe_join(hist, totals, parts, "left") if parts else hist.crossJoin(F.broadcast(totals))
    pr = F.when(F.col("_pr_n") > 1, F.col("_pr_before").cast("double") / (F.col("_pr_n") - 1).cast("double")) \
          .otherwise(F.lit(0.0))
    ranks = hist.select(*parts, order_by, snap_round(pr * 100, digits).alias(out_col))
    return _null_safe_join(df, ranks, parts + [order_by], "left")
