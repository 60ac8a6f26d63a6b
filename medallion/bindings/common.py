"""Shared helpers for the bindings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def snap_sql(expr: str, digits: int) -> str:
    """SQL text of ``functions.snap_round``."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def exact_avg_sql(col: str, scale: int = 2) -> str:
    """SQL text of ``functions.exact_avg``."""
    return f"(CAST(SUM(CAST({col} AS DECIMAL(18,{scale}))) AS DOUBLE) / NULLIF(COUNT({col}), 0))"


def rounded_avg_sql(col: str, digits: int = 2, scale: int = 2) -> str:
    return snap_sql(exact_avg_sql(col, scale), digits)


def pct_sql(cond: str, digits: int = 1) -> str:
    return snap_sql(f"CAST(100.0 AS DOUBLE) * SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) / COUNT(*)", digits)
