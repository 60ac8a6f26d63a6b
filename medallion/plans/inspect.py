"""Reading physical plans (used by the plan-shape tests and when tuning)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The executed physical plan as text (AQE's initial plan when not run)."""
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(df: DataFrame, name: str) -> int:
    """How many lines of the physical plan mention ``name`` (e.g. 'FileScan')."""
    return sum(1 for line in physical_plan(df).splitlines() if name in line)


def uses_python(df: DataFrame) -> bool:
    """Whether the plan evaluates Python code per row or per Arrow batch."""
    p = physical_plan(df)
    return any(n in p for n in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                "MapInPandas", "PythonUDF"))
