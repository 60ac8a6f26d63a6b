"""Run a list of checks into one report.

Checks that expose a fused aggregate and read the same DataFrame are computed
together: one ``agg`` over that table with one conditional aggregate per check,
then unpivoted to one row per check.  Other checks contribute their own
one-row failures aggregate.  All parts are unioned into one DataFrame, so the
whole report is one Spark action."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.operators.checks.core import Check


def _report_rows(checks_and_failures: list[tuple[int, Check]], failures_df: DataFrame,
                 col_of: dict[int, str]) -> DataFrame:
    """One report row per check, made from the single row of ``failures_df``
    by one ``inline`` — the aggregate below is computed once, not per check."""
    structs = []
    for i, chk in checks_and_failures:
        f = F.coalesce(F.col(col_of[i]).cast("bigint"), F.lit(0).cast("bigint"))
        structs.append(F.struct(F.lit(i).alias("check_index"), F.lit(chk.name).alias("check"),
                                F.lit(chk.relation).alias("relation"), f.alias("failures"),
                                chk.status(f).alias("status")))
    return failures_df.select(F.inline(F.array(*structs)))


def run_checks(checks: Sequence[Check], fuse: bool = True) -> DataFrame:
    """Report with columns (check_index, check, relation, failures, status).

    ``fuse=False`` runs every check on its own (one scan each) — the shape to
    compare against."""
    if not checks:
        raise ValueError("no checks to run")
    groups: dict[int, list[tuple[int, Check]]] = {}
    singles: list[tuple[int, Check]] = []
    for i, c in enumerate(checks):
        if fuse and c.fused is not None and c.source is not None:
            groups.setdefault(id(c.source), []).append((i, c))
        else:
            singles.append((i, c))
    parts = []
    for members in groups.values():
        src = members[0][1].source
        cols = {i: f"_f{i}" for i, _ in members}
        agg = src.agg(*[c.fused.alias(cols[i]) for i, c in members])
        parts.append(_report_rows(members, agg, cols))
    for i, c in singles:
        parts.append(_report_rows([(i, c)], c.failures(), {i: "failures"}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failed(report: DataFrame) -> DataFrame:
    """Rows of the report that did not pass (warnings do not stop a pipeline)."""
    return report.where(F.col("status") != "pass")
