"""Checks over a growing table: each partition is scanned once.

A check that can be computed from parts keeps, per partition directory, what it needs of
its rows: counts, a least and a greatest value, or the rows of each value.  A report scans
the directories that are new or changed (see ``sources.partition_states``) and combines
the stored states of all that are there.  Changed check definitions start anew."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.checks.core import Check
from medallion.operators.checks.runner import _report_rows
from medallion.sources.partition_states import PART, PartitionStates, part_name
from medallion.sources.tables import path_exists

_MERGE = {"min": F.min, "max": F.max}
_VALUES = "run string, part string, at int, value string, n bigint"


class CheckStates:
    """The checks ``build(df)`` on the Parquet table at ``path``, with states kept under
    ``root``.  ``scanned`` holds the number of directories and rows read by the last report."""

    def __init__(self, spark: SparkSession, path: str, root: str, build: Callable[[DataFrame], Sequence[Check]],
                 schema: T.StructType | None = None):
        self.spark, self.path, self.root, self.build, self.schema = spark, path, root.rstrip("/"), build, schema
        self.scanned = {"partitions": 0, "rows": 0}

    def report(self) -> DataFrame:
        """The report of ``run_checks`` on the table as it is now."""
        schema = self.schema or self.spark.read.parquet(self.path).schema
        checks = list(self.build(self.spark.createDataFrame([], schema)))
        for c in checks:
            if not c.state and not c.keyed:
                raise ValueError(f"{c.name} cannot be computed from parts")
        # a list of checks has a folder of its own, so its states have one schema
        defined = [(c.name, c.relation, {k: (str(a), m) for k, (a, m) in (c.state or {}).items()}, str(c.keyed and c.keyed[0])) for c in checks]
        root = f"{self.root}/{hashlib.md5(repr(defined).encode()).hexdigest()}"
        values = f"{root}/values"

        def aggregates(df: DataFrame) -> dict[str, Column]:
            return {f"s{i}_{s}": a for i, c in enumerate(self.build(df)) for s, (a, _) in (c.state or {}).items()}

        def keep_values(rows: DataFrame, run: str) -> None:
            texts = [F.struct(F.lit(i).alias("at"), c.keyed[0].alias("value")) for i, c in enumerate(self.build(rows)) if c.keyed]
            if texts:
                (rows.select(PART, F.explode(F.array(*texts)).alias("k")).where("k.value is not null")
                 .groupBy(PART, "k.at", "k.value").agg(F.count(F.lit(1)).alias("n"))
                 .select(F.lit(run).alias("run"), F.col(PART).alias("part"), "at", "value", "n").write.mode("append").parquet(values))

        states = PartitionStates(self.spark, self.path, root, aggregates, schema)
        known = states.refresh(keep_values)
        self.scanned = states.scanned
        merged = [_merged(f"s{i}_{s}", how) for i, c in enumerate(checks) for s, (_, how) in (c.state or {}).items()]
        total = known.agg(F.lit(0).alias("_x"), *merged)
        cols = {i: f"f{i}" for i in range(len(checks))}
        plain = [(i, c) for i, c in enumerate(checks) if c.state]
        parts = []
        if plain:
            found = [c.verdict(lambda s, i=i: F.col(f"s{i}_{s}")).alias(cols[i]) for i, c in plain]
            parts.append(_report_rows(plain, total.select(*found), cols))
        keyed = [(i, c) for i, c in enumerate(checks) if c.keyed]
        if keyed:
            parts.append(_report_rows(keyed, self._failing_values(keyed, known, values, cols), cols))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _failing_values(self, keyed: list[tuple[int, Check]], known: DataFrame, path: str, cols: dict[int, str]) -> DataFrame:
        """One row with the number of failing values of each check."""
        rows = self.spark.read.schema(_VALUES).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], _VALUES)
        live = rows.join(known.select("run", part_name(F.col("part")).alias("part")), ["run", "part"], "left_semi")
        fails = F.lit(False)
        for i, c in keyed:
            fails = F.when(F.col("at") == i, c.keyed[1](F.col("n"))).otherwise(fails)
        counts = live.groupBy("at", "value").agg(F.sum("n").alias("n")).where(fails).groupBy("at").agg(F.count(F.lit(1)).alias("n"))
        return counts.agg(*[F.sum(F.when(F.col("at") == i, F.col("n"))).alias(cols[i]) for i, _ in keyed])


def _merged(name: str, how: str) -> Column:
    return (F.coalesce(F.sum(name), F.lit(0)) if how == "sum" else _MERGE[how](name)).alias(name)
