"""Distinct counts from stored sketches.

Each partition directory keeps an HLL sketch of every counted column; a count over any set
of directories is the union of their sketches, so a new or reloaded directory costs a scan
of that directory and the rest is read from kilobytes of state.  A sketch of ``lg_k`` bits
estimates with a relative standard error of 1.04 / sqrt(2^lg_k); ``error_bound`` is four of
these, and small sets are counted exactly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources.partition_states import PartitionStates

LG_K = 14


def error_bound(lg_k: int = LG_K) -> float:
    return 4 * 1.04 / 2 ** (lg_k / 2)


def _sketched(c: Column, kind: T.DataType) -> Column:
    """A column of a kind that sketches take: whole numbers, text or bytes."""
    if isinstance(kind, (T.IntegralType, T.StringType, T.BinaryType)):
        return c.cast("long") if isinstance(kind, T.IntegralType) else c
    return c.cast("string")


class StoredDistinct:
    """Distinct counts of ``columns`` of the Parquet table at ``path``, from sketches kept
    under ``root``; ``by`` are partition columns that counts may be asked for."""

    def __init__(self, spark: SparkSession, path: str, root: str, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K,
                 schema: T.StructType | None = None):
        self.columns, self.by, self.lg_k = list(columns), list(by), lg_k

        def aggregates(df: DataFrame) -> dict[str, Column]:
            keys = {f"k{i}": F.first(c) for i, c in enumerate(self.by)}
            return keys | {f"h{i}": F.hll_sketch_agg(_sketched(F.col(c), df.schema[c].dataType), lg_k) for i, c in enumerate(self.columns)}

        self.states = PartitionStates(spark, path, f"{root.rstrip('/')}/hll-{lg_k}-{'-'.join([*self.columns, *self.by])}", aggregates, schema)

    @property
    def scanned(self) -> dict[str, int]:
        return self.states.scanned

    def estimates(self, by: Sequence[str] = ()) -> DataFrame:
        """``by`` (some of the partition columns), ``n_rows`` and one estimate per column,
        named after it; a column without a value counts 0."""
        unknown = set(by) - set(self.by)
        if unknown:
            raise ValueError(f"no states by {sorted(unknown)}")
        known = self.states.refresh().where(F.col("rows") > 0)
        keys = [F.col(f"k{self.by.index(c)}").alias(c) for c in by]
        out = known.groupBy(*keys).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
                                       *[F.hll_union_agg(f"h{i}").alias(f"h{i}") for i in range(len(self.columns))])
        return out.select(*by, "n_rows", *[F.coalesce(F.hll_sketch_estimate(f"h{i}"), F.lit(0)).cast("long").alias(c)
                                           for i, c in enumerate(self.columns)])
