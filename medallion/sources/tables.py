"""Partitioned table writes and reads."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str], expected: dict | None = None,
                         fmt: str = "parquet") -> None:
    """Idempotent reload of only the partitions present in ``df``.

    Dynamic partition overwrite: partitions not in ``df`` are left untouched.
    ``expected`` (e.g. ``{"ano": 2021}``) asserts that every row belongs to
    that partition, like a ``replaceWhere`` predicate; it is checked on the
    written rows themselves (``raise_error``), not in a separate scan, and a
    reload without rows empties the partition."""
    out = df
    if expected:
        out, obs = observed(df)
        ok = F.lit(True)
        for k, v in expected.items():
            ok = ok & (F.col(k) == F.lit(v))
        out = out.where(F.coalesce(F.when(~ok, F.raise_error(F.lit(
            f"row outside the replaced partition {expected}"))).cast("boolean"), F.lit(True)))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).format(fmt).save(path))
    if expected and not obs.get.get("rows"):
        drop_partitions(df.sparkSession, path, [expected])


def drop_partitions(spark: SparkSession, path: str, partitions: Sequence[dict]) -> int:
    """Delete the partition directories whose leading columns have the given
    values (compared as text); returns how many there were."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    wanted = [{k: str(v) for k, v in p.items()} for p in partitions]

    def walk(at, found: dict) -> int:
        n = 0
        for s in fs.listStatus(at):
            name, eq, value = s.getPath().getName().partition("=")
            if not s.isDirectory() or not eq:
                continue
            now = found | {name: unquote(value)}
            if now in wanted:
                n += bool(fs.delete(s.getPath(), True))
            elif any(now.items() <= w.items() for w in wanted):
                n += walk(s.getPath(), now)
        return n

    return walk(root, {}) if fs.exists(root) else 0


def rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows clustered by ``by`` for a partitioned write; adaptive execution merges
    small partitions and splits a hot one over several tasks."""
    return df.hint("rebalance", *[F.col(c) for c in by])


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite",
                      fmt: str = "parquet", sort_by: Sequence[str] = (), bloom: Sequence[str] = (),
                      row_group_bytes: int | None = None) -> None:
    """Create or fully overwrite a partitioned table (S6).  Rows are clustered
    by the partition columns first so each task writes few files.

    For point reads (see ``read_where``): ``sort_by`` orders the rows of each partition over
    its files, so a value's range of row groups is narrow; ``bloom`` columns get a Parquet
    bloom filter per row group, which tells where a value is not, whatever the order;
    ``row_group_bytes`` sets how much is skipped at a time."""
    out = rebalanced(df, by) if by else df
    if sort_by:
        if not by:  # ranges of the sort columns, so files do not overlap either
            out = df.repartitionByRange(*[F.col(c) for c in sort_by])
        out = out.sortWithinPartitions(*by, *sort_by)
    w = out.write.mode(mode).format(fmt).option("partitionOverwriteMode", "static")
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    if by:
        w = w.partitionBy(*by)
    w.save(path)


def read_table(spark: SparkSession, path: str, where=None, merge_schema: bool = False,
               fmt: str = "parquet") -> DataFrame:
    """Read a table; ``merge_schema`` for tables whose columns evolved."""
    df = spark.read.format(fmt).option("mergeSchema", str(merge_schema).lower()).load(path)
    return df if where is None else df.where(where)


def read_partition_pruned(spark: SparkSession, path: str, **values) -> DataFrame:
    """Read only the partitions with the given values (S10); the filter shows
    as ``PartitionFilters`` in the scan."""
    df = spark.read.parquet(path)
    for k, v in values.items():
        df = df.where(F.col(k) == F.lit(v))
    return df


def read_where(spark: SparkSession, path: str, schema=None, **values) -> DataFrame:
    """Rows whose columns equal the given values (S10).  Partition columns prune
    directories; for others the row groups' ranges and bloom filters are asked, so of a
    table written for it only row groups that may hold the value leave the scan."""
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    for k, v in values.items():
        df = df.where(F.col(k) == F.lit(v))
    return df


def export_parquet(df: DataFrame, path: str) -> None:
    """Plain Parquet copy of a table's current rows."""
    df.write.mode("overwrite").parquet(path)


def register_view(name: str, df: DataFrame) -> DataFrame:
    """Expose a DataFrame to SQL."""
    df.createOrReplaceTempView(name)
    return df


def observed(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of the next action on ``df`` (S11), so a
    write does not need a second scan for its row count."""
    obs = Observation(name)  # no name: one of its own, so several counts may meet in a plan
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system that serves it
    (local, HDFS, object stores) — no query is run."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))
