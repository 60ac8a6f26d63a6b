"""Snapshot tables: versioned Parquet with a JSON-lines commit log.

Layout under ``root``::

    data/_snapshot_version=<N>-<id>/<partition dirs>/part-*.parquet   rows written for version N
    commit_log/v=<N>/part-*.json                 the commit of version N

A commit file holds JSON lines in the common transaction-log shape:
``{"commitInfo": {version, timestamp, operation, operationParameters}}``,
``{"metaData": {"schemaString", "partitionColumns"}}`` and one
``{"add": {"path"}}`` per data directory of the version; a commit made for a
micro-batch of a stream also holds ``{"txn": {"appId", "version"}}``, so that a
replayed batch is known to be there.  A version may
reference directories written by older versions (partition-level upsert,
restore), so nothing is copied that did not change.  Data is written first,
the commit last, so a reader never sees half a version.  Every write has a
directory of its own, so a writer that loses the race for a version fails when
creating ``commit_log/v=<N>`` without touching committed rows; the log is listed
anew before each write.  A commit that died half way holds no ``commitInfo`` and
is replaced by the next one.
"""

from __future__ import annotations

import json
import time
import uuid
from zoneinfo import ZoneInfo
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.silver import ensure_columns
from medallion.plans.ranged import _null_safe_join

# directory key of a version's data; partition discovery turns it into a
# column, so it must not clash with user column names
VERSION_DIR = "_snapshot_version"
from medallion.sources.commit_log import LOG_SCHEMA, history_from_log, version_from_path
from medallion.session import checkpointed
from medallion.sources.tables import path_exists, rebalanced


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by)
        self._commit_cache: dict[int, dict] = {}

    # ---- log -------------------------------------------------------------
    def _log_dir(self) -> str:
        return f"{self.root}/commit_log"

    def exists(self) -> bool:
        return path_exists(self.spark, self._log_dir())

    def history(self) -> DataFrame:
        """version, timestamp, operation, operationParameters, ordered (H2)."""
        return history_from_log(self.spark, self._log_dir()).orderBy("version")

    def _log(self) -> DataFrame:
        """The lines of all commits with their version."""
        return (self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").json(self._log_dir())
                .withColumn("version", version_from_path(F.col("_metadata.file_path"))))

    def _commit_path(self, version: int) -> str:
        return f"{self._log_dir()}/v={version:020d}"

    def _adds(self, version: int) -> DataFrame:
        """The data paths (``rel``) that the commit of ``version`` names."""
        self._commit(version)
        return (self.spark.read.schema(LOG_SCHEMA).json(self._commit_path(version))
                .where(F.col("add").isNotNull()).select(F.col("add.path").alias("rel")))

    def _commit(self, version: int, missing_ok: bool = False) -> dict | None:
        """Paths and schema of one version, read from its own commit; the two last
        read are kept (a committed version never changes)."""
        if version not in self._commit_cache:
            path = self._commit_path(version)
            lines = [] if version < 0 or not path_exists(self.spark, path) else (
                self.spark.read.schema(LOG_SCHEMA).json(path)
                .select(F.col("commitInfo.operation").alias("op"), F.col("add.path").alias("path"),
                        F.col("metaData.schemaString").alias("schema")).collect())
            if not any(r["op"] is not None for r in lines):
                if missing_ok:
                    return None
                raise ValueError(f"version {version} does not exist")
            while len(self._commit_cache) > 1:
                self._commit_cache.pop(next(iter(self._commit_cache)))
            self._commit_cache[version] = {"paths": sorted({r["path"] for r in lines if r["path"] is not None}),
                                           "schema": next(r["schema"] for r in lines if r["schema"] is not None)}
        return self._commit_cache[version]

    def latest_version(self) -> int | None:
        """The greatest committed version: one aggregate over the log."""
        if not self.exists():
            return None
        return self._log().where(F.col("commitInfo").isNotNull()).agg(F.max("version")).first()[0]

    def last_txn(self, app_id: str) -> int | None:
        """The last micro-batch that ``app_id`` has committed."""
        if not self.exists():
            return None
        return self._log().where(F.col("txn.appId") == F.lit(app_id)).agg(F.max("txn.version")).first()[0]

    def _paths(self, version: int) -> list[str]:
        return self._commit(version)["paths"]

    def _schema(self, version: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._commit(version)["schema"]))

    def _write_commit(self, version: int, operation: str, params: dict, schema: T.StructType,
                      paths: Sequence[str], more: DataFrame | None = None, txn: tuple[str, int] | None = None) -> None:
        """Write the commit of a version as one file.  ``more`` holds further data
        paths (``rel``), which go from Spark to the file without passing the driver."""
        info = {"commitInfo": {"version": version, "timestamp": int(time.time() * 1000),
                               "operation": operation,
                               "operationParameters": {k: str(v) for k, v in (params or {}).items()}}}
        meta = {"metaData": {"schemaString": schema.json(), "partitionColumns": self.partition_by}}
        lines = [json.dumps(info), json.dumps(meta)] + [json.dumps({"add": {"path": p}}) for p in paths]
        if txn is not None:
            lines.append(json.dumps({"txn": {"appId": txn[0], "version": txn[1]}}))
        out = self.spark.createDataFrame([(ln,) for ln in lines], "value string")
        if more is not None:
            out = out.union(more.select(F.to_json(F.struct(F.struct(F.col("rel").alias("path")).alias("add")))))
        path = self._commit_path(version)
        dead = path_exists(self.spark, path) and self._commit(version, missing_ok=True) is None
        out.coalesce(1).write.mode("overwrite" if dead else "errorifexists").text(path)

    # ---- read ------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version (default: latest) (H4)."""
        v = self.latest_version() if version is None else version
        if v is None:
            raise ValueError(f"no table at {self.root}")
        schema = self._schema(v)
        return self._read_paths(schema, self._paths(v))

    def _read_paths(self, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        # Every data path sits under data/, so partition discovery sees the same
        # columns for all of them.  The logged schema is given to the reader:
        # no file footers are read to infer or merge schemas, and files
        # written before a column was added read it as NULL.
        read_schema = T.StructType(list(schema.fields) + [T.StructField(VERSION_DIR, T.StringType())])
        df = (self.spark.read.schema(read_schema).option("basePath", f"{self.root}/data")
              .parquet(*[f"{self.root}/{p}" for p in paths]))
        return df.select(*[F.col(f.name) for f in schema.fields])

    def version_as_of(self, ts) -> int:
        """Latest version committed at or before ``ts`` (datetime or ms); a naive
        datetime is in the session's time zone."""
        if not isinstance(ts, (int, float)) and ts.tzinfo is None:
            ts = ts.replace(tzinfo=ZoneInfo(self.spark.conf.get("spark.sql.session.timeZone")))
        ms = ts if isinstance(ts, (int, float)) else int(ts.timestamp() * 1000)
        row = (self.history().where(F.col("timestamp_ms") <= F.lit(ms)).agg(F.max("version")).first())
        if row is None or row[0] is None:
            raise ValueError("timestamp is before the first commit")
        return row[0]

    def read_as_of(self, ts) -> DataFrame:
        """Rows as of a point in time (H5)."""
        return self.read(self.version_as_of(ts))

    # ---- write -----------------------------------------------------------
    def _next_version(self) -> int:
        v = self.latest_version()
        return 0 if v is None else v + 1

    def _write_data(self, df: DataFrame, version: int) -> str:
        """Write a version's rows to a directory no other write uses.  Until a
        commit names it the directory is invisible."""
        rel = f"data/{VERSION_DIR}={version:020d}-{uuid.uuid4().hex[:12]}"
        if self.partition_by:
            rebalanced(df, self.partition_by).write.partitionBy(*self.partition_by).parquet(f"{self.root}/{rel}")
        else:
            df.write.parquet(f"{self.root}/{rel}")
        return rel

    def commit(self, df: DataFrame, operation: str = "WRITE", params: dict | None = None) -> int:
        """Write ``df`` as the next version (H1); returns the version."""
        v = self._next_version()
        rel = self._write_data(df, v)
        self._write_commit(v, operation, params or {"mode": "Overwrite"}, df.schema, [rel])
        return v

    def restore(self, version: int) -> int:
        """New version whose rows equal ``version``'s (H9); no data is copied."""
        v = self._next_version()
        self._write_commit(v, "RESTORE", {"version": version}, self._schema(version), [], more=self._adds(version))
        return v

    def add_column(self, fn: Callable[[DataFrame], DataFrame], operation: str = "WRITE",
                   params: dict | None = None) -> int:
        """Recompute the table with ``fn`` (e.g. a new column) as a new version
        (H10).  Reading and writing the same table is safe: the new rows go
        to a new version directory."""
        return self.commit(fn(self.read()), operation, params or {"mode": "Overwrite", "mergeSchema": "true"})

    def _partition_dirs(self, version: int) -> DataFrame:
        """(relative partition dir, partition values…) of every data file of a
        version — from the file listing only, no rows are read."""
        schema = self._schema(version)
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load([f"{self.root}/{p}" for p in self._paths(version)])
                 .select("path"))
        rel = F.concat(F.lit("data/"), F.regexp_extract(F.col("path"), rf"^.*/data/({VERSION_DIR}=[^/]+(?:/[^/]+)*)/[^/]*$", 1))
        vals = [_dir_value(c).try_cast(schema[c].dataType).alias(c) for c in self.partition_by]
        return files.select(rel.alias("rel"), *vals).distinct()

    def upsert(self, source: DataFrame, keys: Sequence[str], operation: str = "MERGE",
               by_partition: bool = False, sequence_by: str | None = None, txn: tuple[str, int] | None = None) -> int:
        """Keyed upsert as a new version (J1): target rows whose key is in the
        source are replaced, other target rows kept, new keys inserted.  NULL
        keys never match (they are inserted).  Duplicate source keys raise.

        ``by_partition=True`` rewrites only partitions touched by the change
        (the source's partitions and those of replaced rows); untouched
        partition directories are referenced, not copied.  With ``sequence_by`` a
        source row does not replace a target row whose value there is greater (a
        NULL is the least).  ``txn`` (application, number) is part of the commit,
        see ``last_txn``."""
        keys = list(keys)
        source = checkpointed(source)  # evaluated once: key check, partitions and rows read it
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | F.col(k).isNull()
        dup = (source.where(~any_null)
               .groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect())
        if dup:
            raise ValueError(f"duplicate source keys, e.g. {dup[0].asDict()}")
        v = self._next_version()
        if not v:
            rel = self._write_data(source, v)
            self._write_commit(v, operation, {"predicate": " AND ".join(keys)}, source.schema, [rel], txn=txn)
            return v
        target = self.read(v - 1)
        src = ensure_columns(source, target.schema)
        src = src.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields],
                         *[c for c in src.columns if c not in target.columns])
        if sequence_by is not None:
            held = target.select(*keys, F.col(sequence_by).alias("_snap_seq"))
            late = F.col("_snap_seq").isNotNull() & ~F.coalesce(F.col(sequence_by) >= F.col("_snap_seq"), F.lit(False))
            src = checkpointed(src.join(held, keys, "left").where(~late).select(*src.columns))
        kept = target.join(src.select(*keys), keys, "left_anti")
        merged = kept.unionByName(src, allowMissingColumns=True)
        params = {"predicate": " AND ".join(f"target.{k} = source.{k}" for k in keys)}
        if not by_partition or not self.partition_by:
            rel = self._write_data(merged, v)
            self._write_commit(v, operation, params, merged.schema, [rel], txn=txn)
            return v
        # partitions touched: those of the source rows and of the replaced rows;
        # keys that hold the partition columns replace rows of the same partition
        p = self.partition_by
        touched = src.select(*p)
        if not set(p) <= set(keys):
            touched = touched.unionByName(target.join(src.select(*keys), keys, "left_semi").select(*p))
        # of the table's partition directories (file listing only) the touched
        # ones are read and rewritten, the others are named by the new commit
        dirs = self._partition_dirs(v - 1).select("rel", *[F.col(c) for c in p])
        marked = checkpointed(_null_safe_join(dirs, touched.distinct().withColumn("_snap_hit", F.lit(True)), p, "left")
                              .select("rel", "_snap_hit"))
        changed = [r["rel"] for r in marked.where(F.col("_snap_hit")).collect()]
        kept_t = self._read_paths(target.schema, changed).join(src.select(*keys), keys, "left_anti")
        rel = self._write_data(kept_t.unionByName(src, allowMissingColumns=True), v)
        self._write_commit(v, operation, params, merged.schema, [rel], more=marked.where(F.col("_snap_hit").isNull()), txn=txn)
        return v

    # ---- inspect ---------------------------------------------------------
    def schema_by_version(self) -> DataFrame:
        """version × column presence matrix from the logged schemas (H6)."""
        fields = "struct<fields: array<struct<name: string>>>"
        m = (self._log().where(F.col("metaData").isNotNull())
             .select("version", F.explode(F.from_json("metaData.schemaString", fields)["fields"]).alias("f"))
             .select("version", F.col("f.name").alias("column")))
        return m.groupBy("version").pivot("column").agg(F.count(F.lit(1)) > 0).na.fill(False).orderBy("version")

    def schema_diff(self, a: int, b: int) -> DataFrame:
        """Columns added / removed / common from version a to b, sorted (H7)."""
        ca = F.array(*[F.lit(c) for c in self._schema(a).fieldNames()])
        cb = F.array(*[F.lit(c) for c in self._schema(b).fieldNames()])
        return self.spark.range(1).select(
            F.lit(a).alias("version_a"), F.lit(b).alias("version_b"),
            F.array_sort(F.array_except(cb, ca)).alias("added"),
            F.array_sort(F.array_except(ca, cb)).alias("removed"),
            F.array_sort(F.array_intersect(ca, cb)).alias("common"))

    def _changed_dirs(self, a: int, b: int) -> tuple[list[str], list[str]]:
        """Data directories of only the one or only the other version, by the file
        listing: a set difference in Spark, so shared ones do not reach the driver."""
        sides = (self._partition_dirs(a).select("rel", F.lit(1).alias("side"))
                 .union(self._partition_dirs(b).select("rel", F.lit(2).alias("side")))
                 .groupBy("rel").agg(F.bit_or("side").alias("sides")).where("sides <> 3").collect())
        return tuple(sorted(r["rel"] for r in sides if r["sides"] == s) for s in (1, 2))

    def data_diff(self, a: int, b: int, keys: Sequence[str]) -> DataFrame:
        """Rows added, removed or changed from version a to b, by key (H8).  Keys are
        unique in a version, so rows of a directory that both versions share cannot
        differ: only the directories of one of them are read and joined."""
        only_a, only_b = self._changed_dirs(a, b)
        return data_diff(self._read_paths(self._schema(a), only_a), self._read_paths(self._schema(b), only_b), keys)

    def compare_summaries(self, versions: Sequence[int], column: str) -> DataFrame:
        """Row count and rounded mean of ``column`` per version."""
        from medallion.operators.marts import column_summary
        parts = [column_summary(self.read(v), column).withColumn("version", F.lit(v)) for v in versions]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def file_stats(self, version: int | None = None) -> DataFrame:
        """Files and KB per partition of one version."""
        v = self.latest_version() if version is None else version
        stats = partition_file_stats(self.spark, [f"{self.root}/{p}" for p in self._paths(v)],
                                     self.partition_by)
        schema = self._schema(v)
        return stats.select(*[F.col(c).try_cast(schema[c].dataType) if c in schema.fieldNames() else F.col(c)
                              for c in self.partition_by], "n_files", "tamanho_kb")


_NULL_DIR = "__HIVE_DEFAULT_PARTITION__"


def _dir_value(c: str):
    """Value of partition column ``c`` from a file path (NULL partitions are
    written under a fixed directory name)."""
    raw = F.url_decode(F.regexp_extract(F.col("path"), f"/{c}=([^/]*)/", 1))
    return F.when(raw == F.lit(_NULL_DIR), F.lit(None)).otherwise(raw)


def partition_file_stats(spark: SparkSession, paths: str | Sequence[str], by: Sequence[str]) -> DataFrame:
    """Number of data files and total KB (rounded to 0.1) per partition under
    ``paths`` (A18).  Only file metadata is read (the ``binaryFile`` source
    without its content column), never the rows; partition values are taken
    from the ``col=value`` directory names."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(paths)
             .select("path", "length"))
    cols = [_dir_value(c).alias(c) for c in by]
    return (files.select(*cols, "length").groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n_files"),
                 F.round(F.sum("length") / F.lit(1024.0), 1).alias("tamanho_kb")))


def data_diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join on the keys; rows only in b are 'added', only in a
    'removed', in both with any differing common column 'changed'; NULL keys match."""
    keys = list(keys)
    common = [c for c in a.columns if c in b.columns and c not in keys]
    la = a.select(*keys, F.struct(*common).alias("_a"), F.lit(True).alias("_in_a"))
    lb = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.struct(*common).alias("_b"), F.lit(True).alias("_in_b"))
    same = F.lit(True)
    for k in keys:
        same = same & la[k].eqNullSafe(lb[f"_b_{k}"])
    j = la.join(lb, same, "full").select(*[F.coalesce(F.col(k), F.col(f"_b_{k}")).alias(k) for k in keys],
                                         "_a", "_b", "_in_a", "_in_b")
    change = (F.when(F.col("_in_a").isNull(), F.lit("added"))
              .when(F.col("_in_b").isNull(), F.lit("removed"))
              .when(~F.col("_a").eqNullSafe(F.col("_b")), F.lit("changed")))
    return j.select(*keys, change.alias("change")).where(F.col("change").isNotNull())
