"""Aggregates kept per partition directory of a growing Parquet table.

What a report needs of each directory is stored with a fingerprint of the directory's
files (number, bytes, names and times, from the file listing).  A refresh scans only
directories that are new or whose files changed; directories that are gone, and the states
of replaced files, no longer count.  Unchanged directories are not opened.

A run writes its states last, in one write: a run that died before leaves nothing that
counts, and of runs that met on a directory one counts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.session import checkpointed
from medallion.sources.tables import path_exists

PART = "_part"


def _short(path: Column) -> Column:
    """A path without the slashes that only some spellings of it have."""
    return F.regexp_replace(path, "^(\\w+):/+", "$1:/")


def part_name(listed: Column) -> Column:
    """The ``_part`` of rows from a directory as the file listing spells it."""
    return F.url_decode(_short(listed))


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


class PartitionStates:
    """States of the table at ``path``, kept under ``root``.  ``aggregates(df)`` names the
    aggregate of each state column; ``scanned`` holds the number of directories and rows
    that the last refresh read."""

    def __init__(self, spark: SparkSession, path: str, root: str, aggregates: Callable[[DataFrame], dict[str, Column]],
                 schema: T.StructType | None = None):
        self.spark, self.path, self.root = spark, path.rstrip("/"), root.rstrip("/")
        self.aggregates, self._schema = aggregates, schema
        self.scanned = {"partitions": 0, "rows": 0}

    def schema(self) -> T.StructType:
        return self._schema or self.spark.read.parquet(self.path).schema

    def partitions(self) -> DataFrame:
        """(part, print): every directory that holds data files, and its fingerprint."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                 .load(self.path).select("path", "length", "modificationTime"))
        one = F.xxhash64("path", "length", "modificationTime")
        return (files.groupBy(_folder(F.col("path")).alias("part"))
                .agg(F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.bit_xor(one), F.bit_xor(F.xxhash64(one, F.lit(1)))).alias("print")))

    def read(self, parts: list[str], schema: T.StructType) -> DataFrame:
        """Rows of some directories with their directory in ``_part``."""
        rows = (self.spark.read.schema(schema).option("basePath", self.path).parquet(*parts) if parts
                else self.spark.createDataFrame([], schema).withColumn("_metadata", F.struct(F.lit("").alias("file_path"))))
        return rows.select(*[F.col(f"`{f.name}`") for f in schema], _short(_folder(F.url_decode(F.col("_metadata.file_path")))).alias(PART))

    def refresh(self, before: Callable[[DataFrame, str], None] | None = None) -> DataFrame:
        """(run, part, print, rows, states…) of the directories that are there now, after
        scanning the new ones.  ``before(rows, run)`` may keep more of the new rows; it is
        called before their states are written."""
        schema = self.schema()
        empty = self.read([], schema)
        aggs = self.aggregates(empty)
        kinds = empty.agg(F.lit(0).alias("_x"), *[a.alias(n) for n, a in aggs.items()]).schema
        kept = T.StructType([T.StructField(n, T.StringType()) for n in ("run", "part", "print")] + [T.StructField("rows", T.LongType())]
                            + [T.StructField(n, kinds[n].dataType) for n in aggs])

        def stored() -> DataFrame:
            return (self.spark.read.schema(kept).parquet(f"{self.root}/states") if path_exists(self.spark, f"{self.root}/states")
                    else self.spark.createDataFrame([], kept))

        now = checkpointed(self.partitions())
        fresh = [r["part"] for r in now.join(stored().select("part", "print"), ["part", "print"], "left_anti").select("part").collect()]
        self.scanned = {"partitions": len(fresh), "rows": 0}
        if fresh:
            run = uuid.uuid4().hex
            rows = self.read(fresh, schema)
            if before is not None:
                before(rows, run)
            got = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("rows"), *[a.alias(n) for n, a in self.aggregates(rows).items()])
            # a directory whose files hold no row has a state too
            listed = now.where(F.col("part").isin(fresh)).withColumn("_short", part_name(F.col("part")))
            out = listed.join(got, F.col("_short") == F.col(PART), "left").select(
                F.lit(run).alias("run"), "part", "print", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), *[F.col(n) for n in aggs])
            out.write.mode("append").parquet(f"{self.root}/states")
            self.scanned["rows"] = stored().where(F.col("run") == run).agg(F.sum("rows")).first()[0] or 0
        known = stored().join(now, ["part", "print"])
        one = known.groupBy(F.col("part").alias("_p")).agg(F.min("run").alias("_r"))
        return checkpointed(known.join(one, (F.col("part") == F.col("_p")) & (F.col("run") == F.col("_r"))).drop("_p", "_r"))
