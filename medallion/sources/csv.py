"""Typed CSV ingest.

One scan reads every yearly file (a glob or a list), not one job per file.
Rejected rows are kept apart instead of being silently turned into NULLs."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_typed_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                   mode: str = "PERMISSIVE", with_corrupt: bool = False, **options) -> DataFrame:
    """Header CSV with an explicit schema (no inference).

    ``with_corrupt=True`` adds a ``_corrupt_record`` column holding the raw
    line of rows that did not parse (PERMISSIVE mode)."""
    if isinstance(paths, str):
        paths = [paths]
    sch = schema
    if with_corrupt:
        sch = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    r = (spark.read.option("header", True).option("mode", mode).option("inferSchema", False)
         .option("enforceSchema", False))
    if with_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    for k, v in options.items():
        r = r.option(k, v)
    return r.schema(sch).csv(list(paths))


def enforce_schema(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                   mode: str = "quarantine", required: Sequence[str] | None = None,
                   **options) -> tuple[DataFrame, DataFrame | None]:
    """Read CSV and split good rows from rejected ones.

    Every field is read as text and converted with ``try_cast``; a field whose
    text is present but does not convert is bad, and so is a NULL in a required
    (non-nullable) field, and so is a line with a field too few or too many.  Every
    line is parsed whole whatever columns a later query selects.

    ``mode="quarantine"`` returns ``(good, rejected)``; rejected rows carry the
    source file, a reason ('malformed' / 'unparsable' / 'null_required'), the names
    of the bad fields, the raw text of every field and a malformed line itself.  ``mode="failfast"`` returns
    ``(df, None)`` where reading a bad row raises."""
    if mode not in ("quarantine", "failfast"):
        raise ValueError("mode must be 'quarantine' or 'failfast'")
    req = list(required) if required is not None else [f.name for f in schema.fields if not f.nullable]
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = read_typed_csv(spark, paths, text, with_corrupt=True, columnPruning=False, **options)
    typed = [F.col(f.name).try_cast(f.dataType) if not isinstance(f.dataType, T.StringType)
             else F.col(f.name) for f in schema.fields]
    tagged = raw.select(*[F.col(f.name).alias(f"_raw_{f.name}") for f in schema.fields],
                        *[t.alias(f.name) for f, t in zip(schema.fields, typed)],
                        F.col("_metadata.file_name").alias("_source_file"), F.col(CORRUPT).alias("_raw_line"))
    bad_fields_t = F.array_compact(F.array(*[
        F.when(F.col(f"_raw_{f.name}").isNotNull() & F.col(f.name).isNull(), F.lit(f.name))
        for f in schema.fields]))
    null_req_t = F.lit(False)
    for c in req:
        null_req_t = null_req_t | F.col(f"_raw_{c}").isNull()
    reason_t = (F.when(F.col("_raw_line").isNotNull(), F.lit("malformed")).when(F.size(bad_fields_t) > 0, F.lit("unparsable"))
                .when(null_req_t, F.lit("null_required")))
    tagged = tagged.withColumn("_reject_reason", reason_t).withColumn("_bad_fields", bad_fields_t)
    if mode == "failfast":
        ok = F.coalesce(F.when(F.col("_reject_reason").isNotNull(),
                               F.raise_error(F.concat(F.lit("bad CSV row in "), F.col("_source_file"), F.lit(": "),
                                                      F.col("_reject_reason")))).cast("boolean"), F.lit(True))
        return tagged.where(ok).select(*[f.name for f in schema.fields]), None
    good = tagged.where(F.col("_reject_reason").isNull()).select(*[f.name for f in schema.fields])
    rejected = tagged.where(F.col("_reject_reason").isNotNull()).select(
        "_source_file", "_reject_reason", "_bad_fields", *[f.name for f in schema.fields],
        *[f"_raw_{f.name}" for f in schema.fields], "_raw_line")
    return good, rejected


def discover_partitions(spark: SparkSession, directory: str, pattern: str = r"(\d{4})") -> DataFrame:
    """Values found in the file paths under ``directory`` (S3), ascending —
    e.g. the years of ``extract_2021.csv`` or of ``ano=2021/part-….csv``.  Spark
    lists the files; their contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
             .select(F.substring_index(F.col("path"), directory.rstrip("/").split("/")[-1] + "/", -1)
                     .alias("rel")))
    return (files.select(F.regexp_extract("rel", pattern, 1).alias("value"))
            .where(F.col("value") != "").distinct().orderBy("value"))


def with_audit(df: DataFrame, loaded_at: str = "_bronze_loaded_at", source_file: str = "_source_file",
               at: Column | None = None) -> DataFrame:
    """Add the load time and the source file name of each row (S4).  Only for
    file-backed DataFrames (uses the hidden ``_metadata`` column)."""
    return (df.withColumn(loaded_at, at if at is not None else F.current_timestamp())
              .withColumn(source_file, F.col("_metadata.file_name")))


def year_paths(directory: str, years: Sequence[int], template: str = "extract_{year}.csv") -> list[str]:
    """Paths of the yearly files to read in one scan."""
    return [f"{directory.rstrip('/')}/{template.format(year=y)}" for y in years]


def existing_year_paths(spark: SparkSession, directory: str, years: Sequence[int],
                        template: str = "extract_{year}.csv") -> list[str]:
    """``year_paths`` without the years whose file is absent; each absent year
    is reported with a warning and skipped (S1)."""
    from medallion.sources.tables import path_exists
    out = []
    for y, p in zip(years, year_paths(directory, years, template)):
        if path_exists(spark, p):
            out.append(p)
        else:
            warnings.warn(f"no file for year {y} ({p}); skipped", stacklevel=2)
    return out


def year_from_name(col: Column, pattern: str = r"(\d{4})") -> Column:
    return F.regexp_extract(col, pattern, 1).cast("int")


__all__ = ["read_typed_csv", "enforce_schema", "discover_partitions", "with_audit", "year_paths",
           "existing_year_paths", "year_from_name", "CORRUPT"]
