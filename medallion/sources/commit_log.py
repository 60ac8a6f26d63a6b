"""Read a JSON-lines transaction log into a history table (H3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = """commitInfo struct<version: bigint, timestamp: bigint, operation: string,
                                 operationParameters: map<string, string>>,
                metaData struct<schemaString: string, partitionColumns: array<string>>,
                txn struct<appId: string, version: bigint>,
                add struct<path: string>"""


def version_from_path(path_col) -> F.Column:
    """Version number from the commit's file path: ``…/v=<N>/…`` or
    ``…/<N>.json`` (the number in the name, not a field that may be absent)."""
    by_dir = F.regexp_extract(path_col, r"/v=(\d+)/", 1)
    by_name = F.regexp_extract(path_col, r"/(\d+)\.json$", 1)
    return F.when(by_dir != "", by_dir).otherwise(by_name).cast("long")


def history_from_log(spark: SparkSession, log_dir: str) -> DataFrame:
    """version, timestamp, operation, operationParameters (and the raw
    ``timestamp_ms``) — one row per commit."""
    raw = (spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").json(log_dir)
           .withColumn("version", version_from_path(F.col("_metadata.file_path"))))
    return (raw.where(F.col("commitInfo").isNotNull())
            .select("version",
                    F.timestamp_millis(F.col("commitInfo.timestamp")).cast("timestamp_ntz").alias("timestamp"),
                    F.col("commitInfo.operation").alias("operation"),
                    F.col("commitInfo.operationParameters").alias("operationParameters"),
                    F.col("commitInfo.timestamp").alias("timestamp_ms")))
