"""Pick up new raw files once each (ST1).

A file stream with ``trigger(availableNow=True)`` processes every file not
seen before and stops; the checkpoint remembers which files were done, so a
re-run after new files arrive only reads those.  The sink accumulates: each
micro-batch owns the partition ``_batch_id=<n>`` of the target, so batches and
runs never replace each other's rows, however files are split over them, and a
batch retried after an executor loss overwrites only itself."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources.tables import overwrite_partitions


BATCH = "_batch_id"


def bronze_incremental(spark: SparkSession, source_dir: str, schema: T.StructType, target: str,
                       partition_by: Sequence[str], checkpoint: str,
                       transform: Callable[[DataFrame], DataFrame] | None = None,
                       file_glob: str = "*.csv", max_files_per_trigger: int | None = None) -> int:
    """Ingest new CSV files from ``source_dir`` into ``target``, partitioned by
    ``_batch_id`` and ``partition_by``.  Returns the number of micro-batches run."""
    reader = (spark.readStream.format("csv").option("header", True).schema(schema)
              .option("pathGlobFilter", file_glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir).withColumn("_source_file", F.col("_metadata.file_name"))
    if transform is not None:
        stream = transform(stream)
    batches = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        overwrite_partitions(batch.withColumn(BATCH, F.lit(batch_id)).withColumn("_bronze_loaded_at", F.current_timestamp()), target,
                             [BATCH, *partition_by])
        batches.append(batch_id)

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)
