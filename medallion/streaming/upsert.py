"""Merge a stream of changes into a snapshot table, each micro-batch once (ST1 → J1).

Every micro-batch is one keyed upsert.  Its number is part of the commit that makes the
new version visible, so data and progress become visible together: a batch that died
before its commit left nothing, and is merged when the stream replays it; a batch that
died after its commit is found in the log and skipped.  Progress is kept under the
stream's own id, which lives in its checkpoint: a new checkpoint starts from the first
batch again.

Of several changes to one key in a batch the latest by ``sequence_by`` counts, and a change
older than the row it meets is dropped, so the result does not depend on how files are
dealt over batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.operators.shape import deduplicate
from medallion.sources.snapshots import SnapshotTable
from medallion.sources.tables import rebalanced

_QUERY_ID = "sql.streaming.queryId"


def latest_changes(batch: DataFrame, keys: Sequence[str], sequence_by: str | None) -> DataFrame:
    """One row per key: the greatest ``sequence_by`` (NULLs last), of equal ones the same
    row whatever the order of arrival.  Rows with a NULL in a key are all kept.

    A file may be one task, so its rows are dealt out before they are sorted: adaptive
    execution makes the shares about one size, and of a hot key each sends one row on."""
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    order = [F.col(sequence_by).desc_nulls_last()] if sequence_by else []
    row = F.xxhash64(*[F.col(c) for c in batch.columns])
    dealt = rebalanced(batch.where(keyed).withColumn("_upsert_row", row), ["_upsert_row"])
    latest = deduplicate(dealt, keys, [*order, F.col("_upsert_row")]).drop("_upsert_row")
    return latest.unionByName(batch.where(~keyed))


def merge_batch(table: SnapshotTable, batch: DataFrame, batch_id: int, app_id: str, keys: Sequence[str],
                sequence_by: str | None = None, by_partition: bool = False) -> bool:
    """Upsert one micro-batch unless the table already holds it; whether it was merged."""
    done = table.last_txn(app_id)
    if done is not None and batch_id <= done:
        return False
    table.upsert(latest_changes(batch, keys, sequence_by), keys, by_partition=by_partition, sequence_by=sequence_by,
                 txn=(app_id, batch_id))
    return True


def upsert_stream(stream: DataFrame, table: SnapshotTable, keys: Sequence[str], checkpoint: str, sequence_by: str | None = None,
                  by_partition: bool = False, transform: Callable[[DataFrame], DataFrame] | None = None,
                  app_id: str | None = None) -> dict[str, list[int]]:
    """Merge what ``stream`` holds now and stop.  Returns the micro-batches ``merged`` and
    those ``skipped`` because an earlier run had committed them."""
    out: dict[str, list[int]] = {"merged": [], "skipped": []}

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform is not None else batch
        name = app_id or batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID) or checkpoint
        merged = merge_batch(table, rows, batch_id, name, keys, sequence_by, by_partition)
        out["merged" if merged else "skipped"].append(batch_id)

    q = (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out
