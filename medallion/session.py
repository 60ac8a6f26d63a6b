"""Session helpers.

``get_session`` is for local runs and tests only; on a cluster the caller's
session is used as is.  ``scratch_dir`` gives the shared folder for written
intermediate tables: the session's ``spark.checkpoint.dir`` when the cluster
sets one, otherwise a fresh local folder (tests / local runs only).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Settings for a large cluster run (e.g. ~100 TB over ~1000 executors).  AQE
# sizes shuffle partitions from measured map output (start high, coalesce to
# the advisory size), splits skewed join partitions, and converts joins to
# broadcast only under the runtime size threshold.  Scan splits of 256 MB keep
# a task's input well inside executor memory; the shuffle starts with enough
# partitions that none exceeds the advisory size before coalescing.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Set the runtime SQL settings above (``overrides`` win) on a session."""
    conf = dict(CLUSTER_CONF)
    conf.update(overrides or {})
    for k, v in conf.items():
        spark.conf.set(k, v)


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "medallion", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session with AQE on and the UI off."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.appName(app_name).master(master or f"local[{cpus}]")
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("MEDALLION_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only when unset."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return spark.sparkContext.getCheckpointDir() or conf
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="medallion-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


_RUN = "medallion.scratch.run"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder, inside the folder of the
    run if one is open (see ``scratch_run``)."""
    base = ensure_checkpoint_dir(spark)
    run = spark.conf.get(_RUN, "")
    return f"{base.rstrip('/')}/medallion/{run + '/' if run else ''}{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_run(spark: SparkSession):
    """Intermediate tables written inside the block are deleted at its end, also if it
    fails.  DataFrames are lazy and may read those tables, so write the results (or take
    their rows) inside the block.  Blocks may be nested; tables of one session's threads
    share the block."""
    base, old = ensure_checkpoint_dir(spark), spark.conf.get(_RUN, "")
    run = f"{old + '/' if old else ''}run-{uuid.uuid4().hex[:12]}"
    folder = f"{base.rstrip('/')}/medallion/{run}"
    spark.conf.set(_RUN, run)
    try:
        yield folder
    finally:
        if old:
            spark.conf.set(_RUN, old)
        else:
            spark.conf.unset(_RUN)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df, eager: bool = True):
    """``df.checkpoint()`` into the session's shared checkpoint folder (set to
    a local folder only when the session has none, as in tests)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def ntz_literal(value):
    """A ``timestamp_ntz`` literal for a naive datetime (or ISO text), built
    from its wall-clock text so no time zone is involved."""
    import datetime as _dt
    from pyspark.sql import functions as F
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.to_timestamp_ntz(F.lit(str(value)))
