"""Snapshot, upsert, history, partitioned-write, CSV and streaming queries
(S1–S11, J1, H1–H11, A18, ST1, K1).  Each query writes its own tables under a
fresh folder of the session's shared checkpoint folder, then returns what it
reads back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.bindings.common import table
from medallion.session import scratch_dir
from medallion.sources.csv import enforce_schema, read_typed_csv
from medallion.sources.snapshots import SnapshotTable
from medallion.sources.tables import overwrite_partitions, read_partition_pruned, write_partitioned
from medallion.streaming.incremental import bronze_incremental

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])


def _orders(s, d):
    return table(s, d, "orders").withColumn("o_year", F.year("o_orderdate"))


def _versions(s, d, by_partition=False):
    """v0 = orders up to 1998; v1 = upsert of orders from 1998 on with a new price."""
    t = SnapshotTable(s, scratch_dir(s, "orders_snap"), ["o_year"])
    o = _orders(s, d)
    t.commit(o.where(F.col("o_year") <= 1998), "WRITE", {"mode": "Overwrite"})
    src = o.where(F.col("o_year") >= 1998).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    t.upsert(src, ["o_orderkey"], by_partition=by_partition)
    return t


def q_upsert(s, d):
    return _versions(s, d).read()


def q_upsert_partitions(s, d):
    return _versions(s, d, by_partition=True).read()


def q_as_of_version(s, d):
    return _versions(s, d).read(0)


def q_as_of_time(s, d):
    t = _versions(s, d)
    ts0 = t.history().where(F.col("version") == 0).select("timestamp_ms").first()[0]
    return t.read(t.version_as_of(ts0))


def q_restore(s, d):
    t = _versions(s, d)
    t.restore(0)
    return t.read()


def q_history(s, d):
    t = _versions(s, d, by_partition=True)
    t.restore(0)
    return t.history().select("version", "operation",
                              F.to_json("operationParameters").alias("parameters"))


def q_data_diff(s, d):
    return _versions(s, d).data_diff(0, 1, ["o_orderkey"])


def _evolved(s, d):
    t = SnapshotTable(s, scratch_dir(s, "evolve"), ["o_year"])
    t.commit(_orders(s, d), "WRITE")
    t.add_column(lambda df: df.withColumn("price_band", F.width_bucket("o_totalprice", F.lit(0.0),
                                                                       F.lit(500000.0), F.lit(10)))
                 .drop("o_orderpriority"))
    return t


def q_schema_diff(s, d):
    return _evolved(s, d).schema_diff(0, 1)


def q_schema_evolution(s, d):
    return _evolved(s, d).read()


def q_schema_by_version(s, d):
    return _evolved(s, d).schema_by_version()


def q_compare_summaries(s, d):
    return _versions(s, d).compare_summaries([0, 1], "o_totalprice")


def q_overwrite_year(s, d):
    path = scratch_dir(s, "overwrite_year")
    o = _orders(s, d)
    write_partitioned(o, path, ["o_year"])
    redo = o.where(F.col("o_year") == 1999).withColumn("o_orderpriority", F.lit("0-RELOADED"))
    overwrite_partitions(redo, path, ["o_year"], expected={"o_year": 1999})
    overwrite_partitions(redo, path, ["o_year"], expected={"o_year": 1999})  # idempotent
    return s.read.parquet(path)


def q_partition_pruned(s, d):
    path = scratch_dir(s, "pruned")
    write_partitioned(_orders(s, d), path, ["o_year"])
    return read_partition_pruned(s, path, o_year=1997)


def _csv_dir(s, d, bad_prices=False):
    path = scratch_dir(s, "orders_csv")
    o = table(s, d, "orders")
    if bad_prices:
        o = o.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
                         .otherwise(F.col("o_totalprice").cast("string")))
    (o.withColumn("y", F.year("o_orderdate")).write.partitionBy("y").option("header", True).csv(path))
    return path


def q_csv_roundtrip(s, d):
    return read_typed_csv(s, _csv_dir(s, d) + "/y=*/*.csv", ORDERS_SCHEMA)


def q_csv_quarantine_good(s, d):
    good, _ = enforce_schema(s, _csv_dir(s, d, bad_prices=True) + "/y=*/*.csv", ORDERS_SCHEMA)
    return good


def q_csv_quarantine_rejected(s, d):
    _, rejected = enforce_schema(s, _csv_dir(s, d, bad_prices=True) + "/y=*/*.csv", ORDERS_SCHEMA)
    return rejected.select("o_orderkey", "_reject_reason")


def q_stream_ingest(s, d):
    src = _csv_dir(s, d)
    target, ckpt = scratch_dir(s, "stream_target"), scratch_dir(s, "stream_ckpt")
    schema = T.StructType(ORDERS_SCHEMA.fields + [T.StructField("y", T.IntegerType())])
    for _ in range(2):  # the second run finds no new file and writes nothing
        bronze_incremental(s, src, schema, target, ["y"], ckpt, file_glob="*.csv")
    return s.read.parquet(target).select(*ORDER_COLS)


def q_stream_split_files(s, d):
    """Rows of one year in several files, one file a batch, over two runs."""
    src, target, ckpt = (scratch_dir(s, n) for n in ("split_src", "split_target", "split_ckpt"))
    o = table(s, d, "orders").withColumn("y", F.year("o_orderdate"))
    schema = T.StructType(ORDERS_SCHEMA.fields + [T.StructField("y", T.IntegerType())])
    for half in (0, 1):
        part = o.where(F.pmod("o_orderkey", F.lit(2)) == half)
        part.repartition(3, "o_orderkey").write.mode("append").option("header", True).csv(src)
        bronze_incremental(s, src, schema, target, ["y"], ckpt, max_files_per_trigger=1)
    return s.read.parquet(target).select(*ORDER_COLS)


def q_pipeline_rejects(s, d):
    """K1 with rows that do not parse: kept apart without being asked for, and
    replaced, not doubled, by a reload."""
    from medallion import jobs
    target = scratch_dir(s, "bronze_rejects")
    raw = _csv_dir(s, d, bad_prices=True)
    schema = T.StructType([*ORDERS_SCHEMA.fields, T.StructField("ano", T.IntegerType())])
    path = scratch_dir(s, "orders_ano")
    (s.read.option("header", True).csv(raw).select(*ORDER_COLS, F.col("y").alias("ano"))
     .write.option("header", True).csv(path))
    for _ in range(2):
        jobs.bronze(s, path, target, schema)
    return s.read.parquet(f"{target}_rejects").select("o_orderkey", "_reject_reason")


QUERIES = {
    "upsert_orders": q_upsert,
    "upsert_partitions": q_upsert_partitions,
    "as_of_version": q_as_of_version,
    "as_of_time": q_as_of_time,
    "restore": q_restore,
    "history": q_history,
    "data_diff": q_data_diff,
    "schema_diff": q_schema_diff,
    "schema_evolution": q_schema_evolution,
    "schema_by_version": q_schema_by_version,
    "compare_summaries": q_compare_summaries,
    "overwrite_year": q_overwrite_year,
    "partition_pruned": q_partition_pruned,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_quarantine_good": q_csv_quarantine_good,
    "csv_quarantine_rejected": q_csv_quarantine_rejected,
    "stream_ingest": q_stream_ingest,
    "stream_split_files": q_stream_split_files,
    "pipeline_rejects": q_pipeline_rejects,
}

_O = "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders"
_UPS = f"""SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_year >= 1998 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    o_orderdate, o_orderpriority, o_year FROM ({_O}) o"""
_V0 = f"SELECT * FROM ({_O}) o WHERE o_year <= 1998"

ORACLE = {
    "upsert_orders": _UPS,
    "upsert_partitions": _UPS,
    "as_of_version": _V0,
    "as_of_time": _V0,
    "restore": _V0,
    "history": """SELECT CAST(version AS BIGINT) AS version, operation, parameters FROM (VALUES
        (0, 'WRITE', '{"mode":"Overwrite"}'),
        (1, 'MERGE', '{"predicate":"target.o_orderkey = source.o_orderkey"}'),
        (2, 'RESTORE', '{"version":"0"}')) t(version, operation, parameters)""",
    "data_diff": f"""SELECT o_orderkey, CASE WHEN o_year > 1998 THEN 'added' ELSE 'changed' END AS change
        FROM ({_O}) o WHERE o_year >= 1998""",
    "schema_diff": """SELECT 0 AS version_a, 1 AS version_b, ['price_band'] AS added,
        ['o_orderpriority'] AS removed,
        ['o_custkey', 'o_orderdate', 'o_orderkey', 'o_orderstatus', 'o_totalprice', 'o_year'] AS common""",
    "schema_evolution": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_year,
        CASE WHEN o_totalprice < 0 THEN 0 WHEN o_totalprice >= 500000 THEN 11
             ELSE CAST(floor(10 * (o_totalprice - 0) / (500000.0 - 0)) AS BIGINT) + 1 END AS price_band
        FROM ({_O}) o""",
    "schema_by_version": """SELECT CAST(version AS BIGINT) AS version, * EXCLUDE (version) FROM (VALUES
        (0, true, true, true, true, true, true, true, false),
        (1, true, true, false, true, true, true, true, true))
        t(version, o_custkey, o_orderdate, o_orderpriority, o_orderkey, o_orderstatus, o_totalprice, o_year,
          price_band)""",
    "compare_summaries": f"""SELECT COUNT(*) AS n_rows,
        CAST(ROUND(CAST(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice)
             AS DECIMAL(28,10)), 2) AS DOUBLE) AS avg_o_totalprice, 0 AS version FROM ({_V0}) a
        UNION ALL SELECT COUNT(*), CAST(ROUND(CAST(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
             / COUNT(o_totalprice) AS DECIMAL(28,10)), 2) AS DOUBLE), 1 FROM ({_UPS}) b""",
    "overwrite_year": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        CASE WHEN o_year = 1999 THEN '0-RELOADED' ELSE o_orderpriority END AS o_orderpriority, o_year
        FROM ({_O}) o""",
    "partition_pruned": f"SELECT * FROM ({_O}) o WHERE o_year = 1997",
    "csv_roundtrip": "SELECT * FROM orders",
    "csv_quarantine_good": "SELECT * FROM orders WHERE o_orderstatus != 'P'",
    "csv_quarantine_rejected": """SELECT o_orderkey, 'unparsable' AS _reject_reason FROM orders
        WHERE o_orderstatus = 'P'""",
    "stream_ingest": "SELECT * FROM orders",
    "stream_split_files": "SELECT * FROM orders",
    "pipeline_rejects": """SELECT o_orderkey, 'unparsable' AS _reject_reason FROM orders
        WHERE o_orderstatus = 'P'""",
}


def _raw_years(s, d):
    """The scored binding written as raw CSV extracts, one folder per year."""
    from medallion.bindings.scored import scored
    path = scratch_dir(s, "raw_years")
    (scored(s, d).withColumn("year", F.col("ano")).write.partitionBy("year").option("header", True).csv(path))
    return path


def q_discover_years(s, d):
    from medallion.sources.csv import discover_partitions
    return discover_partitions(s, _raw_years(s, d), r"year=(\d{4})/").select(F.col("value").cast("int").alias("ano"))


def q_pipeline_bronze_silver(s, d):
    """K1 → K2: raw CSV → bronze (audit, dynamic overwrite) → silver upsert into
    a snapshot table → percentile added as a new version; run twice to show
    that a re-run gives the same rows."""
    from medallion import jobs
    from medallion.bindings.scored import SILVER_ARGS
    from medallion.bindings.tiers import SILVER_COLUMNS
    raw = _raw_years(s, d)
    bronze_path = scratch_dir(s, "bronze")
    snap = SnapshotTable(s, scratch_dir(s, "silver"), ["ano", "regiao"])
    for _ in range(2):
        jobs.bronze(s, raw + "/year=*/*.csv", bronze_path)
        jobs.silver(s, s.read.parquet(bronze_path), snap, **SILVER_ARGS)
    return snap.read().select(*SILVER_COLUMNS, "percentil_nacional")


QUERIES.update({
    "discover_years": q_discover_years,
    "pipeline_bronze_silver": q_pipeline_bronze_silver,
})

_SILVER_ORACLE_COLS = ", ".join([
    "nu_inscricao", "ano", "sg_uf_residencia", "regiao", "tp_sexo", "nu_idade", "tp_escola",
    "renda_familiar", "in_treineiro", "tp_presenca", "nu_nota_cn", "nu_nota_ch", "nu_nota_lc",
    "nu_nota_mt", "nu_nota_redacao", "dt_carga", "media_objetivas", "media_geral",
    "faixa_desempenho", "fl_escola_publica", "grupo_renda", "percentil_nacional"])


def _pipeline_oracle():
    from medallion.bindings.scored import SILVER_SQL
    return f"WITH {SILVER_SQL} SELECT {_SILVER_ORACLE_COLS} FROM silver_pct"


ORACLE.update({
    "discover_years": "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders",
    "pipeline_bronze_silver": _pipeline_oracle(),
})
