"""Queries on tables that grow: streaming upserts, diffs of changed directories,
incremental checks, stored sketches, point reads and tables of many databases (ST1, J1, H8,
C22, A7, A12, A18, S6, S7, S9, S10, D1).  Each writes its own tables under a fresh folder of
the session's shared checkpoint folder, then returns what it reads back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from medallion.bindings.common import table
from medallion.operators import catalog, sets, shape
from medallion.operators import checks as C
from medallion.operators.sketches import StoredDistinct, error_bound
from medallion.session import scratch_dir
from medallion.sources.snapshots import SnapshotTable
from medallion.sources.tables import export_parquet, overwrite_partitions, read_table, read_where, write_partitioned
from medallion.streaming.upsert import upsert_stream


def _orders(s, d):
    return table(s, d, "orders").withColumn("o_year", F.year("o_orderdate"))


def q_stream_upsert(s, d):
    """Orders, then changes of two kinds in two batches, then late changes that must lose.
    A change has a file per partition of the orders, and a batch as many files."""
    src, ckpt = scratch_dir(s, "upsert_src"), scratch_dir(s, "upsert_ckpt")
    t = SnapshotTable(s, scratch_dir(s, "upsert_snap"), ["o_year"])
    o = _orders(s, d)
    files = o.rdd.getNumPartitions()

    def change(status, more, seq):
        return o.where(F.col("o_orderstatus") == status).withColumn("o_totalprice", F.col("o_totalprice") + more).withColumn("seq", F.lit(seq))

    for changes in ([o.withColumn("seq", F.lit(0))], [change("F", 1, 2), change("O", 5, 1)], [change("F", 100, 1)]):
        for c in changes:
            c.write.mode("append").parquet(src)
        stream = s.readStream.schema(o.withColumn("seq", F.lit(0)).schema).option("maxFilesPerTrigger", files).parquet(src)
        upsert_stream(stream, t, ["o_orderkey"], ckpt, sequence_by="seq", by_partition=True)
    return t.read()


def q_data_diff_partitions(s, d):
    """A diff of versions that share all but the upserted years' directories."""
    t = SnapshotTable(s, scratch_dir(s, "diff_snap"), ["o_year"])
    o = _orders(s, d)
    t.commit(o.where(F.col("o_year") <= 1998))
    t.upsert(o.where(F.col("o_year") >= 1998).withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"], by_partition=True)
    return t.data_diff(0, 1, ["o_orderkey"])


def _set_inputs(s, d):
    o = table(s, d, "orders")
    a = o.where(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderpriority")
    return a, o.where(F.year("o_orderdate") >= 1998).select("o_custkey", "o_orderpriority")


def q_symdiff_digest(s, d):
    return sets.symmetric_difference(*_set_inputs(s, d), strategy="digest")


def q_equality_one_change(s, d):
    """Two copies of lineitem of which one order differs: the buckets of other rows agree."""
    li = table(s, d, "lineitem")
    last = F.col("l_orderkey") == F.lit(li.agg(F.max("l_orderkey")).first()[0])
    other = li.withColumn("l_quantity", F.when(last, -1.0).otherwise(F.col("l_quantity")))
    return C.equality(li, other.repartition("l_partkey")).failing_rows()


def _order_checks(o):
    return [C.not_null(o, "o_custkey", relation="orders"), C.accepted_range(o, "o_totalprice", 2000, 400000, relation="orders"),
            C.accepted_values(o, "o_orderstatus", ["F", "O"], relation="orders"), C.unique(o, "o_custkey", relation="orders"),
            C.not_constant(o, "o_orderpriority", relation="orders"), C.at_least_one(o, "o_orderdate", relation="orders"),
            C.not_null_proportion(o, "o_orderstatus", 0.99, where="o_totalprice > 5000", relation="orders"),
            C.recency(o, "o_orderdate", "day", 12, as_of=dt.datetime(2030, 1, 31), relation="orders"),
            C.unique_combination(o, ["o_orderkey", "o_custkey"], relation="orders")]


def q_checks_incremental(s, d):
    """Two loads, the second of which also reloads a year; the report after it."""
    path = scratch_dir(s, "checked_orders")
    states = C.CheckStates(s, path, scratch_dir(s, "check_states"), _order_checks)
    o = _orders(s, d)
    overwrite_partitions(o.where("o_year <= 1995"), path, ["o_year"])
    states.report().collect()
    overwrite_partitions(o.where("o_year > 1995 or o_year = 1995 and o_orderstatus <> 'P'"), path, ["o_year"])
    return states.report()


def q_distinct_stored(s, d):
    """Distinct customers per year and over all years (-1) from stored sketches, after a
    year was reloaded: the exact number, and whether the estimate is within its bound."""
    path = scratch_dir(s, "sketched_orders")
    stored = StoredDistinct(s, path, scratch_dir(s, "sketches"), ["o_custkey"], by=["o_year"])
    o = _orders(s, d)
    overwrite_partitions(o, path, ["o_year"])
    stored.estimates().collect()
    redo = o.where("o_year = 1997 and o_custkey % 2 = 0")
    overwrite_partitions(redo, path, ["o_year"])
    whole = F.lit(-1).alias("o_year")
    about = stored.estimates(["o_year"]).unionByName(stored.estimates().select(whole, "n_rows", "o_custkey"))
    now = o.where("o_year <> 1997").unionByName(redo)
    exact = now.select("o_year", "o_custkey").unionByName(now.select(whole, "o_custkey")).groupBy("o_year").agg(F.count_distinct("o_custkey").alias("n_customers"))
    return about.join(exact, "o_year").select(
        "o_year", "n_rows", "n_customers",
        (F.abs(F.col("o_custkey") - F.col("n_customers")) <= F.col("n_customers") * error_bound()).alias("within"))


def q_top_parts(s, d):
    """A top-N report over many values of like frequency: what the sketch cannot prove is counted."""
    return shape.top_values(table(s, d, "lineitem"), "l_partkey", 10)


def q_top_event_types(s, d):
    return shape.top_values(table(s, d, "events"), "event_type", 3)


def q_point_read(s, d):
    """One customer's orders from a table sorted by order, found by bloom filters."""
    path = scratch_dir(s, "point_orders")
    o = _orders(s, d)
    write_partitioned(o, path, ["o_year"], sort_by=["o_orderkey"], bloom=["o_custkey"], row_group_bytes=256 * 1024)
    return read_where(s, path, schema=o.schema, o_custkey=o.agg(F.max("o_custkey")).first()[0])


def q_union_databases(s, d):
    """A table per day in two databases, even days with other columns, read by one scan."""
    ev = table(s, d, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    even, mark = F.dayofmonth("ts") % 2 == 0, uuid.uuid4().hex[:8]
    made = []
    try:
        for name, rows in (("even", ev.where(even).select("user_id", "event_type", "ts", "day")), ("odd", ev.where(~even).select("user_id", "value", "ts", "day"))):
            path = scratch_dir(s, f"events_{name}")
            rows.write.partitionBy("day").parquet(path)
            made.append(f"days_{mark}_{name}")
            s.sql(f"CREATE DATABASE {made[-1]} LOCATION '{scratch_dir(s, made[-1])}'")
            for r in rows.select("day").distinct().collect():  # one row per calendar day
                s.catalog.createTable(f"{made[-1]}.events_{r['day']}", path=f"{path}/day={r['day']}", source="parquet")
        df = catalog.union_matching(s, f"days_{mark}_%", "EVENTS_%", source_column="src")
        return df.withColumn("src", F.substring_index("src", ".", -1))
    finally:
        for db in made:  # the tables are external: their files stay
            s.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def q_file_stats(s, d):
    """Files per year, known from four loads, and their KB against what the scan says."""
    path = scratch_dir(s, "file_stats")
    o = _orders(s, d)
    for part in range(4):
        o.where(F.col("o_orderkey") % 4 == part).coalesce(1).write.mode("append").partitionBy("o_year").parquet(path)
    from medallion.sources.snapshots import partition_file_stats
    stats = partition_file_stats(s, path, ["o_year"]).withColumn("o_year", F.col("o_year").cast("int"))
    seen = (s.read.parquet(path).select("o_year", "_metadata.file_path", "_metadata.file_size").distinct()
            .groupBy("o_year").agg(F.round(F.sum("file_size") / F.lit(1024.0), 1).alias("kb")))
    return stats.join(seen, "o_year").select("o_year", "n_files", (F.col("tamanho_kb") == F.col("kb")).alias("kb_agrees"))


def q_export_copy(s, d):
    """An export, and a read that merges the columns of two writes."""
    path = scratch_dir(s, "export")
    o = table(s, d, "orders")
    export_parquet(o.where("o_orderstatus = 'F'").drop("o_orderpriority"), f"{path}/part=0")
    export_parquet(o.where("o_orderstatus <> 'F'").drop("o_custkey"), f"{path}/part=1")
    return read_table(s, path, merge_schema=True, where="part >= 0").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "part")


QUERIES = {
    "stream_upsert": q_stream_upsert,
    "data_diff_partitions": q_data_diff_partitions,
    "symdiff_digest": q_symdiff_digest,
    "chk_equality_one_change": q_equality_one_change,
    "chk_incremental": q_checks_incremental,
    "distinct_stored": q_distinct_stored,
    "top_parts": q_top_parts,
    "top_event_types": q_top_event_types,
    "point_read": q_point_read,
    "union_databases": q_union_databases,
    "file_stats": q_file_stats,
    "export_merged": q_export_copy,
}

_O = "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders"
_A = "SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'"
_B = "SELECT o_custkey, o_orderpriority FROM orders WHERE year(o_orderdate) >= 1998"
_T = f"(SELECT * FROM ({_O}) WHERE NOT (o_year = 1995 AND o_orderstatus = 'P')) t"
_R = f"(SELECT * FROM ({_O}) WHERE o_year <> 1997 OR o_custkey % 2 = 0)"
_LI = "l_orderkey, l_partkey, l_suppkey, l_linenumber, {}, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_CHANGED = "l_orderkey = (SELECT max(l_orderkey) FROM lineitem)"

_FAILURES = [
    ("not_null_o_custkey", f"SELECT count(*) FILTER (WHERE o_custkey IS NULL) FROM {_T}"),
    ("accepted_range_o_totalprice", f"SELECT count(*) FILTER (WHERE NOT (o_totalprice >= 2000 AND o_totalprice <= 400000)) FROM {_T}"),
    ("accepted_values_o_orderstatus", f"SELECT count(DISTINCT o_orderstatus) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM {_T}"),
    ("unique_o_custkey", f"SELECT count(*) FROM (SELECT o_custkey FROM {_T} WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"),
    ("not_constant_o_orderpriority", f"SELECT CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN 1 ELSE 0 END FROM {_T}"),
    ("at_least_one_o_orderdate", f"SELECT CASE WHEN count(o_orderdate) = 0 THEN 1 ELSE 0 END FROM {_T}"),
    ("not_null_proportion_o_orderstatus", f"SELECT CASE WHEN count(o_orderstatus) < 0.99 * count(*) THEN 1 ELSE 0 END FROM {_T} WHERE o_totalprice > 5000"),
    ("recency_o_orderdate", f"SELECT CASE WHEN max(o_orderdate) < TIMESTAMP '2030-01-19 00:00:00' THEN 1 ELSE 0 END FROM {_T}"),
    ("unique_combination_of_o_orderkey_o_custkey", f"SELECT count(*) FROM (SELECT o_orderkey, o_custkey FROM {_T} GROUP BY 1, 2 HAVING count(*) > 1)"),
]

ORACLE = {
    "stream_upsert": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 5 ELSE 0 END
        AS o_totalprice, o_orderdate, o_orderpriority, o_year, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END AS seq FROM ({_O})""",
    "data_diff_partitions": f"SELECT o_orderkey, CASE WHEN o_year > 1998 THEN 'added' ELSE 'changed' END AS change FROM ({_O}) WHERE o_year >= 1998",
    "symdiff_digest": f"""SELECT 'a_minus_b' AS which_diff, * FROM ({_A} EXCEPT {_B})
        UNION ALL SELECT 'b_minus_a', * FROM ({_B} EXCEPT {_A})""",
    "chk_equality_one_change": f"""SELECT 'a_minus_b' AS which_diff, {_LI.format('l_quantity')} FROM lineitem WHERE {_CHANGED}
        UNION SELECT 'b_minus_a', {_LI.format('-1.0')} FROM lineitem WHERE {_CHANGED}""",
    "chk_incremental": " UNION ALL ".join(
        f"""SELECT {i} AS check_index, '{name}' AS "check", 'orders' AS relation, CAST(f AS BIGINT) AS failures,
            CASE WHEN f <> 0 THEN 'fail' ELSE 'pass' END AS status FROM (SELECT ({sql}) AS f)""" for i, (name, sql) in enumerate(_FAILURES)),
    "distinct_stored": f"""SELECT o_year, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers, true AS within FROM {_R} GROUP BY 1
        UNION ALL SELECT -1, count(*), count(DISTINCT o_custkey), true FROM {_R}""",
    "top_parts": "SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 10",
    "top_event_types": "SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value NULLS FIRST LIMIT 3",
    "point_read": f"SELECT * FROM ({_O}) WHERE o_custkey = (SELECT max(o_custkey) FROM orders)",
    "union_databases": """SELECT 'events_' || strftime(ts, '%Y%m%d') AS src, user_id, CASE WHEN day(ts) % 2 = 0 THEN event_type END AS event_type, ts,
        CASE WHEN day(ts) % 2 = 1 THEN value END AS value FROM events""",
    "file_stats": f"SELECT o_year, count(DISTINCT o_orderkey % 4) AS n_files, true AS kb_agrees FROM ({_O}) GROUP BY 1",
    "export_merged": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
        CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS part FROM orders""",
}
