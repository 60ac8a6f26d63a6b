import os
import tempfile

import pytest
from pyspark.sql import functions as F

from medallion.bindings import growing
from medallion.plans.inspect import physical_plan
from medallion.sources.snapshots import SnapshotTable
from medallion.streaming.upsert import latest_changes, upsert_stream

DDL = "k string, ano int, v double, seq long"


def _write(spark, path, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(path)


def _setup(spark):
    src, ckpt = tempfile.mkdtemp(prefix="ups-src-"), tempfile.mkdtemp(prefix="ups-ckpt-")
    t = SnapshotTable(spark, tempfile.mkdtemp(prefix="ups-snap-"), ["ano"])

    def run():
        stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(src)
        return upsert_stream(stream, t, ["k"], ckpt, sequence_by="seq", by_partition=True)
    return src, t, run


def _rows(t):
    return sorted((tuple(r) for r in t.read().collect()), key=str)


def test_batches_merge_in_sequence(spark):
    src, t, run = _setup(spark)
    _write(spark, src, [("a", 2020, 1.0, 1), ("b", 2020, 2.0, 1), ("b", 2020, 3.0, 5), ("c", 2021, 4.0, 1)])
    assert run() == {"merged": [0], "skipped": []}
    _write(spark, src, [("b", 2020, 9.0, 4), ("c", 2022, 5.0, 2), (None, 2021, 7.0, 1)])  # b is late, c moves
    assert run()["merged"] == [1]
    assert run() == {"merged": [], "skipped": []}  # nothing new
    assert _rows(t) == sorted([("a", 2020, 1.0, 1), ("b", 2020, 3.0, 5), ("c", 2022, 5.0, 2), (None, 2021, 7.0, 1)], key=str)


@pytest.mark.parametrize("after_commit", [False, True])
def test_batch_that_dies_is_replayed_once(spark, monkeypatch, after_commit):
    src, t, run = _setup(spark)
    _write(spark, src, [("a", 2020, 1.0, 1)])
    run()
    _write(spark, src, [("a", 2020, 2.0, 2), ("b", 2021, 3.0, 2)])
    commit = SnapshotTable._write_commit

    def dies(self, *args, **kw):
        if after_commit:
            commit(self, *args, **kw)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_write_commit", dies)
        with pytest.raises(Exception, match="lost"):
            run()
    # the rows were written, but only a commit makes them visible
    assert t.latest_version() == (1 if after_commit else 0)
    assert run() == ({"merged": [], "skipped": [1]} if after_commit else {"merged": [1], "skipped": []})
    assert t.latest_version() == 1 and _rows(t) == [("a", 2020, 2.0, 2), ("b", 2021, 3.0, 2)]


def test_new_checkpoint_starts_anew(spark):
    src, t, run = _setup(spark)
    _write(spark, src, [("a", 2020, 1.0, 1)])
    run()
    stream = spark.readStream.schema(DDL).parquet(src)
    again = upsert_stream(stream, t, ["k"], tempfile.mkdtemp(prefix="ups-ckpt-"), sequence_by="seq")
    assert again["merged"] == [0] and _rows(t) == [("a", 2020, 1.0, 1)]


def test_latest_changes_do_not_depend_on_order(spark):
    rows = [("a", 1, float(v), v % 3) for v in range(30)] + [(None, 1, 1.0, 1)] * 2 + [("z", 1, 5.0, None), ("z", 1, 6.0, 0)]
    df = spark.createDataFrame(rows, DDL)
    got = [sorted(map(str, latest_changes(df.orderBy(F.rand(s)), ["k"], "seq").collect())) for s in (1, 2)]
    assert got[0] == got[1] and len(got[0]) == 4 and any("seq=0" in r for r in got[0])


def test_diff_reads_changed_directories_only(spark):
    t = SnapshotTable(spark, tempfile.mkdtemp(prefix="diff-snap-"), ["ano"])
    t.commit(spark.createDataFrame([(str(i), 2000 + i % 10, float(i), 0) for i in range(100)], DDL))
    t.upsert(spark.createDataFrame([("3", 2003, 9.0, 0), ("x", 2003, 1.0, 0)], DDL), ["k"], by_partition=True)
    d = t.data_diff(0, 1, ["k"])
    assert sorted(tuple(r) for r in d.collect()) == [("3", "changed"), ("x", "added")]
    assert {f.split("/ano=")[1].split("/")[0] for f in d.inputFiles()} == {"2003"}
    t.restore(0)
    assert t.data_diff(0, 2, ["k"]).inputFiles() == [] and t.data_diff(0, 2, ["k"]).count() == 0
    assert sorted(r.change for r in t.data_diff(1, 2, ["k"]).collect()) == ["changed", "removed"]


def test_commit_reads_do_not_grow_with_the_log(spark):
    t = SnapshotTable(spark, tempfile.mkdtemp(prefix="log-snap-"), ["ano"])
    t.commit(spark.createDataFrame([(str(i), 2000 + i, float(i), 0) for i in range(12)], DDL))
    for v in range(3):
        t.upsert(spark.createDataFrame([("0", 2000, float(v), 0)], DDL), ["k"], by_partition=True)
    assert len(t._commit_cache) <= 2 and t.latest_version() == 3
    assert len(t._paths(3)) == 12 and t.read(1).where("k = '0'").first().v == 0.0
    with pytest.raises(ValueError):
        t.read(7)


def test_progress_is_kept_under_the_streams_own_id(spark):
    src, t, run = _setup(spark)
    _write(spark, src, [("a", 2020, 1.0, 1)])
    run()
    names = [r.n for r in t._log().where("txn is not null").selectExpr("txn.appId as n").collect()]
    assert len(names) == 1 and len(names[0]) == 36 and "/" not in names[0] and t.last_txn(names[0]) == 0


def test_changes_are_dealt_out_before_they_are_sorted(spark):
    """A batch that is one task sorts none of its rows there."""
    batch = spark.range(100).selectExpr("cast(id % 7 AS string) AS k", "2020 AS ano", "id * 1.0D AS v", "id % 50 AS seq").coalesce(1)
    latest = latest_changes(batch, ["k"], "seq")
    assert sorted((r["k"], r["seq"]) for r in latest.collect()) == [(str(k), max(i % 50 for i in range(k, 100, 7))) for k in range(7)]
    lines = [line.strip(" :+-*()0123456789") for line in physical_plan(latest_changes(batch, ["k"], "seq")).splitlines()]
    lowest = max(i for i, x in enumerate(lines) if x.startswith("Sort"))
    assert any(x.startswith("Exchange") for x in lines[lowest:])


def test_a_change_is_written_by_as_many_tasks_as_read_it(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(growing, "scratch_dir", lambda s, name: made.append(f"{tmp_path}/{name}") or made[-1])
    o = spark.range(90).selectExpr("id AS o_orderkey", "id % 5 AS o_custkey", "element_at(array('F', 'O', 'P'), cast(id % 3 AS int) + 1) AS o_orderstatus",
                                   "cast(id AS double) AS o_totalprice", "timestamp '1996-01-01' + make_dt_interval(cast(id AS int) * 20) AS o_orderdate",
                                   "'5-LOW' AS o_orderpriority")
    for i in range(3):
        o.where(F.col("o_orderkey") % 3 == i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", 64 << 20)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 64 << 20)
    try:
        got = growing.q_stream_upsert(spark, str(tmp_path)).collect()
        files = [f for f in os.listdir(made[0]) if f.endswith(".parquet")]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(files) > 4
    more, seq = {"F": 1, "O": 5, "P": 0}, {"F": 2, "O": 1, "P": 0}
    assert len(got) == 90 and all(r["o_totalprice"] == r["o_orderkey"] + more[r["o_orderstatus"]] and r["seq"] == seq[r["o_orderstatus"]] for r in got)
