import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from medallion.sources.snapshots import SnapshotTable, data_diff


def _table(spark, name, by=("ano",)):
    return SnapshotTable(spark, tempfile.mkdtemp(prefix=f"snap-{name}-"), list(by))


def _src(spark, rows):
    return spark.createDataFrame(rows, "k string, ano int, v double")


def test_upsert_semantics(spark):
    t = _table(spark, "ups")
    t.commit(_src(spark, [("a", 2020, 1.0), ("b", 2020, 2.0), ("c", 2021, 3.0)]))
    t.upsert(_src(spark, [("b", 2020, 20.0), ("d", 2021, 4.0), (None, 2021, 9.0)]), ["k", "ano"])
    got = sorted((tuple(r) for r in t.read().collect()), key=str)
    assert got == sorted([("a", 2020, 1.0), ("b", 2020, 20.0), ("c", 2021, 3.0), ("d", 2021, 4.0),
                          (None, 2021, 9.0)], key=str)
    # NULL keys never match: upserting the same NULL-key row again inserts it again
    t.upsert(_src(spark, [(None, 2021, 9.0)]), ["k", "ano"])
    assert t.read().where(F.col("k").isNull()).count() == 2


def test_upsert_idempotent_and_partition_mode_equal(spark):
    base = [("a", 2020, 1.0), ("b", 2020, 2.0), ("c", 2021, 3.0), ("e", 2022, 5.0)]
    change = [("b", 2020, 20.0), ("f", 2021, 6.0)]
    full, part = _table(spark, "full"), _table(spark, "part")
    for t, bp in ((full, False), (part, True)):
        t.commit(_src(spark, base))
        t.upsert(_src(spark, change), ["k"], by_partition=bp)
        t.upsert(_src(spark, change), ["k"], by_partition=bp)   # twice ≡ once
    a = sorted(tuple(r) for r in full.read().collect())
    b = sorted(tuple(r) for r in part.read().collect())
    assert a == b and len(a) == 5


def test_duplicate_source_keys_raise(spark):
    t = _table(spark, "dup")
    t.commit(_src(spark, [("a", 2020, 1.0)]))
    with pytest.raises(ValueError):
        t.upsert(_src(spark, [("x", 2020, 1.0), ("x", 2020, 2.0)]), ["k"])


def test_history_restore_as_of(spark):
    t = _table(spark, "hist")
    t.commit(_src(spark, [("a", 2020, 1.0)]))
    t.add_column(lambda df: df.withColumn("extra", F.lit(7)))
    assert "extra" not in t.read(0).columns and "extra" in t.read(1).columns
    t.restore(0)
    assert sorted(tuple(r) for r in t.read().collect()) == sorted(tuple(r) for r in t.read(0).collect())
    h = [(r["version"], r["operation"]) for r in t.history().collect()]
    assert h == [(0, "WRITE"), (1, "WRITE"), (2, "RESTORE")]
    ts0 = t.history().first()["timestamp_ms"]
    assert t.version_as_of(ts0) == 0
    with pytest.raises(ValueError):
        t.version_as_of(dt.datetime(2000, 1, 1))
    diff = t.schema_diff(0, 1).first()
    assert diff["added"] == ["extra"] and diff["removed"] == []
    m = {r["version"]: r["extra"] for r in t.schema_by_version().collect()}
    assert m == {0: False, 1: True, 2: False}


def test_data_diff(spark):
    a = _src(spark, [("a", 2020, 1.0), ("b", 2020, None), ("c", 2020, 3.0)])
    b = _src(spark, [("a", 2020, 1.0), ("b", 2020, None), ("c", 2020, 4.0), ("d", 2020, 1.0)])
    got = sorted(tuple(r) for r in data_diff(a.drop("ano"), b.drop("ano"), ["k"]).collect())
    assert got == [("c", "changed"), ("d", "added")]
    got = sorted(tuple(r) for r in data_diff(b.drop("ano"), a.drop("ano"), ["k"]).collect())
    assert got == [("c", "changed"), ("d", "removed")]


def test_partition_mode_with_null_partition(spark):
    t = _table(spark, "nullpart")
    t.commit(_src(spark, [("a", 2020, 1.0), ("b", None, 2.0), ("c", 2021, 3.0)]))
    t.upsert(_src(spark, [("b", None, 20.0), ("d", 2021, 4.0)]), ["k"], by_partition=True)
    got = sorted((tuple(r) for r in t.read().collect()), key=str)
    assert got == sorted([("a", 2020, 1.0), ("b", None, 20.0), ("c", 2021, 3.0), ("d", 2021, 4.0)], key=str)
    stats = {r["ano"]: r["n_files"] for r in t.file_stats().collect()}
    assert set(stats) == {2020, 2021, None}


def test_two_handles_and_a_dead_commit(spark, tmp_path):
    import os
    root = str(tmp_path / "two")
    a, b = SnapshotTable(spark, root), SnapshotTable(spark, root)
    one = lambda x: spark.createDataFrame([(x,)], "v string")
    a.commit(one("a0"))
    b.read()
    a.commit(one("a1"))
    assert b.commit(one("b2")) == 2
    assert [SnapshotTable(spark, root).read(v).first()["v"] for v in (0, 1, 2)] == ["a0", "a1", "b2"]
    os.makedirs(f"{root}/commit_log/v={3:020d}/_temporary/0")
    assert a.commit(one("a3")) == 3 and b.read(3).first()["v"] == "a3"


def test_data_diff_matches_null_keys(spark):
    from medallion.sources.snapshots import data_diff
    rows = spark.createDataFrame([(None, 1), ("k", 2)], "k string, v int")
    assert data_diff(rows, rows, ["k"]).count() == 0
