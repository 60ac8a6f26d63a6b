import os
import tempfile

import pytest

from medallion.operators import checks as C
from medallion.sources.tables import overwrite_partitions

DDL = "k int, v double, s string, y int"


def _checks(df):
    return [C.not_null(df, "v"), C.accepted_range(df, "v", 0, 50), C.accepted_values(df, "s", ["a", "b"]), C.unique(df, "k"),
            C.at_least_one(df, "s"), C.not_constant(df, "y"), C.not_constant(df, "s"), C.not_null_proportion(df, "v", 0.9),
            C.unique_combination(df, ["k", "s"]), C.not_accepted_values(df, "s", ["c"]), C.not_empty_string(df, "s", where="y > 2001"),
            C.expression_is_true(df, "k < 40")]


def _same(spark, path, states):
    got = {r.check_index: tuple(r) for r in states.report().collect()}
    want = {r.check_index: tuple(r) for r in C.run_checks(_checks(spark.read.parquet(path)), fuse=False).collect()}
    assert got == want
    return got


def test_reports_over_loads_equal_the_full_run(spark):
    path, root = tempfile.mkdtemp(prefix="inc-"), tempfile.mkdtemp(prefix="inc-states-")
    load = lambda rows: overwrite_partitions(spark.createDataFrame(rows, DDL), path, ["y"])
    load([(1, 1.0, "a", 2000), (2, None, "a", 2000), (3, 99.0, "c", 2001)])
    states = C.CheckStates(spark, path, root, _checks)
    _same(spark, path, states)
    assert states.scanned == {"partitions": 2, "rows": 3}
    _same(spark, path, states)
    assert states.scanned == {"partitions": 0, "rows": 0}
    load([(3, 5.0, "d", 2002), (4, 6.0, "", 2002), (41, 7.0, None, 2002), (4, 7.0, "", 2002)])
    got = _same(spark, path, states)
    assert states.scanned == {"partitions": 1, "rows": 4}
    assert got[3][3] == 2 and got[2][3] == 3  # k = 3 and 4 repeat, 3 over both loads; c, d and '' are new
    # a partition is reloaded: its old state no longer counts
    load([(7, 5.0, "a", 2001)])
    got = _same(spark, path, C.CheckStates(spark, path, root, _checks))
    assert got[3][3] == 1 and got[9][3] == 0


def test_other_checks_start_anew_and_grouped_ones_are_refused(spark):
    path, root = tempfile.mkdtemp(prefix="inc-"), tempfile.mkdtemp(prefix="inc-states-")
    overwrite_partitions(spark.createDataFrame([(1, 1.0, "a b", 2000)], DDL), path, ["s", "y"])
    one = C.CheckStates(spark, path, root, lambda df: [C.not_null(df, "v")])
    assert one.report().first().failures == 0
    two = C.CheckStates(spark, path, root, lambda df: [C.accepted_range(df, "v", 2, 3), C.unique(df, "s")])
    assert sorted(r.failures for r in two.report().collect()) == [0, 1] and two.scanned["rows"] == 1
    with pytest.raises(ValueError):
        C.CheckStates(spark, path, root, lambda df: [C.at_least_one(df, "v", group_by=["y"])]).report()


def test_run_that_died_does_not_count(spark, monkeypatch):
    path, root = tempfile.mkdtemp(prefix="inc-"), tempfile.mkdtemp(prefix="inc-states-")
    overwrite_partitions(spark.createDataFrame([(1, 1.0, "a", 2000), (1, 1.0, "z", 2000)], DDL), path, ["y"])
    build = lambda df: [C.unique(df, "k"), C.accepted_values(df, "s", ["a"])]
    states = C.CheckStates(spark, path, root, build)
    states.report()
    # values of a run without states: as if it had died between its two writes
    orphan = spark.createDataFrame([("dead", "x", 0, "v", 5), ("dead", "x", 0, "v", 5)], "run string, part string, at int, value string, n bigint")
    orphan.write.mode("append").parquet(f"{root}/{os.listdir(root)[0]}/values")
    assert sorted(r.failures for r in states.report().collect()) == [1, 1]
