import datetime as dt

import pytest
from pyspark.sql import functions as F

from medallion.operators import checks as C


def n(check):
    return check.failing_rows().count()


def test_row_checks(spark):
    df = spark.createDataFrame([(1, "a", 0.5, " "), (2, None, 1.5, ""), (None, "c", None, "x")],
                               "id int, s string, x double, t string")
    assert n(C.not_null(df, "id")) == 1
    assert n(C.accepted_values(df, "s", ["a", "c"])) == 0           # NULL passes
    assert n(C.accepted_values(df, "s", ["a"])) == 1
    assert n(C.accepted_range(df, "x", 0, 1)) == 1                  # NULL passes
    assert n(C.accepted_range(df, "x", 0.5, 1.5, inclusive=False)) == 2
    assert n(C.accepted_range(df, "x")) == 0                         # no bound never fails
    assert n(C.accepted_range(df, "x", min_value=F.col("id"))) == 2
    assert n(C.not_empty_string(df, "t")) == 2
    assert n(C.not_empty_string(df, "t", trim_whitespace=False)) == 1
    assert n(C.not_accepted_values(df, "s", ["c", "z"])) == 1
    assert n(C.expression_is_true(df, "x < 1")) == 1                 # NULL result passes
    assert n(C.expression_is_true(df, "< 1", column="x")) == 1
    assert n(C.unique(df, "id")) == 0
    assert n(C.assert_equal(df.withColumn("e", F.col("x")), "x", "e")) == 0


def test_grouped_checks(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("b", 1), ("c", 1), ("c", 2)],
                               "field string, value int")
    assert n(C.at_least_one(df, "value", group_by=["field"])) == 1
    assert n(C.at_least_one(df, "value")) == 0
    assert n(C.at_least_one(df.where("field = 'a'"), "value")) == 1
    assert n(C.not_constant(df, "value", group_by=["field"])) == 1   # b; all-NULL a passes
    assert n(C.not_constant(df, "value")) == 0
    assert n(C.not_null_proportion(df, "value", at_least=0.5)) == 0
    assert n(C.not_null_proportion(df, "value", at_least=0.5, group_by=["field"])) == 1
    assert n(C.unique_combination(df, ["field", "value"])) == 2


def test_relationships_and_cardinality(spark):
    a = spark.createDataFrame([(1,), (2,), (4,), (None,)], "id int")
    b = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id int")
    assert n(C.relationships_where(a, "id", b, "id")) == 1
    assert n(C.relationships_where(a, "id", b, "id", from_condition="id <> 4")) == 0
    assert n(C.cardinality_equality(a, "id", b, "id")) == 2


def test_equality_and_rowcounts(spark):
    a = spark.createDataFrame([(1, 1.00001), (2, 2.0)], "id int, f double")
    b = spark.createDataFrame([(1, 1.00002), (2, 2.0)], "id int, f double")
    assert n(C.equality(a, b)) == 2
    assert n(C.equality(a, b, precision=4)) == 0
    assert n(C.equality(a, b, compare_columns=["id"])) == 0
    with pytest.raises(ValueError):
        C.equality(a, b, compare_columns=["id"], exclude_columns=["f"])
    with pytest.raises(ValueError):
        C.equality(a, b.withColumn("extra", F.lit(1))).failing_rows()
    chk = C.equality(a, b)
    assert chk.failures().first()["failures"] == 2
    g = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    h = spark.createDataFrame([("x",), ("z",)], "k string")
    assert C.equal_rowcount(g, g).failures().first()[0] == 0
    assert C.equal_rowcount(g, h).failures().first()[0] == 1
    # a group present on one side only counts 0 by default, not in strict mode
    assert C.equal_rowcount(g, h, group_by=["k"]).failures().first()[0] == 1
    assert C.equal_rowcount(g, h, group_by=["k"], strict_groups=True).failures().first()[0] == 3
    assert C.fewer_rows_than(h, g).failures().first()[0] == 0
    assert C.fewer_rows_than(g, h).failures().first()[0] == 1
    assert C.fewer_rows_than(g, g).failures().first()[0] == 1


def test_ranges(spark):
    ok = spark.createDataFrame([(0, 5), (5, 10), (10, 15)], "lower_bound int, upper_bound int")
    assert n(C.mutually_exclusive_ranges(ok, "lower_bound", "upper_bound", gaps="not_allowed")) == 0
    gaps = spark.createDataFrame([("a", 0, 5), ("a", 6, 9), ("b", 0, 5), ("b", 4, None)],
                                 "s string, valid_from int, valid_to int")
    f = C.mutually_exclusive_ranges(gaps, "valid_from", "valid_to", partition_by="s", gaps="required")
    assert n(f) == 2   # b overlaps, and b's open range fails
    zero = spark.createDataFrame([(0, 0), (0, 5)], "lo int, hi int")
    assert n(C.mutually_exclusive_ranges(zero, "lo", "hi", zero_length_range_allowed=True)) == 0
    assert n(C.mutually_exclusive_ranges(zero, "lo", "hi")) == 1
    with pytest.raises(ValueError):
        C.mutually_exclusive_ranges(zero, "lo", "hi", gaps="sometimes")


def test_sequential_and_recency(spark):
    s = spark.createDataFrame([(1,), (2,), (3,), (5,), (5,)], "v int")
    f = sorted(tuple(r) for r in C.sequential_values(s, "v", n_buckets=3).failing_rows().collect())
    assert f == [(5, 3), (5, 5)]
    assert n(C.sequential_values(s, "v", interval=2)) == 3   # 2, 3 and the repeated 5
    t = spark.createDataFrame([(dt.datetime(2024, 1, 30, 23),)], "ts timestamp_ntz")
    assert n(C.recency(t, "ts", "day", 1, as_of=dt.datetime(2024, 1, 31, 12))) == 0
    assert n(C.recency(t, "ts", "day", 1, as_of=dt.datetime(2024, 2, 1, 0))) == 1
    assert n(C.recency(t.where("ts < '2000-01-01'"), "ts", "day", 1, as_of=dt.datetime(2024, 2, 1))) == 0
    late = dt.datetime(2024, 1, 31, 23, 30)
    assert n(C.recency(t, "ts", "day", 1, as_of=late)) == 1
    assert n(C.recency(t, "ts", "day", 1, as_of=late, ignore_time_component=True)) == 0


def test_runner_thresholds_and_fusion(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "z")], "id int, s string")
    checks = [C.not_null(df, "id"), C.accepted_values(df, "s", ["a", "b"]).configured(warn_if=">0", error_if=">5"),
              C.not_null(df, "s").configured(severity="warn"), C.unique(df, "s"),
              C.expression_is_true(df, "id > 5").configured(severity="warn")]
    rep = {r["check_index"]: r for r in C.run_checks(checks).collect()}
    assert rep[0]["failures"] == 1 and rep[0]["status"] == "fail"
    assert rep[1]["failures"] == 1 and rep[1]["status"] == "warn"
    assert rep[2]["status"] == "pass" and rep[3]["status"] == "pass"
    assert rep[4]["failures"] == 2 and rep[4]["status"] == "warn"
    unfused = {r["check_index"]: (r["failures"], r["status"]) for r in C.run_checks(checks, fuse=False).collect()}
    assert unfused == {k: (v["failures"], v["status"]) for k, v in rep.items()}
    # the fusable checks on one table are one scan (accepted_values runs alone)
    plan = C.run_checks([checks[0], checks[2], checks[4]])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "SortAggregate" not in plan


def test_custom_measure_and_store(spark):
    import tempfile
    df = spark.createDataFrame([(1,), (5,), (7,)], "x int")
    chk = C.accepted_range(df, "x", 0, 4).configured(measure=lambda r: F.sum("x"), error_if=">100", warn_if=">0")
    rep = C.run_checks([chk]).first()
    assert rep["failures"] == 12 and rep["status"] == "warn"
    path = tempfile.mkdtemp(prefix="fail-") + "/rows"
    chk.store_failures(path)
    assert spark.read.parquet(path).count() == 2


def test_sequential_hot_value_is_spread(spark):
    """A value held by half of the rows is cut over several buckets (rows differ
    in other columns), and the failing rows still equal the plain window's."""
    import random
    from pyspark.sql import Window
    rnd = random.Random(2)
    data = [(7 if rnd.random() < 0.5 else rnd.randint(0, 500), i) for i in range(4000)]
    df = spark.createDataFrame(data, "v int, other int")
    got = C.sequential_values(df, "v", n_buckets=8).failing_rows()
    plain = (df.select("v").withColumn("previous_v", F.lag("v").over(Window.orderBy("v")))
             .where(~(F.col("v") == F.col("previous_v") + 1)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    from medallion.plans.ranged import add_range_bucket
    b = add_range_bucket(df.withColumn("h", F.xxhash64("v", "other")), "v", 8)
    assert b.where("v = 7").select("_rng_bucket").distinct().count() > 1
