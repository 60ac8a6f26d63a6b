import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators import checks as C
from medallion.operators.sets import differing_buckets, differing_rows, symmetric_difference
from medallion.plans.inspect import physical_plan
from tests.conftest import rows


def _table(spark, n=5000):
    return spark.range(n).select("id", F.when(F.col("id") % 7 != 0, F.concat(F.lit("t"), "id")).alias("t"), (F.col("id") / 3).alias("x"))


def _shuffled(df):
    """Records written by the shuffles of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_equal_tables_shuffle_digests_only(spark):
    a, b = _table(spark), _table(spark).repartition(3)
    assert differing_buckets(a, b).count() == 0
    report = C.equality(a, b).failing_rows()
    assert report.count() == 0
    # a digest per bucket, side and map task, and then none of the 5,000 rows
    few = symmetric_difference(a.repartition(1), b.coalesce(1), strategy="digest")
    assert _shuffled(symmetric_difference(_table(spark), _table(spark), strategy="aggregate")) >= 10_000
    left, right = differing_rows(a, b, 64)
    assert left.count() == right.count() == 0 and few.count() == 0


def test_one_changed_row(spark):
    a = _table(spark)
    b = a.withColumn("x", F.when(F.col("id") == 77, -1.0).otherwise(F.col("x")))
    assert differing_buckets(a, b).count() in (1, 2)
    left, right = differing_rows(a, b)
    assert left.count() < 20 and right.count() < 20
    want = sorted(rows(symmetric_difference(a, b)))
    assert sorted(rows(symmetric_difference(a, b, strategy="digest"))) == want and len(want) == 2
    assert C.equality(a, b).failures().first()[0] == C.equality(a, b, strategy="aggregate").failures().first()[0] == 2


DDL = "a int, b int, c string, l array<int>"


@pytest.mark.parametrize("left, right", [
    ([(1, None, "x", [1])], [(None, 1, "x", [1])]),             # only the place of the NULL differs
    ([(1, 1, None, None)], [(1, 1, "", None)]),
    ([(1, 1, "ab", [1, None])], [(1, 1, "ab", [None, 1])]),
    ([(1, 2, "x", [1])] * 3, [(1, 2, "x", [1])]),               # distinct rows are the same
    ([(1, 2, "x", [1]), (3, 4, "y", None)], []), ([], []), ([(0, 0, "", [])], [(0, 0, "", [])]),
])
def test_digests_agree_with_the_aggregate(spark, left, right):
    a, b = spark.createDataFrame(left, DDL), spark.createDataFrame(right, DDL)
    want = sorted(map(str, rows(symmetric_difference(a, b))))
    assert sorted(map(str, rows(symmetric_difference(a, b, strategy="digest")))) == want


def test_maps_and_other_types_take_the_aggregate(spark):
    a = spark.createDataFrame([(1,)], "x int")
    assert symmetric_difference(a, spark.createDataFrame([(1,)], "x bigint"), strategy="digest").count() == 0
    assert "BroadcastExchange" not in physical_plan(symmetric_difference(a, a.select(F.col("x").cast(T.LongType())), strategy="digest"))
    with pytest.raises(ValueError):
        symmetric_difference(a, a, strategy="hash")
