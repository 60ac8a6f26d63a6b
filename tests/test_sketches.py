import tempfile

import pytest
from pyspark.sql import functions as F

from medallion.operators.marts import overview_kpis
from medallion.operators.shape import top_values, value_counts
from medallion.operators.sketches import StoredDistinct, error_bound
from medallion.plans.inspect import physical_plan
from medallion.sources.tables import overwrite_partitions, read_where, write_partitioned


def test_stored_distinct_counts(spark):
    path, root = tempfile.mkdtemp(prefix="hll-"), tempfile.mkdtemp(prefix="hll-states-")
    df = spark.range(40_000).selectExpr("id % 9000 as k", "concat('t', id % 700) as t", "cast(id % 4 as int) as y",
                                        "cast(if(id < 10, null, id / 8) as double) as x")
    overwrite_partitions(df, path, ["y"])
    s = StoredDistinct(spark, path, root, ["k", "t", "x"], by=["y"])
    exact = lambda d, c: d.select(F.count_distinct(c)).first()[0]

    def close(row, d):
        for c in ("k", "t", "x"):
            assert abs(row[c] - exact(d, c)) <= error_bound() * exact(d, c)
        assert row.n_rows == d.count()

    close(s.estimates().first(), df)
    assert s.scanned == {"partitions": 4, "rows": 40_000}
    for r in s.estimates(by=["y"]).collect():
        close(r, df.where(F.col("y") == r.y))
    assert s.scanned == {"partitions": 0, "rows": 0}
    redo = df.where("y = 2 and k < 100")
    overwrite_partitions(redo, path, ["y"])
    now = df.where("y <> 2").union(redo)
    close(s.estimates().first(), now)
    assert s.scanned["partitions"] == 1
    with pytest.raises(ValueError):
        s.estimates(by=["z"])


def test_top_values_are_proved_or_counted(spark):
    hot = spark.range(30_000).selectExpr("case when id % 3 = 0 then 'a' when id % 5 = 0 then 'b' when id % 7 = 0 then null else concat('v', id) end as v")
    for n in (1, 2, 3):
        want = value_counts(hot, "v", max_records=n).collect()
        assert top_values(hot, "v", n, tracked=400).collect() == want
    # the proof holds for the hot values: the answer is read from the candidates' counts,
    # where it does not hold every value is counted
    assert "HashAggregate" not in physical_plan(top_values(hot, "v", 2, tracked=400))
    assert "HashAggregate" in physical_plan(top_values(hot, "v", 30, tracked=40))
    flat = spark.range(5000).selectExpr("id % 2500 as v")  # all alike: no sketch can name them
    assert top_values(flat, "v", 3, tracked=10).collect() == value_counts(flat, "v", max_records=3).collect()
    few = spark.createDataFrame([(None,), (None,), ("x",)], "v string")
    assert [tuple(r) for r in top_values(few, "v", 5).collect()] == [(None, 2), ("x", 1)]
    assert top_values(few.where("false"), "v", 5).collect() == []
    assert top_values(flat.selectExpr("cast(v as double) v"), "v", 1).first().n == 2


def _scan_rows(df):
    df.collect()
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            return node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]


def test_point_reads_skip_row_groups(spark):
    path, plain = tempfile.mkdtemp(prefix="skip-"), tempfile.mkdtemp(prefix="plain-")
    df = spark.range(60_000).selectExpr("id", "hash(id) as h", "cast(id % 2 as int) as y", "repeat(string(id), 8) as t").orderBy("h")
    write_partitioned(df, path, ["y"], sort_by=["id"], bloom=["h"], row_group_bytes=128 * 1024)
    write_partitioned(df, plain, ["y"])
    row = df.where("id = 31234").first()
    assert _scan_rows(read_where(spark, path, id=31234)) < 15_000  # by range
    assert _scan_rows(read_where(spark, path, h=row.h, y=0)) < 15_000  # by bloom filter: h is in no order there
    assert _scan_rows(read_where(spark, plain, h=row.h, y=0)) == 30_000
    assert read_where(spark, path, h=row.h).select("id").collect() == [(31234,)]
    write_partitioned(df, path, sort_by=["id"])
    assert read_where(spark, path, id=5).count() == 1


def test_approximate_kpis(spark):
    df = spark.range(1000).selectExpr("concat('UF', id % 27) as uf", "cast(2020 + id % 3 as int) as ano", "'N' as regiao", "id + 1 as total_candidatos",
                                      "cast(id as double) as media_geral", "cast(id as double) as media_matematica", "1.0D as pct_escola_publica")
    exact, about = overview_kpis(df).first(), overview_kpis(df, approx=True).first()
    assert exact.asDict().keys() == about.asDict().keys()
    for k, v in exact.asDict().items():
        assert v is None or abs(about[k] - v) <= 0.1 * abs(v) + 1e-9
