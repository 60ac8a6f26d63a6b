"""Plan-shape tests: the properties the scale design relies on."""

import random
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from medallion.bindings import registry
from medallion.bindings.common import table
from medallion.operators import checks as C
from medallion.operators import shape
from medallion.operators.silver import percent_rank_pct
from medallion.plans.inspect import physical_plan, uses_python
from medallion.plans.ranged import ranged_prefix_sum, ranged_shift
from medallion.sources.tables import read_partition_pruned, write_partitioned


def plan(df):
    return physical_plan(df)


def test_partition_filter_reaches_scan(spark, sf001):
    path = tempfile.mkdtemp(prefix="prune-") + "/t"
    write_partitioned(table(spark, sf001, "orders").withColumn("y", F.year("o_orderdate")), path, ["y"])
    p = plan(read_partition_pruned(spark, path, y=1997).select("o_orderkey"))
    assert "PartitionFilters: [isnotnull(y" in p and "(y#" in p
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


def test_filter_and_columns_pushed(spark, sf001):
    df = table(spark, sf001, "lineitem").where(F.col("l_quantity") > 10).select("l_orderkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def test_anti_join_and_top1(spark, sf001):
    li = table(spark, sf001, "lineitem")
    rel = C.relationships_where(li, "l_suppkey", table(spark, sf001, "supplier"), "s_suppkey").failing_rows()
    assert "LeftAnti" in plan(rel)
    dd = shape.deduplicate(li, ["l_orderkey"], [F.col("l_shipdate").desc(), "l_linenumber", "l_partkey"])
    p = plan(dd)
    # the limit runs before the shuffle too, so a hot key ships one row per map task
    assert p.count("WindowGroupLimit") >= 2 or "Partial" in p


def test_unpivot_is_one_scan(spark, sf001):
    o = table(spark, sf001, "orders")
    p = plan(shape.unpivot_columns(o, exclude=["o_orderkey"]))
    assert p.count("FileScan parquet") == 1 and "Expand" in p


def test_histogram_percent_rank_has_no_row_window(spark, sf001):
    li = table(spark, sf001, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    p = plan(percent_rank_pct(li, ["l_returnflag"], "l_quantity", "p"))
    assert "percent_rank" not in p and "HashAggregate" in p
    w = plan(percent_rank_pct(li, ["l_returnflag"], "l_quantity", "p", strategy="window"))
    assert "percent_rank" in w


def test_no_python_udfs_in_registered_queries(spark, sf001):
    import medallion.bindings.history as hist
    skip = set(hist.QUERIES)  # those write tables while building; covered by their own tests
    for name, q in registry.queries().items():
        if name in skip:
            continue
        assert not uses_python(q(spark, sf001)), name


def test_ranged_shift_equals_global_window(spark):
    rnd = random.Random(3)
    data = [(rnd.choice([None, 1, 2, 2, 2, 3, 5, 8, 8, 13] + list(range(20, 60))), rnd.randint(0, 3))
            for _ in range(2000)]
    df = spark.createDataFrame(data, "k int, g int")
    plain = df.withColumn("p", F.lag("k").over(Window.orderBy(F.col("k").asc_nulls_first())))
    got = ranged_shift(df, "k", ["k"], "p", "lag", n_buckets=7)
    assert sorted(map(tuple, plain.select("k", "p").collect()), key=str) == \
        sorted(map(tuple, got.select("k", "p").collect()), key=str)
    plain_g = df.withColumn("p", F.lead("k").over(Window.partitionBy("g").orderBy(F.col("k").asc_nulls_first())))
    got_g = ranged_shift(df, "k", ["k"], "p", "lead", ["g"], n_buckets=5)
    assert sorted(map(tuple, plain_g.select("g", "k", "p").collect()), key=str) == \
        sorted(map(tuple, got_g.select("g", "k", "p").collect()), key=str)
    # the bucketed plan has no single-partition window over the rows
    assert "SinglePartition" not in plan(got.select("k", "p")) or "_rng_val" in plan(got)


def test_ranged_prefix_sum(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "k int, w int")
    got = {r["k"]: r["s"] for r in ranged_prefix_sum(df, "w", "k", "s", n_buckets=6).collect()}
    run = 0
    for i in range(100):
        assert got[i] == run
        run += i % 3


def test_ranged_shift_other_value_column(spark):
    rnd = random.Random(5)
    keys = rnd.sample(range(100000), 1500)
    df = spark.createDataFrame([(k, rnd.choice([None, "x", "y", "z"])) for k in keys], "k int, v string")
    for direction, fn in (("lag", F.lag), ("lead", F.lead)):
        plain = df.withColumn("p", fn("v").over(Window.orderBy("k")))
        got = ranged_shift(df, "v", ["k"], "p", direction, n_buckets=6, exists_col="e")
        assert sorted(map(tuple, plain.select("k", "p").collect()), key=str) == \
            sorted(map(tuple, got.select("k", "p").collect()), key=str)
        flags = {r["k"]: r["e"] for r in got.collect()}
        assert flags[min(keys) if direction == "lag" else max(keys)] is False
        assert sum(1 for f in flags.values() if not f) == 1


def test_rank_table_broadcast_by_aqe_at_runtime(spark, sf001):
    """The rank table is joined back by a broadcast chosen by AQE from its
    measured size (no static hint)."""
    from medallion.bindings.tiers import silver
    from medallion.operators.silver import national_percentile
    df = national_percentile(silver(spark, sf001))
    df.collect()
    p = physical_plan(df)
    assert "isFinalPlan=true" in p and "percent_rank" not in p
    top = [ln for ln in p.splitlines() if "Join" in ln][0]
    assert "BroadcastHashJoin" in top


def test_ranged_shift_composite_order_spreads_hot_leading_key(spark):
    rnd = random.Random(11)
    data = [(5 if rnd.random() < 0.5 else rnd.randint(0, 40), rnd.choice([None] + list(range(100))))
            for _ in range(3000)]
    df = spark.createDataFrame(data, "lo int, hi int")
    w = Window.orderBy(F.col("lo").asc_nulls_first(), F.col("hi").asc_nulls_first())
    plain = df.withColumn("p", F.lead("lo").over(w))
    got = ranged_shift(df, "lo", ["lo", "hi"], "p", "lead", n_buckets=8)
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, got.select("lo", "hi", "p").collect()), key=str)
    # the hot value 5 is cut into several buckets instead of one
    from medallion.plans.ranged import add_range_bucket
    b = add_range_bucket(df, ["lo", "hi"], 8)
    assert b.where("lo = 5").select("_rng_bucket").distinct().count() > 1


def test_ranged_shift_grouped_composite_hot_key(spark):
    rnd = random.Random(13)
    data = []
    for _ in range(3000):
        g = 0 if rnd.random() < 0.6 else rnd.randint(1, 20)
        lo = 5 if (g == 0 and rnd.random() < 0.5) else rnd.randint(0, 40)
        data.append((g, lo, rnd.choice([None] + list(range(60)))))
    df = spark.createDataFrame(data, "g int, lo int, hi int")
    w = Window.partitionBy("g").orderBy(F.col("lo").asc_nulls_first(), F.col("hi").asc_nulls_first())
    plain = df.withColumn("p", F.lead("lo").over(w))
    got = ranged_shift(df, "lo", ["lo", "hi"], "p", "lead", ["g"], n_buckets=6)
    assert sorted(map(tuple, plain.collect()), key=str) == \
        sorted(map(tuple, got.select("g", "lo", "hi", "p").collect()), key=str)
    from medallion.plans.ranged import add_range_bucket
    b = add_range_bucket(df, ["lo", "hi"], 6, ["g"])
    assert b.where("g = 0 AND lo = 5").select("_rng_bucket").distinct().count() > 1


def test_range_buckets_are_even_and_exact_beyond_doubles(spark):
    """NULLs, a hot value and keys a double cannot tell apart."""
    df = spark.range(4000).select(F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 == 1, F.lit(7))
                                  .otherwise(F.col("id") + 2**60).alias("k"), F.col("id").alias("x"))
    from medallion.plans.ranged import add_range_bucket
    sizes = [r["count"] for r in add_range_bucket(df, "k", 8).groupBy("_rng_bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8
    lag = sorted((r["k"], r["p"]) for r in ranged_shift(df.where("k > 7"), "k", ["k"], "p", n_buckets=8).collect() if r["p"])
    keys = sorted(r["k"] for r in df.where("k > 7").collect())
    assert lag == list(zip(keys[1:], keys))
