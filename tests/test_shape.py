import pytest
from pyspark.sql import functions as F

from medallion.operators import sets, shape
from medallion.operators.catalog import columns_as_arrays, with_scalar
from medallion.plans.inspect import count_nodes, physical_plan


def test_pivot_counts_and_apostrophe(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "red"), ("M", "red"), ("M", "blue's")],
                               "size string, color string")
    out = {r["size"]: r.asDict() for r in shape.pivot_columns(df, ["size"], "color", ["red", "blue", "blue's"]).collect()}
    assert out["S"]["red"] == 2 and out["S"]["blue"] == 1 and out["S"]["blue's"] == 0
    assert out["M"]["blue's"] == 1
    auto = shape.pivot_columns(df, ["size"], "color", None, prefix="n_", normalize_names=True)
    assert set(auto.columns) == {"size", "n_red", "n_blue", "n_blues"}


def test_pivot_in_blocks_of_columns(spark, tmp_path):
    from medallion.bindings.reshape import q_pivot_wide

    # more users than a pivot has columns, and rows without a user
    ev = spark.range(25_000).selectExpr("CASE WHEN id % 5000 > 0 THEN id % 12000 END AS user_id", "concat('t', id % 3) AS event_type")
    ev.write.parquet(f"{tmp_path}/events.parquet")
    want = ev.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    got = q_pivot_wide(spark, str(tmp_path))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    places = shape.value_places(ev, "user_id", 7).collect()
    assert len({(r["block"], r["place"]) for r in places}) == len(places) == ev.select("user_id").distinct().count()
    assert {r["place"] for r in places} == set(range(7))


def test_unpivot_bool_and_roundtrip(spark):
    df = spark.createDataFrame([(1, True, "x"), (2, False, None)], "Customer_Id int, is_active boolean, name string")
    long = shape.unpivot_columns(df, exclude=["customer_id"], field_name="prop", value_name="val")
    got = sorted(tuple(r) for r in long.collect())
    assert got == [(1, "is_active", "true"), (1, "name", "x"), (2, "is_active", "false"), (2, "name", None)]
    back = shape.pivot_columns(long, ["Customer_Id"], "prop", ["is_active", "name"], agg="max",
                               then_value=F.col("val"), else_value=None)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "true", "x"), (2, "false", None)]
    with pytest.raises(ValueError):
        shape.unpivot_columns(df, exclude=["customer_id"], remove=["IS_ACTIVE", "name"])


def test_deduplicate_keeps_null_rows(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (2, 1, None)], "user_id int, version int, x string")
    out = sorted(tuple(r) for r in shape.deduplicate(df, ["user_id"], [F.col("version").desc()]).collect())
    assert out == [(1, 2, "b"), (2, 1, None)]


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "a")], "id int, name string")
    b = spark.createDataFrame([(2, "blue", 7)], "id bigint, favorite_color string, favorite_number int")
    u = shape.union_relations({"t1": a, "t2": b})
    assert u.columns == ["_dbt_source_relation", "id", "name", "favorite_color", "favorite_number"]
    assert dict(u.dtypes)["id"] == "int"  # first seen type wins
    assert sorted(tuple(r) for r in u.collect()) == [("t1", 1, "a", None, None), ("t2", 2, None, "blue", 7)]
    ex = shape.union_relations([a, b], exclude=["NAME"], source_column=None)
    assert ex.columns == ["id", "favorite_color", "favorite_number"]
    with pytest.raises(ValueError):
        shape.union_relations([a, b], include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        shape.union_relations([a, b], include=["nothing"])


def test_star(spark):
    df = spark.createDataFrame([(1, 2, 3)], "field_1 int, field_2 int, field_3 int")
    assert shape.select_star(df, except_=["FIELD_3"]).columns == ["field_1", "field_2"]
    assert shape.select_star(df, prefix="p_", suffix="_s").columns == ["p_field_1_s", "p_field_2_s", "p_field_3_s"]
    assert shape.select_star(df, except_=["field_1", "field_2", "field_3"]).columns == []
    assert shape.filtered_columns(df, ["Field_2"]) == ["field_1", "field_3"]


def test_empty_to_null(spark):
    df = spark.createDataFrame([("", 1, " ")], "a string, b int, c string")
    r = shape.empty_to_null_table(df).first()
    assert r["a"] is None and r["b"] == 1 and r["c"] == " "


def test_value_counts(spark):
    df = spark.createDataFrame([(c,) for c in "abcdefggggg"], "field string")
    top = shape.value_counts(df, "field", max_records=2).collect()
    assert [(r["value"], r["n"]) for r in top] == [("g", 5), ("a", 1)]
    assert [r["value"] for r in shape.value_counts(df, "field", order_by="value desc").collect()][:2] == ["g", "f"]
    dflt = shape.value_counts(None, "field", default=["x", "y"], spark=spark)
    assert [r["value"] for r in dflt.collect()] == ["x", "y"]
    with pytest.raises(ValueError):
        shape.value_counts(None, "field")


def test_group_by_first_n(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", 3)], "k1 string, k2 string, v int")
    out = sorted(tuple(r) for r in shape.group_by_first_n(df, ["k1", "k2", F.sum("v").alias("s")], 2).collect())
    assert out == [("a", "x", 3), ("b", "y", 3)]


def test_symmetric_difference_strategies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "z")], "k int, v string")
    agg = sorted(tuple(r) for r in sets.symmetric_difference(a, b).collect())
    exc = sorted(tuple(r) for r in sets.symmetric_difference(a, b, strategy="except").collect())
    assert agg == exc == [("a_minus_b", 2, "x"), ("b_minus_a", 3, "z")]
    assert sets.symmetric_difference(a, a).count() == 0


def test_with_scalar_and_arrays(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    q = spark.createDataFrame([(5,)], "v int")
    assert [r["s"] for r in with_scalar(df, q, "s").collect()] == [5, 5]
    empty = q.where("v < 0")
    assert [r["s"] for r in with_scalar(df, empty, "s", default=-1).collect()] == [-1, -1]
    nul = spark.createDataFrame([(None,)], "v int")
    assert [r["s"] for r in with_scalar(df, nul, "s", default=-1).collect()] == [None, None]
    t = spark.createDataFrame([(1, "a", True), (2, None, None), (3, "c", False)], "col_1 int, col_2 string, col_3 boolean")
    r = columns_as_arrays(t, ["col_1", "col_2", "col_3"], ["col_1"]).first()
    assert r["col_1"] == [1, 2, 3] and r["col_2"] == ["a", None, "c"] and r["col_3"] == [True, None, False]


def _cells(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("agg", ["sum", "count", "max", "min", "avg"])
@pytest.mark.parametrize("else_value", [0, None, 5, -2.5])
def test_pivot_strategies_agree(spark, agg, else_value):
    rows = [(g, k, v) for g in ("x", "y", None) for k, v in (("a", 1.5), ("a", None), ("b", 2.0), (None, 4.0), ("z", 8.0))][:-2]
    rows += [("only a", "a", None), ("no v", "q", 1.0)]
    df = spark.createDataFrame(rows, "g string, k string, v double")
    for then in (1, F.col("v"), F.col("v").cast("decimal(10,2)")):
        one, two = (shape.pivot_columns(df, ["g"], "k", ["b", "a", "it's"], agg=agg, then_value=then, else_value=else_value, prefix="n.",
                                  strategy=s) for s in ("conditional", "auto"))
        assert one.dtypes == two.dtypes and _cells(one) == _cells(two), (then, else_value)


def test_pivot_is_two_phase(spark):
    df = spark.range(1000).selectExpr("id % 5 as g", "id % 100 as k")
    wide = shape.pivot_columns(df, ["g"], "k", list(range(100)))
    plan = physical_plan(wide)
    assert "pivotfirst" in plan.lower() and plan.count("CASE WHEN (k") <= 1
    # rows meet as partial cells by (group, value), cells by group
    assert count_nodes(wide, "Exchange") == 2
    assert _cells(wide) == _cells(shape.pivot_columns(df, ["g"], "k", list(range(100)), strategy="conditional"))
    # no group: one row
    assert shape.pivot_columns(df, [], "k", [1, 2]).collect() == shape.pivot_columns(df, [], "k", [1, 2], strategy="conditional").collect()
