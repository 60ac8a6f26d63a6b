import tempfile

import pytest

from medallion.operators.catalog import relations_matching, union_by_prefix, union_matching
from medallion.operators.shape import union_relations
from medallion.plans.inspect import count_nodes


@pytest.fixture()
def databases(spark):
    """Two databases with tables of the same prefix, a view, and a partitioned table."""
    for db in ("cat_one", "cat_two"):
        spark.sql(f"CREATE DATABASE {db} LOCATION '{tempfile.mkdtemp(prefix=db)}'")
    made = {"cat_one.t_1": "a int, s string", "cat_one.t_2": "a int, x double", "cat_two.T_3": "x double, s string", "cat_two.u_1": "a int"}
    for k, (name, ddl) in enumerate(made.items()):
        path = tempfile.mkdtemp(prefix="cat files-")
        row = [7 if "int" in c else 1.5 if "double" in c else f"r{k}" for c in ddl.split(", ")]
        spark.createDataFrame([row, row], ddl).repartition(2).write.mode("overwrite").parquet(path)
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{path}'")
    spark.range(2).selectExpr("cast(id as int) as a").createOrReplaceTempView("t_view")
    yield
    for db in ("cat_one", "cat_two"):
        spark.sql(f"DROP DATABASE {db} CASCADE")
    spark.catalog.dropTempView("t_view")


def test_relations_of_all_databases(spark, databases):
    assert relations_matching(spark, "cat%", "t_%") == ["cat_one.t_1", "cat_one.t_2", "cat_two.t_3"]
    assert relations_matching(spark, "%", "T_%", exclude="%2") == ["cat_one.t_1", "cat_two.t_3", "t_view"]
    assert relations_matching(spark, "CAT_TWO", "%") == ["cat_two.t_3", "cat_two.u_1"]
    assert relations_matching(spark, "nowhere", "%") == []
    assert relations_matching(spark, "%", "t%", kinds=["TEMPORARY"]) == ["t_view"]


def test_union_of_two_databases_is_one_scan(spark, databases):
    df = union_matching(spark, "cat%", "t%", source_column="src")
    want = union_relations({n: spark.table(n) for n in ("cat_one.t_1", "cat_one.t_2", "cat_two.t_3")}, source_column="src")
    assert count_nodes(df, "FileScan") == 1 and count_nodes(want, "FileScan") == 3 and count_nodes(df, "Union") == 0
    assert df.dtypes == want.dtypes and sorted(map(str, df.collect())) == sorted(map(str, want.collect())) and df.count() == 6


def test_views_join_the_scan(spark, databases):
    kw = dict(exclude="u%", where="a is not null", column_override={"a": "bigint"}, source_column="src")
    df = union_by_prefix(spark, "%", "t_", **kw)
    kw.pop("exclude")
    want = union_relations({n: spark.table(n) for n in ("cat_one.t_1", "cat_one.t_2", "cat_two.t_3", "t_view")
                            if n != "cat_two.t_3"}, **kw)
    assert count_nodes(df, "FileScan") == 1
    assert sorted(df.columns) == sorted(want.columns) and dict(df.dtypes)["a"] == "bigint"
    assert sorted(map(str, df.select("src", "a").collect())) == sorted(map(str, want.select("src", "a").collect()))
    assert union_matching(spark, "cat_one", "t%", include=["A"], source_column=None).columns == ["a"]
    with pytest.raises(ValueError):
        union_matching(spark, "nowhere", "%")


def test_types_that_differ_take_the_union(spark, databases):
    path = tempfile.mkdtemp(prefix="cat-")
    spark.createDataFrame([(2**40,)], "a bigint").write.mode("overwrite").parquet(path)
    spark.sql(f"CREATE TABLE cat_two.t_4 (a bigint) USING parquet LOCATION '{path}'")
    df = union_matching(spark, "cat%", "t%", column_override={"a": "bigint"}, source_column="src")
    assert count_nodes(df, "FileScan") == 2
    assert {r.a for r in df.collect()} == {7, None, 2**40}
