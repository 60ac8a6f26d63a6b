import pytest
from pyspark.sql import functions as F

from medallion import functions as fn
from medallion.functions.sql import FUNCTIONS, register_functions
from medallion.sources.tables import register_view


@pytest.fixture(scope="module")
def data(spark):
    register_functions(spark)
    df = spark.createDataFrame(
        [(1.5, None, 0.0, 10, "https://a.org/x/y?page=3&ref=b", "u"), (None, None, None, None, None, None), (-2.345, 4.0, 2.0, 3, "b.net?page=", "v"),
         (512.325, 0.0, 40.0, 7, "http://c.com", ""), (1e18, 1.0, 25.0, 1, "android-app://d/e", "w")],
        "a double, b double, c double, n int, url string, t string")
    return register_view("sql_fn_data", df)


PAIRS = {
    "safe_add(a, b, c)": lambda: fn.safe_add(["a", "b", "c"]),
    "safe_subtract(a, b)": lambda: fn.safe_subtract(["a", "b"]),
    "safe_divide(a, c)": lambda: fn.safe_divide("a", "c"),
    "null_if_zero(b)": lambda: fn.null_if_zero("b"),
    "surrogate_key(array(string(n), t))": lambda: fn.surrogate_key(["n", "t"]),
    "surrogate_key(array(string(n), t), '')": lambda: fn.surrogate_key(["n", "t"], nulls_as_empty=True),
    "width_bucket_compat(c, 0, 40, 8)": lambda: fn.width_bucket("c", 0, 40, 8, compat=True),
    "haversine(b, c, c, b)": lambda: fn.haversine("b", "c", "c", "b"),
    "haversine(b, c, c, b, 'km')": lambda: fn.haversine("b", "c", "c", "b", unit="km"),
    "degrees_to_radians(c)": lambda: fn.degrees_to_radians("c"),
    "url_host(url)": lambda: fn.url_host("url"),
    "url_path(url)": lambda: fn.url_path("url"),
    "url_parameter(url, 'page')": lambda: fn.url_parameter("url", "page"),
    "snap_round_2(a)": lambda: fn.snap_round("a", 2),
}


@pytest.mark.parametrize("call", PAIRS)
def test_sql_function_equals_expression(spark, data, call):
    got = [r[0] for r in spark.sql(f"SELECT {call} FROM sql_fn_data ORDER BY a NULLS FIRST").collect()]
    want = [r[0] for r in data.orderBy(F.col("a").asc_nulls_first()).select(PAIRS[call]()).collect()]
    if call.startswith("haversine"):
        got, want = ([-1.0 if x is None else x for x in xs] for xs in (got, want))
        want = pytest.approx(want, rel=1e-12, nan_ok=True)
    assert got == want


def test_calls_are_inlined(spark, data):
    df = spark.sql("SELECT safe_divide(safe_add(a, b), c) AS x, url_host(url) AS h FROM sql_fn_data WHERE null_if_zero(b) > 1")
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert not any(name in plan for name in FUNCTIONS) and "coalesce" in plan and "python" not in plan


def test_unknown_unit_raises(spark, data):
    with pytest.raises(Exception, match="mi or km"):
        spark.sql("SELECT haversine(c, c, c, c, 'yd') FROM sql_fn_data").collect()
