import datetime as dt

from pyspark.sql import functions as F

from medallion.functions import (
    band, flag_contains, haversine, map_groups, mean_of, normalized_alias, safe_add, safe_divide,
    safe_subtract, snap_round, surrogate_key, url_host, url_parameter, url_path, weighted_mean, width_bucket,
    intervals_between,
)


def one(spark, expr, schema, data):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_snap_round_ties(spark):
    # 4 scores summing to 2049.3 give a mean of 512.325, an exact decimal tie
    out = one(spark, snap_round(F.col("x") / 4, 2), "x double", [(2049.3,), (2.5,), (-2.5,)])
    assert out == [512.33, 0.63, -0.63]


def test_mean_and_weighted_mean_nulls(spark):
    df = spark.createDataFrame([(600.0, 500.0, 400.0, 700.0, 520.0), (600.0, None, 400.0, 700.0, 520.0)],
                               "a double, b double, c double, d double, r double")
    m = df.select(mean_of(["a", "b", "c", "d"]).alias("m"), "r")
    out = m.select("m", weighted_mean([("m", 4), ("r", 1)]).alias("g")).collect()
    assert out[0]["m"] == 550.0 and out[0]["g"] == 544.0
    assert out[1]["m"] is None and out[1]["g"] is None


def test_band_edges_and_null(spark):
    bands = [(700, "A"), (600, "B"), (500, "C"), (400, "D")]
    out = one(spark, band("x", bands, "E"), "x double",
              [(700.0,), (699.99,), (600.0,), (500.0,), (400.0,), (399.99,), (None,)])
    assert out == ["A", "B", "B", "C", "D", "E", "E"]


def test_flag_and_groups(spark):
    assert one(spark, flag_contains("s", "Pública"), "s string",
               [("Pública Federal",), ("Privada",), (None,)]) == [1, 0, 0]
    groups = {"Baixa": ["Nenhuma", "Até 1 SM"], "Média": ["1-2 SM"]}
    assert one(spark, map_groups("s", groups, "Alta"), "s string",
               [("Nenhuma",), ("1-2 SM",), ("Acima 10 SM",), ("??",), (None,)]) == \
        ["Baixa", "Média", "Alta", "Alta", "Alta"]


def test_safe_arithmetic(spark):
    data = [(1, 2, 3), (None, 2, None), (None, None, None)]
    schema = "a int, b int, c int"
    assert one(spark, safe_add(["a", "b", "c"]), schema, data) == [6, 2, 0]
    assert one(spark, safe_subtract(["a", "b", "c"]), schema, data) == [-4, -2, 0]
    assert one(spark, safe_divide("a", "b"), "a double, b double", [(6.0, 3.0), (1.0, 0.0), (1.0, None)]) == \
        [2.0, None, None]


def test_safe_add_requires_list():
    import pytest
    with pytest.raises(TypeError):
        safe_add("a")


def test_width_bucket_documented_and_compat(spark):
    data = [(12.5,), (-12.5,), (2.5,), (5.0,), (9.99,), (10.0,)]
    doc = one(spark, width_bucket("x", 0.0, 10.0, 4), "x double", data)
    assert doc == [5, 0, 2, 3, 4, 5]
    compat = one(spark, width_bucket("x", 0.0, 10.0, 4, compat=True), "x double", data)
    assert compat[0] == 6 and compat[1] == -4


def test_haversine(spark):
    out = one(spark, F.round(haversine("a", "b", "c", "d", "km"), 0), "a double, b double, c double, d double",
              [(0.0, 0.0, 0.0, 1.0)])
    assert out == [111.0]
    import pytest
    with pytest.raises(ValueError):
        haversine("a", "b", "c", "d", "ft")


def test_urls(spark):
    data = [("https://www.example.com/a/b?x=1&page=2",), ("android-app://m.site.io?utm=3",), ("a.com?x",),
            ("example.com",), ("http://h.org/p#top",), ("https://x.io/?mypage=9",)]
    assert one(spark, url_host("u"), "u string", data) == \
        ["www.example.com", "m.site.io", "a.com", "example.com", "h.org", "x.io"]
    # only http(s):// is stripped for paths, so the app scheme leaves "/" + host
    assert one(spark, url_path("u"), "u string", data) == ["a/b", "/m.site.io", "", "example.com", "p#top", ""]
    assert one(spark, url_parameter("u", "page"), "u string", data) == ["2", None, None, None, None, "9"]
    assert one(spark, url_parameter("u", "page", strict=True), "u string", data)[5] is None


def test_surrogate_key(spark):
    out = spark.createDataFrame([("a", None)], "x string, y string") \
        .select(surrogate_key(["x", "y"]).alias("k"), surrogate_key(["x", "y"], nulls_as_empty=True).alias("l"),
                F.md5(F.lit("a-_dbt_utils_surrogate_key_null_")).alias("ek"), F.md5(F.lit("a-")).alias("el")).first()
    assert out["k"] == out["ek"] and out["l"] == out["el"]


def test_normalized_alias():
    assert normalized_alias("!Hell0 world-hi") == "hell0_world_hi"
    assert normalized_alias("0Hell0 world-hi") == "_0hell0_world_hi"
    assert normalized_alias(None) == "" and normalized_alias("") == ""


def test_intervals_between_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(intervals_between("a", "b", "day").alias("d"), intervals_between("a", "b", "month").alias("m")).first()
    assert r["d"] == 1 and r["m"] == 0
