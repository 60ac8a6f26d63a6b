"""Scalar-expression queries (E1–E10) on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from medallion.bindings.common import snap_sql, table
from medallion.functions import (
    haversine, safe_add, safe_divide, safe_subtract, snap_round, surrogate_key, url_host,
    url_parameter, url_path, width_bucket,
)


def _li(spark, d):
    # zero discounts / taxes become NULL so the null rules are exercised
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
        F.nullif("l_discount", F.lit(0.0)).alias("disc"), F.nullif("l_tax", F.lit(0.0)).alias("tax"))


def q_safe_add(spark, d):
    return _li(spark, d).select("l_orderkey", "l_linenumber",
                                safe_add(["disc", "tax", "l_quantity"]).alias("safe_add"))


def q_safe_subtract(spark, d):
    return _li(spark, d).select("l_orderkey", "l_linenumber",
                                safe_subtract(["l_quantity", "disc", "tax"]).alias("safe_subtract"))


def q_safe_divide(spark, d):
    li = _li(spark, d)
    return li.select("l_orderkey", "l_linenumber",
                     safe_divide("l_extendedprice", "disc").alias("price_per_disc"),
                     safe_divide(F.col("l_extendedprice") * F.col("l_quantity"),
                                 F.col("disc") - F.col("tax")).alias("expr_ratio"))


def q_surrogate_key(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     surrogate_key(["l_orderkey", "l_linenumber",
                                    F.nullif("l_returnflag", F.lit("N"))]).alias("sk"),
                     surrogate_key(["l_orderkey", F.nullif("l_linestatus", F.lit("O"))],
                                   nulls_as_empty=True).alias("sk_legacy"))


def q_width_bucket(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     width_bucket("l_extendedprice", 0, 100000, 10).alias("price_bucket"),
                     width_bucket("l_quantity", 10, 40, 6).alias("qty_bucket"))


def q_width_bucket_compat(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     width_bucket("l_quantity", 0, 40, 8, compat=True).alias("qty_bucket"))


def _geo(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    # customer point from balance and nation; region hub from the region key
    return j.select("c_custkey",
                    (F.col("c_acctbal") / 10000 * 90).alias("lat1"),
                    (F.col("c_nationkey") * 14.4 - 180).alias("lon1"),
                    (F.col("r_regionkey") * 30 - 60).cast("double").alias("lat2"),
                    (F.col("r_regionkey") * 72 - 144).cast("double").alias("lon2"))


def q_haversine(spark, d):
    g = _geo(spark, d)
    return g.select("c_custkey",
                    snap_round(haversine("lat1", "lon1", "lat2", "lon2"), 4).alias("dist_mi"),
                    snap_round(haversine("lat1", "lon1", "lat2", "lon2", unit="km"), 4).alias("dist_km"))


def q_url_parts(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", url_host("url").alias("host"), url_path("url").alias("path"),
                    url_parameter("url", "page").alias("page"), url_parameter("url", "ref").alias("ref"))


QUERIES = {
    "safe_add": q_safe_add,
    "safe_subtract": q_safe_subtract,
    "safe_divide": q_safe_divide,
    "surrogate_key": q_surrogate_key,
    "width_bucket": q_width_bucket,
    "width_bucket_compat": q_width_bucket_compat,
    "haversine": q_haversine,
    "url_parts": q_url_parts,
}

_LI = """(SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
    NULLIF(l_discount, 0.0) AS disc, NULLIF(l_tax, 0.0) AS tax FROM lineitem) li"""


def _wb(x, lo, hi, n):
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < {lo} THEN CAST(0 AS BIGINT) "
            f"WHEN {x} >= {hi} THEN CAST({n} + 1 AS BIGINT) "
            f"ELSE CAST(floor({n} * ({x} - {lo}) / ({hi} - {lo})) AS BIGINT) + 1 END")


def _hav(unit_rate):
    core = ("2 * 3961 * asin(sqrt(power(sin(radians((lat2 - lat1) / 2)), 2) + "
            "cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians((lon2 - lon1) / 2)), 2)))")
    return snap_sql(core if unit_rate == 1 else f"{core} * {unit_rate}", 4)


_GEO = """(SELECT c_custkey, c_acctbal / 10000 * 90 AS lat1, c_nationkey * 14.4 - 180 AS lon1,
    CAST(r_regionkey * 30 - 60 AS DOUBLE) AS lat2, CAST(r_regionkey * 72 - 144 AS DOUBLE) AS lon2
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) g"""

_HOST = ("split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), "
         "'https://', ''), '/', 1), '?', 1)")
_STRIP = "replace(replace(url, 'http://', ''), 'https://', '')"
_PATH = (f"split_part(right({_STRIP}, CAST(length({_STRIP}) - coalesce(nullif(strpos({_STRIP}, '/'), 0), "
         f"strpos({_STRIP}, '?') - 1) AS BIGINT)), '?', 1)")


def _param(name):
    return f"nullif(split_part(split_part(url, '{name}=', 2), '&', 1), '')"


ORACLE = {
    "safe_add": f"""SELECT l_orderkey, l_linenumber,
        coalesce(disc, 0) + coalesce(tax, 0) + coalesce(l_quantity, 0) AS safe_add FROM {_LI}""",
    "safe_subtract": f"""SELECT l_orderkey, l_linenumber,
        coalesce(l_quantity, 0) - coalesce(disc, 0) - coalesce(tax, 0) AS safe_subtract FROM {_LI}""",
    "safe_divide": f"""SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(disc, 0) AS price_per_disc,
        (l_extendedprice * l_quantity) / NULLIF(disc - tax, 0) AS expr_ratio FROM {_LI}""",
    "surrogate_key": """SELECT l_orderkey, l_linenumber,
        md5(concat_ws('-', coalesce(CAST(l_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
            coalesce(CAST(l_linenumber AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
            coalesce(NULLIF(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_'))) AS sk,
        md5(concat_ws('-', coalesce(CAST(l_orderkey AS VARCHAR), ''),
            coalesce(NULLIF(l_linestatus, 'O'), ''))) AS sk_legacy FROM lineitem""",
    "width_bucket": f"""SELECT l_orderkey, l_linenumber, {_wb('l_extendedprice', 0, 100000, 10)} AS price_bucket,
        {_wb('l_quantity', 10, 40, 6)} AS qty_bucket FROM lineitem""",
    "width_bucket_compat": """SELECT l_orderkey, l_linenumber,
        CASE WHEN CAST(l_quantity AS DECIMAL(28,6)) % CAST((40 - 0) / 8 AS DECIMAL(28,6)) = 0 THEN 1 ELSE 0 END
        + least(CAST(ceil((l_quantity - 0) / ((40 - 0) / 8)) AS BIGINT), 8 + 1) AS qty_bucket FROM lineitem""",
    "haversine": f"SELECT c_custkey, {_hav(1)} AS dist_mi, {_hav(1.60934)} AS dist_km FROM {_GEO}",
    "url_parts": f"""SELECT page_id, {_HOST} AS host, {_PATH} AS path, {_param('page')} AS page,
        {_param('ref')} AS ref FROM pages""",
}
