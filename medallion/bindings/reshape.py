"""Reshaping, set, series and catalog queries (R1–R4, U1–U3, P8–P11, A10, A12,
G1–G3, D1–D4) on the driver's tables."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import functions as F

from medallion.bindings.common import table
from medallion.operators import catalog, sets, shape
from medallion.operators.series import date_spine_over, generate_series
from medallion.functions import intervals_between, rounded_avg
from medallion.session import ntz_literal

# Part types of the test tables (pivot columns).
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus"]


def q_pivot_types(spark, d):
    return shape.pivot_columns(table(spark, d, "part"), ["p_brand"], "p_type", PART_TYPES,
                               prefix="n_", normalize_names=True)


def q_pivot_types_auto(spark, d):
    # values taken from the data (bounded distinct pass), most frequent first
    return shape.pivot_columns(table(spark, d, "part"), ["p_brand"], "p_type", None,
                               agg="max", then_value=F.col("p_retailprice"), else_value=None,
                               suffix="_max_price")


def q_pivot_cmp(spark, d):
    return shape.pivot_columns(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity",
                               [10, 25, 40], cmp=">=", prefix="qty_ge_")


def q_unpivot_orders(spark, d):
    o = table(spark, d, "orders").withColumn("is_urgent", F.col("o_orderpriority") == "1-URGENT")
    return shape.unpivot_columns(o, exclude=["o_orderkey"], remove=["o_totalprice", "O_ORDERDATE"],
                                 field_name="prop", value_name="val")


def q_dedupe_lineitem(spark, d):
    li = table(spark, d, "lineitem")
    order = [F.col("l_shipdate").desc()] + [F.col(c) for c in LI_ORDER[1:]]
    return shape.deduplicate(li, ["l_orderkey", "l_linenumber"], order)


def _union_inputs(spark, d):
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                              F.col("c_nationkey").alias("nation"))
    supp = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("Name"),
                                              F.col("s_acctbal").alias("balance"),
                                              F.col("s_nationkey").alias("nation"))
    return {"customer": cust, "supplier": supp}


def q_union_by_name(spark, d):
    return shape.union_relations(_union_inputs(spark, d))


def q_union_exclude(spark, d):
    return shape.union_relations(_union_inputs(spark, d), exclude=["NAME"], source_column=None,
                                 column_override={"nation": "bigint"}, where="nation < 10")


def q_star_except(spark, d):
    return shape.select_star(table(spark, d, "lineitem"), except_=["L_SHIPDATE", "l_comment"],
                             prefix="li_", suffix="_v")


def q_empty_to_null(spark, d):
    pages = table(spark, d, "pages").select(
        "page_id", F.split_part("url", F.lit("?"), F.lit(2)).alias("query"),
        F.split_part("url", F.lit("#"), F.lit(2)).alias("fragment"), F.length("html").alias("html_len"))
    return shape.empty_to_null_table(pages)


def q_value_counts(spark, d):
    return shape.value_counts(table(spark, d, "orders"), "o_orderpriority", where="o_orderstatus = 'F'")


def q_value_counts_top(spark, d):
    # a top-N report: the limit is the feature; ties broken by value
    return shape.top_values(table(spark, d, "customer"), "c_nationkey", 5)


def q_group_first_n(spark, d):
    li = table(spark, d, "lineitem")
    return shape.group_by_first_n(li, [
        "l_returnflag", "l_linestatus",
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("sum_qty"),
        F.count(F.lit(1)).alias("n_lines")], 2)


def _set_inputs(spark, d):
    o = table(spark, d, "orders")
    a = o.where(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderpriority")
    b = o.where(F.year("o_orderdate") >= 1998).select("o_custkey", "o_orderpriority")
    return a, b


def q_except_distinct(spark, d):
    a, b = _set_inputs(spark, d)
    return sets.except_distinct(a, b)


def q_symdiff(strategy):
    def q(spark, d):
        a, b = _set_inputs(spark, d)
        return sets.symmetric_difference(a, b, strategy=strategy)
    return q


def q_normalize_names(spark, d):
    pivoted = shape.pivot_columns(table(spark, d, "conversations"), ["conv_id"], "role",
                                  ["user", "assistant", "system"], prefix="Turns By-", suffix=" Role")
    return shape.normalize_column_names(pivoted)


def q_series_histogram(spark, d):
    per_cust = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    n = per_cust.agg(F.max("n_orders")).first()[0] or 1
    counts = per_cust.groupBy("n_orders").agg(F.count(F.lit(1)).alias("n_customers"))
    series = generate_series(spark, n)
    return (series.join(counts, series.generated_number == counts.n_orders, "left")
                  .select("generated_number", F.coalesce("n_customers", F.lit(0)).alias("n_customers")))


def q_spine_day(spark, d):
    ev = table(spark, d, "events")
    spine = date_spine_over(ev, "ts", "day")
    per_day = ev.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_events"))
    return (spine.join(per_day, spine.date_day == per_day.day, "left")
                 .select("date_day", F.coalesce("n_events", F.lit(0)).alias("n_events")))


def q_spine_month(spark, d):
    o = table(spark, d, "orders")
    spine = date_spine_over(o, "o_orderdate", "month")
    per = o.groupBy(F.trunc("o_orderdate", "month").alias("m")).agg(F.count(F.lit(1)).alias("n_orders"))
    return (spine.join(per, spine.date_month == per.m, "left")
                 .select("date_month", F.coalesce("n_orders", F.lit(0)).alias("n_orders")))


def q_intervals(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber",
                    intervals_between("o_orderdate", "l_shipdate", "day").alias("days"),
                    intervals_between("o_orderdate", "l_shipdate", "week").cast("bigint").alias("weeks"),
                    intervals_between("o_orderdate", "l_shipdate", "month").alias("months"),
                    intervals_between("o_orderdate", "l_shipdate", "year").alias("years"))


def q_with_scalar(spark, d):
    o = table(spark, d, "orders")
    avg_price = o.agg(F.max("o_totalprice"))
    return catalog.with_scalar(o.select("o_orderkey", "o_totalprice"), avg_price, "max_price") \
                  .select("o_orderkey", (F.col("o_totalprice") / F.col("max_price")).alias("share_of_max"))


def q_with_scalar_default(spark, d):
    o = table(spark, d, "orders")
    none = o.where(F.col("o_totalprice") < 0).select("o_totalprice")
    return catalog.with_scalar(o.select("o_orderkey"), none, "neg_price", default=-1.0)


def q_columns_as_arrays(spark, d):
    li = table(spark, d, "lineitem").withColumn(
        "l_flag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    return catalog.columns_as_arrays(li, ["l_linenumber", "l_quantity", "l_flag"],
                                     ["l_linenumber", "l_partkey", "l_suppkey"], by=["l_orderkey"])


def _register_daily(spark, d):
    """One temp view per day of the events table (``events_YYYYMMDD``) — every
    day, so the union covers the whole table; odd days carry ``value`` instead
    of ``event_type`` so the unions have different column sets to align."""
    ev = table(spark, d, "events")
    days = [r["day"] for r in ev.select(F.to_date("ts").alias("day")).distinct().collect()]  # one row per calendar day
    names = ["events_all_days"]
    for day in days:
        cols = ["user_id", "event_type", "ts"] if day.day % 2 == 0 else ["user_id", "value", "ts"]
        start, end = (datetime.combine(day, time()) + timedelta(days=n) for n in (0, 1))
        # a range of ts reaches the scan as a pushed filter
        one = ev.where((F.col("ts") >= ntz_literal(start).cast(ev.schema["ts"].dataType))
                       & (F.col("ts") < ntz_literal(end).cast(ev.schema["ts"].dataType)))
        names.append("events_" + day.strftime("%Y%m%d"))
        one.select(*cols).createOrReplaceTempView(names[-1])
    ev.select("user_id").createOrReplaceTempView(names[0])
    return names


def _over_daily(spark, d, build):
    """``build()`` over the day views, which are gone afterwards."""
    names = _register_daily(spark, d)
    try:
        return build()
    finally:
        for n in names:
            spark.catalog.dropTempView(n)


def q_union_by_prefix(spark, d):
    return _over_daily(spark, d, lambda: catalog.union_by_prefix(spark, "%", "events_2", exclude="%_all_%"))


def q_union_matching(spark, d):
    return _over_daily(spark, d, lambda: catalog.union_matching(spark, "%", "EVENTS_20______", source_column="src",
                                                                include=["user_id", "TS"]))


def q_pivot_wide(spark, d, width=1000):
    """One column per user of the events table, as many as there are, in blocks of ``width``."""
    ev = table(spark, d, "events").select("event_type", "user_id")
    users = shape.value_places(ev, "user_id", width)
    placed = ev.join(users, F.col("user_id").eqNullSafe(F.col("value"))).select("event_type", "block", "place")
    wide = shape.pivot_columns(placed, ["event_type", "block"], "place", range(width), prefix="u_")
    cells = wide.select("event_type", "block", F.posexplode(F.array(*[F.col(c) for c in wide.columns[2:]])).alias("place", "n"))
    return cells.filter("n > 0").join(users, ["block", "place"]).select("event_type", F.col("value").alias("user_id"), "n")


def q_avg_many_decimals(spark, d):
    li = table(spark, d, "lineitem").withColumn("x", F.col("l_extendedprice") / 7)
    return li.groupBy("l_returnflag").agg(rounded_avg("x", 4).alias("avg_x"))


QUERIES = {
    "pivot_wide": q_pivot_wide,
    "avg_many_decimals": q_avg_many_decimals,
    "pivot_types": q_pivot_types,
    "pivot_types_auto": q_pivot_types_auto,
    "pivot_cmp": q_pivot_cmp,
    "unpivot_orders": q_unpivot_orders,
    "dedupe_lineitem": q_dedupe_lineitem,
    "union_by_name": q_union_by_name,
    "union_exclude": q_union_exclude,
    "star_except": q_star_except,
    "empty_to_null": q_empty_to_null,
    "value_counts": q_value_counts,
    "value_counts_top": q_value_counts_top,
    "group_first_n": q_group_first_n,
    "except_distinct": q_except_distinct,
    "symdiff_aggregate": q_symdiff("aggregate"),
    "symdiff_except": q_symdiff("except"),
    "normalize_names": q_normalize_names,
    "series_histogram": q_series_histogram,
    "spine_day": q_spine_day,
    "spine_month": q_spine_month,
    "intervals": q_intervals,
    "with_scalar": q_with_scalar,
    "with_scalar_default": q_with_scalar_default,
    "columns_as_arrays": q_columns_as_arrays,
    "union_by_prefix": q_union_by_prefix,
    "union_matching": q_union_matching,
}

_pt = ", ".join(f"CAST(SUM(CASE WHEN p_type = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{v.lower()}"
                for v in PART_TYPES)
_pta = ", ".join(f"MAX(CASE WHEN p_type = '{v}' THEN p_retailprice ELSE NULL END) AS \"{v}_max_price\""
                 for v in PART_TYPES)
_pc = ", ".join(f"CAST(SUM(CASE WHEN l_quantity >= {v} THEN 1 ELSE 0 END) AS BIGINT) AS qty_ge_{v}"
                for v in (10, 25, 40))
_set_a = "SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'"
_set_b = "SELECT o_custkey, o_orderpriority FROM orders WHERE year(o_orderdate) >= 1998"
_li_cols = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
            "l_tax, l_returnflag, l_linestatus, l_shipdate")

ORACLE = {
    "pivot_types": f"SELECT p_brand, {_pt} FROM part GROUP BY p_brand",
    "pivot_types_auto": f"SELECT p_brand, {_pta} FROM part GROUP BY p_brand",
    "pivot_cmp": f"SELECT l_returnflag, l_linestatus, {_pc} FROM lineitem GROUP BY 1, 2",
    "unpivot_orders": """
        SELECT o_orderkey, 'o_custkey' AS prop, CAST(o_custkey AS VARCHAR) AS val FROM orders
        UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus FROM orders
        UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders
        UNION ALL SELECT o_orderkey, 'is_urgent', CAST(o_orderpriority = '1-URGENT' AS VARCHAR) FROM orders""",
    "dedupe_lineitem": f"""SELECT {_li_cols} FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
    "union_by_name": """
        SELECT 'customer' AS _dbt_source_relation, c_custkey AS id, c_name AS name, c_nationkey AS nation,
               CAST(NULL AS DOUBLE) AS balance FROM customer
        UNION ALL
        SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
    "union_exclude": """
        SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation, CAST(NULL AS DOUBLE) AS balance
        FROM customer WHERE c_nationkey < 10
        UNION ALL SELECT s_suppkey, CAST(s_nationkey AS BIGINT), s_acctbal FROM supplier WHERE s_nationkey < 10""",
    "star_except": """SELECT l_orderkey AS li_l_orderkey_v, l_partkey AS li_l_partkey_v,
        l_suppkey AS li_l_suppkey_v, l_linenumber AS li_l_linenumber_v, l_quantity AS li_l_quantity_v,
        l_extendedprice AS li_l_extendedprice_v, l_discount AS li_l_discount_v, l_tax AS li_l_tax_v,
        l_returnflag AS li_l_returnflag_v, l_linestatus AS li_l_linestatus_v FROM lineitem""",
    "empty_to_null": """SELECT page_id, NULLIF(split_part(url, '?', 2), '') AS query,
        NULLIF(split_part(url, '#', 2), '') AS fragment, CAST(length(html) AS INTEGER) AS html_len FROM pages""",
    "value_counts": """SELECT o_orderpriority AS value, COUNT(*) AS n FROM orders
        WHERE o_orderstatus = 'F' GROUP BY 1""",
    "value_counts_top": """SELECT c_nationkey AS value, COUNT(*) AS n FROM customer GROUP BY 1
        ORDER BY n DESC, value ASC NULLS FIRST LIMIT 5""",
    "group_first_n": """SELECT l_returnflag, l_linestatus,
        CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, COUNT(*) AS n_lines
        FROM lineitem GROUP BY 1, 2""",
    "except_distinct": f"{_set_a} EXCEPT {_set_b}",
    "symdiff_aggregate": f"""SELECT 'a_minus_b' AS which_diff, * FROM ({_set_a} EXCEPT {_set_b})
        UNION ALL SELECT 'b_minus_a', * FROM ({_set_b} EXCEPT {_set_a})""",
    "symdiff_except": f"""SELECT 'a_minus_b' AS which_diff, * FROM ({_set_a} EXCEPT {_set_b})
        UNION ALL SELECT 'b_minus_a', * FROM ({_set_b} EXCEPT {_set_a})""",
    "normalize_names": """SELECT conv_id,
        CAST(SUM(CASE WHEN role = 'user' THEN 1 ELSE 0 END) AS BIGINT) AS turns_by_user_role,
        CAST(SUM(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) AS BIGINT) AS turns_by_assistant_role,
        CAST(SUM(CASE WHEN role = 'system' THEN 1 ELSE 0 END) AS BIGINT) AS turns_by_system_role
        FROM conversations GROUP BY conv_id""",
    "series_histogram": """WITH pc AS (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY 1),
        c AS (SELECT n_orders, COUNT(*) AS n_customers FROM pc GROUP BY 1)
        SELECT s.generated_number, COALESCE(c.n_customers, 0) AS n_customers
        FROM (SELECT range AS generated_number FROM range(1, (SELECT max(n_orders) FROM pc) + 1)) s
        LEFT JOIN c ON s.generated_number = c.n_orders""",
    "spine_day": """WITH b AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events),
        s AS (SELECT CAST(g AS DATE) AS date_day FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g)),
        p AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1)
        SELECT date_day, COALESCE(n, 0) AS n_events FROM s LEFT JOIN p ON s.date_day = p.day""",
    "spine_month": """WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS lo,
            date_trunc('month', max(o_orderdate)) AS hi FROM orders),
        s AS (SELECT CAST(g AS DATE) AS date_month FROM b, generate_series(b.lo, b.hi, INTERVAL 1 MONTH) t(g)),
        p AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, COUNT(*) AS n FROM orders GROUP BY 1)
        SELECT date_month, COALESCE(n, 0) AS n_orders FROM s LEFT JOIN p ON s.date_month = p.m""",
    "intervals": """SELECT l_orderkey, l_linenumber,
        date_diff('day', date_trunc('day', o_orderdate), date_trunc('day', l_shipdate)) AS days,
        CAST(floor(date_diff('day', date_trunc('week', o_orderdate), date_trunc('week', l_shipdate)) / 7)
             AS BIGINT) AS weeks,
        date_diff('month', date_trunc('month', o_orderdate), date_trunc('month', l_shipdate)) AS months,
        date_diff('year', date_trunc('year', o_orderdate), date_trunc('year', l_shipdate)) AS years
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "with_scalar": """SELECT o_orderkey, o_totalprice / (SELECT max(o_totalprice) FROM orders) AS share_of_max
        FROM orders""",
    "with_scalar_default": """SELECT o_orderkey, COALESCE((SELECT o_totalprice FROM orders
        WHERE o_totalprice < 0 LIMIT 1), -1.0) AS neg_price FROM orders""",
    "columns_as_arrays": """WITH li AS (SELECT *, CASE WHEN l_returnflag != 'N' THEN l_returnflag END AS l_flag
            FROM lineitem)
        SELECT l_orderkey,
        list(l_linenumber ORDER BY l_linenumber, l_partkey, l_suppkey, l_linenumber, l_quantity,
             l_flag NULLS FIRST) AS l_linenumber,
        list(l_quantity ORDER BY l_linenumber, l_partkey, l_suppkey, l_linenumber, l_quantity,
             l_flag NULLS FIRST) AS l_quantity,
        list(l_flag ORDER BY l_linenumber, l_partkey, l_suppkey, l_linenumber, l_quantity,
             l_flag NULLS FIRST) AS l_flag
        FROM li GROUP BY l_orderkey""",
    "union_by_prefix": """SELECT 'events_' || strftime(ts, '%Y%m%d') AS _dbt_source_relation, user_id,
        CASE WHEN day(ts) % 2 = 0 THEN event_type END AS event_type, ts,
        CASE WHEN day(ts) % 2 = 1 THEN value END AS value FROM events""",
    "union_matching": """SELECT 'events_' || strftime(ts, '%Y%m%d') AS src, user_id, ts FROM events""",
    "pivot_wide": "SELECT event_type, user_id, CAST(COUNT(*) AS BIGINT) AS n FROM events GROUP BY 1, 2",
    "avg_many_decimals": "SELECT l_returnflag, ROUND(AVG(l_extendedprice / 7), 4) AS avg_x FROM lineitem GROUP BY 1",
}
