"""Check queries (C1–C22): each returns the check's failing rows on the
driver's tables; inputs are chosen so that some checks pass (no rows) and some
fail."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from medallion import jobs
from medallion.bindings.common import table
from medallion.bindings.scored import SCORED_SQL, scored
from medallion.bindings.tiers import GOLD_INCOME_SQL, GOLD_UF_SQL, GOLD_YOY_SQL, _W, silver_pct
from medallion.functions import snap_round
from medallion.operators import checks as C
from medallion.session import checkpointed

AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)


def _t(name):
    return lambda s, d: table(s, d, name)


def q_not_null(s, d):
    return C.not_null(scored(s, d), "nu_nota_cn").failing_rows()


def q_accepted_values(s, d):
    return C.accepted_values(table(s, d, "orders"), "o_orderpriority",
                             ["1-URGENT", "2-HIGH", "3-MEDIUM"]).failing_rows()


def q_unique(s, d):
    return C.unique(table(s, d, "orders"), "o_custkey").failing_rows()


def q_accepted_range(s, d):
    return C.accepted_range(table(s, d, "customer"), "c_acctbal", 0, 9000).failing_rows()


def q_accepted_range_expr(s, d):
    return C.accepted_range(table(s, d, "lineitem"), "l_extendedprice", min_value="l_quantity * 900",
                            inclusive=False).failing_rows()


def _status_price(s, d):
    return table(s, d, "orders").withColumn(
        "f_price", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")))


def q_at_least_one(s, d):
    return C.at_least_one(_status_price(s, d), "f_price", group_by=["o_orderstatus"]).failing_rows()


def q_at_least_one_ungrouped(s, d):
    return C.at_least_one(_status_price(s, d), "f_price").failing_rows()


def q_not_constant(s, d):
    return C.not_constant(table(s, d, "lineitem"), "l_linestatus", group_by=["l_returnflag"]).failing_rows()


def q_not_null_proportion(s, d):
    return C.not_null_proportion(scored(s, d), "nu_nota_cn", at_least=0.985,
                                 group_by=["regiao"]).failing_rows()


def _query_part(s, d):
    return table(s, d, "pages").select("page_id", F.split_part("url", F.lit("?"), F.lit(2)).alias("query"))


def q_not_empty_string(s, d):
    return C.not_empty_string(_query_part(s, d), "query").failing_rows()


def q_not_accepted_values(s, d):
    return C.not_accepted_values(table(s, d, "orders"), "o_orderstatus", ["P", "X"]).failing_rows()


def q_relationships_where(s, d):
    return C.relationships_where(table(s, d, "lineitem"), "l_suppkey", table(s, d, "supplier"), "s_suppkey",
                                 from_condition="l_quantity > 10",
                                 to_condition="s_acctbal > 0").failing_rows()


def q_unique_combination(s, d):
    return C.unique_combination(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]).failing_rows()


def q_expression_is_true(s, d):
    return C.expression_is_true(table(s, d, "lineitem"), "l_extendedprice >= l_quantity * 950").failing_rows()


def q_expression_column(s, d):
    return C.expression_is_true(table(s, d, "orders"), "> 5000", column="o_totalprice").failing_rows()


def q_recency(s, d):
    return C.recency(table(s, d, "events"), "ts", "day", 1, as_of=AS_OF).failing_rows()


def q_recency_grouped(s, d):
    return C.recency(table(s, d, "events"), "ts", "hour", 12, as_of=dt.datetime(2024, 1, 31),
                     group_by=["event_type"]).failing_rows()


def _order_ranges(s, d):
    # the range starts price-many seconds into the order day, so two orders of
    # a customer do not tie exactly (the check's "last row" is undefined on ties)
    lo = F.timestamp_add("SECOND", F.floor("o_totalprice"), F.col("o_orderdate"))
    return table(s, d, "orders").select("o_custkey", lo.alias("lo"),
                                        F.timestamp_add("DAY", F.lit(60), lo).alias("hi"))


def q_ranges_by_customer(s, d):
    return C.mutually_exclusive_ranges(_order_ranges(s, d), "lo", "hi", partition_by="o_custkey").failing_rows()


def q_ranges_global(s, d):
    p = table(s, d, "part").select((F.col("p_partkey") * 10).alias("lo"),
                                   (F.col("p_partkey") * 10 + F.col("p_size") % 12).alias("hi"))
    return C.mutually_exclusive_ranges(p, "lo", "hi", gaps="not_allowed",
                                       zero_length_range_allowed=True).failing_rows()


def q_sequential_global(s, d):
    return C.sequential_values(table(s, d, "orders"), "o_orderkey").failing_rows()


def q_sequential_grouped(s, d):
    return C.sequential_values(table(s, d, "lineitem"), "l_linenumber", group_by=["l_orderkey"]).failing_rows()


def q_sequential_dates(s, d):
    days = table(s, d, "orders").select(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
                                        .alias("month")).distinct()
    return C.sequential_values(days, "month", datepart="month").failing_rows()


def _eq_inputs(s, d):
    o = table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    b = o.withColumn("o_orderpriority", F.when(F.col("o_orderstatus") == "P", F.lit("9-CHANGED"))
                     .otherwise(F.col("o_orderpriority")))
    return o, b


def q_equality(s, d):
    a, b = _eq_inputs(s, d)
    return C.equality(a, b).failing_rows()


def q_equality_precision(s, d):
    c = table(s, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    b = c.withColumn("c_acctbal", F.col("c_acctbal") + F.lit(0.001))
    return C.equality(c, b, precision=2, exclude_columns=["C_MKTSEGMENT"]).failing_rows()


def _yr(s, d):
    return (table(s, d, "orders").select(F.year("o_orderdate").alias("yr")),
            table(s, d, "lineitem").select(F.year("l_shipdate").alias("yr")))


def q_equal_rowcount(s, d):
    a, b = _yr(s, d)
    return C.equal_rowcount(a, b, group_by=["yr"]).failing_rows()


def q_fewer_rows_than(s, d):
    return C.fewer_rows_than(table(s, d, "customer"), table(s, d, "orders")).failing_rows()


def q_fewer_rows_grouped(s, d):
    a, b = _yr(s, d)
    return C.fewer_rows_than(b, a, group_by=["yr"]).failing_rows()


def q_cardinality_equality(s, d):
    return C.cardinality_equality(table(s, d, "orders"), "o_custkey", table(s, d, "customer"),
                                  "c_custkey").failing_rows()


def q_assert_equal(s, d):
    li = table(s, d, "lineitem").join(table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    t = li.select("l_orderkey", "l_linenumber",
                  snap_round(F.col("l_quantity") * F.col("p_retailprice"), 2).alias("actual"),
                  F.col("l_extendedprice").alias("expected"))
    return C.assert_equal(t, "actual", "expected").failing_rows()


def q_quality_report(s, d):
    """K3 and K4: the checks declared on the three marts, which share one silver table."""
    return jobs.quality(jobs.gold_marts(checkpointed(silver_pct(s, d))))


def q_check_report(s, d):
    o = table(s, d, "orders")
    li = table(s, d, "lineitem")
    checks = [
        C.not_null(o, "o_orderkey", relation="orders"),
        C.accepted_values(o, "o_orderstatus", ["F", "O"], relation="orders")
         .configured(warn_if=">0", error_if=">1000"),
        C.accepted_range(o, "o_totalprice", 2000, None, relation="orders").configured(severity="warn"),
        C.expression_is_true(o, "o_totalprice > 0", relation="orders"),
        C.not_constant(o, "o_orderpriority", relation="orders"),
        C.at_least_one(o, "o_custkey", relation="orders"),
        C.not_null_proportion(o, "o_custkey", at_least=0.5, relation="orders"),
        C.unique(o, "o_orderkey", relation="orders"),
        C.unique_combination(li, ["l_orderkey", "l_linenumber"], relation="lineitem")
         .configured(error_if=">20000", warn_if=">100"),
        C.equal_rowcount(o, li, relation="orders"),
    ]
    return C.run_checks(checks)


def q_not_constant_failing(s, d):
    li = table(s, d, "lineitem").withColumn("fixed", F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).otherwise(1.0))
    return C.not_constant(li, "fixed", group_by=["l_returnflag"]).failing_rows()


def q_recency_failing(s, d):
    return C.recency(table(s, d, "events"), "ts", "hour", 12, as_of=dt.datetime(2030, 1, 31),
                     group_by=["event_type"]).failing_rows()


def q_sequential_bigint(s, d):
    """Ids a double cannot tell apart, with gaps."""
    big = table(s, d, "orders").select((F.col("o_orderkey") + F.lit(2**60)).alias("big_key"))
    return C.sequential_values(big.where("big_key % 7 <> 0"), "big_key").failing_rows()


def q_sequential_dates_failing(s, d):
    days = table(s, d, "orders").select(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"))
    return C.sequential_values(days.where(F.month("month") != 3).distinct(), "month", datepart="month").failing_rows()


def q_at_least_one_failing(s, d):
    o = table(s, d, "orders").select(F.when(F.col("o_orderkey") < 0, F.col("o_orderkey")).alias("never"))
    return C.at_least_one(o, "never").failing_rows()


QUERIES = {
    "chk_not_constant_failing": q_not_constant_failing,
    "chk_recency_failing": q_recency_failing,
    "chk_sequential_bigint": q_sequential_bigint,
    "chk_sequential_dates_failing": q_sequential_dates_failing,
    "chk_at_least_one_failing": q_at_least_one_failing,
    "chk_not_null": q_not_null,
    "chk_accepted_values": q_accepted_values,
    "chk_unique": q_unique,
    "chk_accepted_range": q_accepted_range,
    "chk_accepted_range_expr": q_accepted_range_expr,
    "chk_at_least_one": q_at_least_one,
    "chk_at_least_one_ungrouped": q_at_least_one_ungrouped,
    "chk_not_constant": q_not_constant,
    "chk_not_null_proportion": q_not_null_proportion,
    "chk_not_empty_string": q_not_empty_string,
    "chk_not_accepted_values": q_not_accepted_values,
    "chk_relationships_where": q_relationships_where,
    "chk_unique_combination": q_unique_combination,
    "chk_expression_is_true": q_expression_is_true,
    "chk_expression_column": q_expression_column,
    "chk_recency": q_recency,
    "chk_recency_grouped": q_recency_grouped,
    "chk_ranges_by_customer": q_ranges_by_customer,
    "chk_ranges_global": q_ranges_global,
    "chk_sequential_global": q_sequential_global,
    "chk_sequential_grouped": q_sequential_grouped,
    "chk_sequential_dates": q_sequential_dates,
    "chk_equality": q_equality,
    "chk_equality_precision": q_equality_precision,
    "chk_equal_rowcount": q_equal_rowcount,
    "chk_fewer_rows_than": q_fewer_rows_than,
    "chk_fewer_rows_grouped": q_fewer_rows_grouped,
    "chk_cardinality_equality": q_cardinality_equality,
    "chk_assert_equal": q_assert_equal,
    "chk_quality_report": q_quality_report,
    "chk_report": q_check_report,
}

_SCORED = "WITH " + SCORED_SQL
_F_PRICE = "(SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS f_price FROM orders)"
_RANGES = """(SELECT o_custkey, lo, lo + INTERVAL 60 DAY AS hi FROM (SELECT o_custkey,
    o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) AS lo FROM orders) x)"""
_PARTR = "(SELECT p_partkey * 10 AS lo, p_partkey * 10 + p_size % 12 AS hi FROM part)"


def _mer(src, part, zl_op, zl_words, gap_op, gap_words):
    pc = f"PARTITION BY {part}" if part else ""
    sel = f"{part} AS partition_by_col," if part else ""
    return f"""WITH w AS (SELECT {sel} lo AS lower_bound, hi AS upper_bound,
        lead(lo) OVER ({pc} ORDER BY lo, hi) AS next_lower_bound,
        row_number() OVER ({pc} ORDER BY lo DESC, hi DESC) = 1 AS is_last_record FROM {src} t),
      calc AS (SELECT *, coalesce(lower_bound {zl_op} upper_bound, false) AS lower_bound_{zl_words}_upper_bound,
        coalesce(upper_bound {gap_op} next_lower_bound, is_last_record, false)
          AS upper_bound_{gap_words}_next_lower_bound FROM w)
      SELECT * FROM calc WHERE NOT (lower_bound_{zl_words}_upper_bound AND upper_bound_{gap_words}_next_lower_bound)"""


_YR = ("a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) AS ca FROM orders GROUP BY 1), "
       "b AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, COUNT(*) AS cb FROM lineitem GROUP BY 1)")
_CHK_GOLD = f"{_W}, {GOLD_UF_SQL}, {GOLD_INCOME_SQL}, {GOLD_YOY_SQL}"


def _nn(i, name, rel, tbl, col):
    return (f"SELECT {i} AS check_index, '{name}' AS \"check\", '{rel}' AS relation, "
            f"CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures FROM {tbl}")


def _status(sql, rules):
    cases = " ".join(f"WHEN check_index = {i} THEN {r}" for i, r in rules.items())
    default = "CASE WHEN failures != 0 THEN 'fail' ELSE 'pass' END"
    return f"SELECT *, CASE {cases} ELSE {default} END AS status FROM ({sql}) r" if rules else \
        f"SELECT *, {default} AS status FROM ({sql}) r"


_QUALITY = " UNION ALL ".join([
    _nn(0, "not_null_uf", "gold_uf", "gold_uf", "uf"),
    _nn(1, "not_null_ano", "gold_uf", "gold_uf", "ano"),
    _nn(2, "not_null_total_candidatos", "gold_uf", "gold_uf", "total_candidatos"),
    _nn(3, "not_null_media_geral", "gold_uf", "gold_uf", "media_geral"),
    _nn(4, "not_null_pct_escola_publica", "gold_uf", "gold_uf", "pct_escola_publica"),
    "SELECT 5, 'accepted_range_pct_escola_publica', 'gold_uf', CAST(COUNT(*) FILTER (WHERE NOT "
    "(pct_escola_publica >= 0) OR NOT (pct_escola_publica <= 100)) AS BIGINT) FROM gold_uf",
    _nn(6, "not_null_grupo_renda", "gold_income", "gold_income", "grupo_renda"),
    "SELECT 7, 'accepted_values_grupo_renda', 'gold_income', CAST(COUNT(DISTINCT CASE WHEN grupo_renda NOT IN "
    "('Baixa', 'Média', 'Alta') THEN grupo_renda END) AS BIGINT) FROM gold_income",
    _nn(8, "not_null_media_geral", "gold_income", "gold_income", "media_geral"),
    _nn(9, "not_null_regiao", "gold_yoy", "gold_yoy", "regiao"),
    _nn(10, "not_null_ano", "gold_yoy", "gold_yoy", "ano"),
])

_REPORT = " UNION ALL ".join([
    _nn(0, "not_null_o_orderkey", "orders", "orders", "o_orderkey"),
    "SELECT 1, 'accepted_values_o_orderstatus', 'orders', CAST(COUNT(DISTINCT CASE WHEN o_orderstatus NOT IN "
    "('F', 'O') THEN o_orderstatus END) AS BIGINT) FROM orders",
    "SELECT 2, 'accepted_range_o_totalprice', 'orders', CAST(COUNT(*) FILTER (WHERE NOT (o_totalprice >= 2000))"
    " AS BIGINT) FROM orders",
    "SELECT 3, 'expression_is_true', 'orders', CAST(COUNT(*) FILTER (WHERE NOT (o_totalprice > 0)) AS BIGINT)"
    " FROM orders",
    "SELECT 4, 'not_constant_o_orderpriority', 'orders', CAST(CASE WHEN COUNT(DISTINCT o_orderpriority) = 1 "
    "THEN 1 ELSE 0 END AS BIGINT) FROM orders",
    "SELECT 5, 'at_least_one_o_custkey', 'orders', CAST(CASE WHEN COUNT(o_custkey) = 0 THEN 1 ELSE 0 END "
    "AS BIGINT) FROM orders",
    "SELECT 6, 'not_null_proportion_o_custkey', 'orders', CAST(CASE WHEN CAST(COUNT(o_custkey) AS DOUBLE) / "
    "COUNT(*) < 0.5 THEN 1 ELSE 0 END AS BIGINT) FROM orders",
    "SELECT 7, 'unique_o_orderkey', 'orders', CAST(COUNT(*) AS BIGINT) FROM (SELECT o_orderkey FROM orders "
    "WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)",
    "SELECT 8, 'unique_combination_of_l_orderkey_l_linenumber', 'lineitem', CAST(COUNT(*) AS BIGINT) FROM "
    "(SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)",
    "SELECT 9, 'equal_rowcount', 'orders', CAST(abs((SELECT COUNT(*) FROM orders) - "
    "(SELECT COUNT(*) FROM lineitem)) AS BIGINT)",
])
_REPORT_RULES = {
    1: "CASE WHEN failures > 1000 THEN 'fail' WHEN failures > 0 THEN 'warn' ELSE 'pass' END",
    2: "CASE WHEN failures != 0 THEN 'warn' ELSE 'pass' END",
    8: "CASE WHEN failures > 20000 THEN 'fail' WHEN failures > 100 THEN 'warn' ELSE 'pass' END",
}

ORACLE = {
    "chk_not_null": f"{_SCORED} SELECT * FROM scored WHERE nu_nota_cn IS NULL",
    "chk_accepted_values": """SELECT o_orderpriority AS value_field, COUNT(*) AS n_records FROM orders
        GROUP BY 1 HAVING o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "chk_unique": """SELECT o_custkey AS unique_field, COUNT(*) AS n_records FROM orders
        WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1""",
    "chk_accepted_range": "SELECT * FROM customer WHERE NOT (c_acctbal >= 0) OR NOT (c_acctbal <= 9000)",
    "chk_accepted_range_expr": "SELECT * FROM lineitem WHERE NOT (l_extendedprice > l_quantity * 900)",
    "chk_at_least_one": f"""SELECT o_orderstatus, COUNT(f_price) AS filler_column FROM {_F_PRICE} t
        GROUP BY o_orderstatus HAVING COUNT(f_price) = 0""",
    "chk_at_least_one_ungrouped": f"""SELECT COUNT(f_price) AS filler_column FROM
        (SELECT f_price FROM {_F_PRICE} t WHERE f_price IS NOT NULL LIMIT 1) x HAVING COUNT(f_price) = 0""",
    "chk_not_constant_failing": """SELECT l_returnflag, COUNT(DISTINCT fixed) AS filler_column FROM (SELECT l_returnflag,
        CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 1.0 END AS fixed FROM lineitem) x
        GROUP BY l_returnflag HAVING COUNT(DISTINCT fixed) = 1""",
    "chk_recency_failing": """SELECT event_type, most_recent, threshold FROM (SELECT event_type,
        max(ts) AS most_recent, CAST(TIMESTAMP '2030-01-31 00:00:00' - INTERVAL 12 HOUR AS TIMESTAMP) AS threshold
        FROM events GROUP BY event_type) r WHERE most_recent < threshold""",
    "chk_sequential_bigint": """SELECT * FROM (SELECT big_key, lag(big_key) OVER (ORDER BY big_key) AS previous_big_key
        FROM (SELECT o_orderkey + 1152921504606846976 AS big_key FROM orders) o WHERE big_key % 7 <> 0) w
        WHERE NOT (big_key = previous_big_key + 1)""",
    "chk_sequential_dates_failing": """SELECT * FROM (SELECT month, lag(month) OVER (ORDER BY month) AS previous_month
        FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month FROM orders
              WHERE month(o_orderdate) <> 3) m) w WHERE NOT (month = previous_month + INTERVAL 1 MONTH)""",
    "chk_at_least_one_failing": """SELECT COUNT(never) AS filler_column FROM
        (SELECT CASE WHEN o_orderkey < 0 THEN o_orderkey END AS never FROM orders) o HAVING COUNT(never) = 0""",
    "chk_not_constant": """SELECT l_returnflag, COUNT(DISTINCT l_linestatus) AS filler_column FROM lineitem
        GROUP BY l_returnflag HAVING COUNT(DISTINCT l_linestatus) = 1""",
    "chk_not_null_proportion": f"""{_SCORED} SELECT * FROM (SELECT regiao,
        CAST(SUM(CASE WHEN nu_nota_cn IS NULL THEN 0 ELSE 1 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)
          AS not_null_proportion FROM scored GROUP BY regiao) v
        WHERE not_null_proportion < 0.985 OR not_null_proportion > 1.0""",
    "chk_not_empty_string": """SELECT trim(split_part(url, '?', 2)) AS query FROM pages
        WHERE trim(split_part(url, '?', 2)) = ''""",
    "chk_not_accepted_values": """SELECT DISTINCT o_orderstatus AS value_field FROM orders
        WHERE o_orderstatus IN ('P', 'X')""",
    "chk_relationships_where": """SELECT l.l_suppkey AS id, CAST(NULL AS BIGINT) AS right_id
        FROM (SELECT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL AND l_quantity > 10) l
        LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL AND s_acctbal > 0) r
        ON l.l_suppkey = r.s_suppkey WHERE r.s_suppkey IS NULL""",
    "chk_unique_combination": """SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2
        HAVING COUNT(*) > 1""",
    "chk_expression_is_true": "SELECT * FROM lineitem WHERE NOT (l_extendedprice >= l_quantity * 950)",
    "chk_expression_column": "SELECT * FROM orders WHERE NOT (o_totalprice > 5000)",
    "chk_recency": """SELECT most_recent, threshold FROM (SELECT max(ts) AS most_recent,
        CAST(TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 1 DAY AS TIMESTAMP) AS threshold FROM events) r
        WHERE most_recent < threshold""",
    "chk_recency_grouped": """SELECT event_type, most_recent, threshold FROM (SELECT event_type,
        max(ts) AS most_recent, CAST(TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 12 HOUR AS TIMESTAMP) AS threshold
        FROM events GROUP BY event_type) r WHERE most_recent < threshold""",
    "chk_ranges_by_customer": _mer(_RANGES, "o_custkey", "<", "less_than", "<=", "less_than_or_equal_to"),
    "chk_ranges_global": _mer(_PARTR, None, "<=", "less_than_or_equal_to", "=", "equal_to"),
    "chk_sequential_global": """SELECT * FROM (SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY o_orderkey)
        AS previous_o_orderkey FROM orders) w WHERE NOT (o_orderkey = previous_o_orderkey + 1)""",
    "chk_sequential_grouped": """SELECT * FROM (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER
        (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous_l_linenumber FROM lineitem) w
        WHERE NOT (l_linenumber = previous_l_linenumber + 1)""",
    "chk_sequential_dates": """SELECT * FROM (SELECT month, lag(month) OVER (ORDER BY month) AS previous_month
        FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS month FROM orders) m) w
        WHERE NOT (CAST(month AS TIMESTAMP) = CAST(previous_month + INTERVAL 1 MONTH AS TIMESTAMP))""",
    "chk_equality": """WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders),
        b AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN '9-CHANGED'
              ELSE o_orderpriority END AS o_orderpriority FROM orders)
        SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
        UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "chk_equality_precision": """WITH a AS (SELECT CAST(round(CAST(c_custkey AS DECIMAL(38,10)), 2) AS DECIMAL(38,2))
            AS c_custkey, CAST(round(CAST(c_acctbal AS DECIMAL(38,10)), 2) AS DECIMAL(38,2)) AS c_acctbal
            FROM customer),
        b AS (SELECT CAST(round(CAST(c_custkey AS DECIMAL(38,10)), 2) AS DECIMAL(38,2)) AS c_custkey,
            CAST(round(CAST(c_acctbal + 0.001 AS DECIMAL(38,10)), 2) AS DECIMAL(38,2)) AS c_acctbal FROM customer)
        SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
        UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "chk_equal_rowcount": f"""WITH {_YR}
        SELECT CASE WHEN a.yr IS NOT NULL THEN 1 END AS id_dbtutils_test_equal_rowcount_a,
          CASE WHEN b.yr IS NOT NULL THEN 1 END AS id_dbtutils_test_equal_rowcount_b,
          a.yr AS yr_a, b.yr AS yr_b, a.ca AS count_a, b.cb AS count_b, abs(a.ca - b.cb) AS diff_count
        FROM a FULL JOIN b ON a.yr = b.yr""",
    "chk_fewer_rows_than": """WITH a AS (SELECT COUNT(*) AS ca FROM customer), b AS (SELECT COUNT(*) AS cb FROM orders)
        SELECT 1 AS id_dbtutils_test_fewer_rows_than_a, 1 AS id_dbtutils_test_fewer_rows_than_b,
          ca AS count_our_model, cb AS count_comparison_model,
          CAST(CASE WHEN ca > cb THEN ca - cb WHEN ca = cb THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta
        FROM a, b""",
    "chk_fewer_rows_grouped": f"""WITH {_YR}
        SELECT CASE WHEN b.yr IS NOT NULL THEN 1 END AS id_dbtutils_test_fewer_rows_than_a,
          CASE WHEN a.yr IS NOT NULL THEN 1 END AS id_dbtutils_test_fewer_rows_than_b,
          b.yr AS yr_a, a.yr AS yr_b, b.cb AS count_our_model, a.ca AS count_comparison_model,
          CAST(CASE WHEN b.cb > a.ca THEN b.cb - a.ca WHEN b.cb = a.ca THEN 1 ELSE 0 END AS BIGINT)
            AS row_count_delta
        FROM b FULL JOIN a ON b.yr = a.yr""",
    "chk_cardinality_equality": """WITH ta AS (SELECT o_custkey, COUNT(*) AS num_rows FROM orders GROUP BY 1),
        tb AS (SELECT c_custkey AS o_custkey, COUNT(*) AS num_rows FROM customer GROUP BY 1)
        SELECT * FROM (SELECT * FROM ta EXCEPT SELECT * FROM tb)
        UNION ALL SELECT * FROM (SELECT * FROM tb EXCEPT SELECT * FROM ta)""",
    "chk_assert_equal": """SELECT * FROM (SELECT l_orderkey, l_linenumber,
        CAST(round(CAST(l_quantity * p_retailprice AS DECIMAL(28,10)), 2) AS DOUBLE) AS actual,
        l_extendedprice AS expected FROM lineitem JOIN part ON l_partkey = p_partkey) t
        WHERE actual != expected""",
    "chk_quality_report": f"{_CHK_GOLD} {_status(_QUALITY, {})}",
    "chk_report": _status(_REPORT, _REPORT_RULES),
}


def q_documents_report(s, d):
    """Checks over the whole document texts and their labels: one fused scan
    of ``documents`` for the row-level checks, the rest on their own."""
    docs, labels, conv = table(s, d, "documents"), table(s, d, "labels"), table(s, d, "conversations")
    checks = [
        C.not_null(docs, "text", relation="documents"),
        C.not_empty_string(docs, "text", relation="documents"),
        C.expression_is_true(docs, "n_chars = length(text)", relation="documents"),
        C.not_null_proportion(docs, "lang", at_least=0.99, relation="documents"),
        C.accepted_values(docs, "lang", ["en", "fr", "de"], relation="documents").configured(warn_if=">0",
                                                                                         error_if=">2"),
        C.unique(docs, "doc_id", relation="documents"),
        C.relationships_where(labels, "doc_id", docs, "doc_id", relation="labels"),
        C.accepted_range(labels, "quality", 0, 1, relation="labels"),
        C.unique_combination(conv, ["conv_id", "turn"], relation="conversations"),
        C.accepted_values(conv, "role", ["user", "assistant"], relation="conversations"),
    ]
    return C.run_checks(checks)


QUERIES["chk_documents_report"] = q_documents_report
_DOCS = " UNION ALL ".join([
    "SELECT 0 AS check_index, 'not_null_text' AS \"check\", 'documents' AS relation, "
    "CAST(COUNT(*) FILTER (WHERE text IS NULL) AS BIGINT) AS failures FROM documents",
    "SELECT 1, 'not_empty_string_text', 'documents', CAST(COUNT(*) FILTER (WHERE trim(text) = '') AS BIGINT)"
    " FROM documents",
    "SELECT 2, 'expression_is_true', 'documents', CAST(COUNT(*) FILTER (WHERE NOT (n_chars = length(text)))"
    " AS BIGINT) FROM documents",
    "SELECT 3, 'not_null_proportion_lang', 'documents', CAST(CASE WHEN CAST(COUNT(lang) AS DOUBLE) / COUNT(*)"
    " < 0.99 THEN 1 ELSE 0 END AS BIGINT) FROM documents",
    "SELECT 4, 'accepted_values_lang', 'documents', CAST(COUNT(DISTINCT CASE WHEN lang NOT IN ('en', 'fr', 'de')"
    " THEN lang END) AS BIGINT) FROM documents",
    "SELECT 5, 'unique_doc_id', 'documents', CAST(COUNT(*) AS BIGINT) FROM (SELECT doc_id FROM documents"
    " WHERE doc_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)",
    "SELECT 6, 'relationships_where_doc_id', 'labels', CAST(COUNT(*) AS BIGINT) FROM labels l"
    " WHERE l.doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)",
    "SELECT 7, 'accepted_range_quality', 'labels', CAST(COUNT(*) FILTER (WHERE NOT (quality >= 0) OR"
    " NOT (quality <= 1)) AS BIGINT) FROM labels",
    "SELECT 8, 'unique_combination_of_conv_id_turn', 'conversations', CAST(COUNT(*) AS BIGINT) FROM"
    " (SELECT 1 FROM conversations GROUP BY conv_id, turn HAVING COUNT(*) > 1)",
    "SELECT 9, 'accepted_values_role', 'conversations', CAST(COUNT(DISTINCT CASE WHEN role NOT IN"
    " ('user', 'assistant') THEN role END) AS BIGINT) FROM conversations",
])
ORACLE["chk_documents_report"] = _status(_DOCS, {
    4: "CASE WHEN failures > 2 THEN 'fail' WHEN failures > 0 THEN 'warn' ELSE 'pass' END"})
