"""Benchmark: headline queries and the slow/fast plan-shape pairs of
local[$BENCH_CPUS].  Each query is run to completion with the ``noop`` sink
(no driver collect) after one warm-up pass; the best of $BENCH_REPEAT runs is
kept.  Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from medallion.bindings import registry  # noqa: E402
from medallion.bindings.common import table  # noqa: E402
from medallion.bindings.tiers import silver  # noqa: E402
from medallion.operators import checks as C  # noqa: E402
from medallion.operators import sets, shape  # noqa: E402
from medallion.operators.silver import percent_rank_pct  # noqa: E402
from medallion.plans.ranged import ranged_shift  # noqa: E402
from medallion.session import get_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))


def _unpivot_union(df: DataFrame, ids, cols, field="prop", value="val") -> DataFrame:
    """Slow shape: one scan per unpivoted column, glued by UNION ALL."""
    parts = [df.select(*ids, F.lit(c).alias(field), F.col(c).cast("string").alias(value)) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pairs(spark, d):
    """Slow / fast shapes of the same result."""
    li = table(spark, d, "lineitem")
    orders = table(spark, d, "orders")
    unpivot_cols = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

    def eq_inputs():
        a = li.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
        b = a.withColumn("l_quantity", F.when(F.col("l_returnflag") == "R", F.col("l_quantity") + 1)
                         .otherwise(F.col("l_quantity")))
        return a, b

    def suite(fuse):
        checks = [C.not_null(li, c, relation="lineitem") for c in li.columns]
        checks += [C.accepted_range(li, "l_discount", 0, 0.1, relation="lineitem"),
                   C.accepted_range(li, "l_quantity", 1, 50, relation="lineitem"),
                   C.expression_is_true(li, "l_extendedprice > 0", relation="lineitem"),
                   C.accepted_values(li, "l_returnflag", ["A", "N", "R"], relation="lineitem"),
                   C.not_constant(li, "l_linestatus", relation="lineitem"),
                   C.at_least_one(li, "l_tax", relation="lineitem"),
                   C.not_null_proportion(li, "l_shipdate", at_least=0.99, relation="lineitem")]
        return C.run_checks(checks, fuse=fuse)

    def lag_single():
        w = Window.orderBy("l_extendedprice")
        return li.select("l_extendedprice").withColumn("prev", F.lag("l_extendedprice").over(w))

    def lag_bucketed():
        return ranged_shift(li.select("l_extendedprice"), "l_extendedprice", ["l_extendedprice"], "prev", "lag")

    def pivot(strategy):
        keyed = li.select("l_returnflag", (F.col("l_partkey") % 1000).alias("k"))
        return shape.pivot_columns(keyed, ["l_returnflag"], "k", list(range(1000)), prefix="n_", strategy=strategy)

    return {
        "r1_pivot_conditional": lambda: pivot("conditional"),
        "r1_pivot_two_phase": lambda: pivot("auto"),
        "u3_equality_digest": lambda: sets.symmetric_difference(*eq_inputs(), strategy="digest"),
        "u3_equal_tables_aggregate": lambda: sets.symmetric_difference(li, li.repartition("l_suppkey"), strategy="aggregate"),
        "u3_equal_tables_digest": lambda: sets.symmetric_difference(li, li.repartition("l_suppkey"), strategy="digest"),
        "w1_percent_rank_window": lambda: percent_rank_pct(silver(spark, d), strategy="window"),
        "w1_percent_rank_histogram": lambda: percent_rank_pct(silver(spark, d), strategy="histogram",
                                                              n_buckets=1),
        "w1_percent_rank_hist_bucketed": lambda: percent_rank_pct(silver(spark, d), strategy="histogram"),
        "u3_equality_except": lambda: sets.symmetric_difference(*eq_inputs(), strategy="except"),
        "u3_equality_aggregate": lambda: sets.symmetric_difference(*eq_inputs(), strategy="aggregate"),
        "r2_unpivot_union": lambda: _unpivot_union(orders, ["o_orderkey"], unpivot_cols),
        "r2_unpivot_expand": lambda: shape.unpivot_columns(orders, exclude=["o_orderkey"],
                                                           field_name="prop", value_name="val"),
        "c22_checks_unfused": lambda: suite(False),
        "c22_checks_fused": lambda: suite(True),
        "w3_lag_single_task": lag_single,
        "w3_lag_bucketed": lag_bucketed,
    }


HEADLINE = ["gold_by_uf", "gold_by_income", "gold_yoy", "kpis", "school_crosstab", "dedupe_lineitem",
            "pivot_types", "chk_quality_report", "chk_sequential_global", "chk_ranges_global",
            "symdiff_aggregate", "upsert_partitions", "csv_quarantine_good"]


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(build, repeat: int = REPEAT) -> float:
    best = None
    for _ in range(repeat):
        t0 = time.perf_counter()
        _run(build())
        dt = time.perf_counter() - t0
        best = dt if best is None else min(best, dt)
    return round(best, 3)


def main() -> None:
    spark = get_session(master=f"local[{CPUS}]")
    qs = registry.queries()
    _run(qs["silver_bands"](spark, SF_DIR))  # warm-up: JVM, codegen, file listing
    times = {}
    for name in HEADLINE:
        times[name] = _time(lambda n=name: qs[n](spark, SF_DIR))
    for name, build in pairs(spark, SF_DIR).items():
        # a thousand conditional columns take most of a minute: once is enough
        times[name] = _time(build, 1 if name.endswith("_conditional") else REPEAT)
    fast = [k for k in times if not any(k.endswith(s) for s in
                                        ("_window", "_except", "_union", "_unfused", "_single_task", "_conditional"))]
    total = round(sum(times[k] for k in fast), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
