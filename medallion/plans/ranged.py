"""Order-dependent windows that never put a whole partition in one task.

A window such as ``lag(x) over (order by k)`` has no partition key, so Spark
runs it in one task.  Here the rows are dealt into ordered *buckets*:

1. ``repartitionByRange`` over group, order columns and a hash of the whole row
   deals the rows into partitions of like size, whatever the key's type: NULL keys
   and hot values spread like others, since the hash is part of the order;
2. the partition's number is the bucket, and the rows are written once to the
   checkpoint folder, so all branches of the plan and all retries see the same;
3. the window runs per ``(group, bucket)``;
4. one row per non-empty bucket (its first / last value, its total) forms an
   edge table of at most ``n`` rows per group, windowed by group and joined
   back to patch the first / last row of each bucket.

The result equals the unbucketed window (ties broken by the row hash).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.session import checkpointed

_B = "_rng_bucket"
_TB = "_rng_tie"


def default_buckets(df: DataFrame) -> int:
    """One bucket per shuffle partition (at least 2)."""
    try:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover
        n = 200
    return max(n, 2)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    if not keys:
        return left.crossJoin(right)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def add_range_bucket(df: DataFrame, order_cols: str | Sequence[str], n_buckets: int | None = None,
                     partition_cols: Sequence[str] = ()) -> DataFrame:
    """Add ``_rng_bucket`` (rows of a group are in bucket order) and ``_rng_tie``
    (row hash, the last of the order)."""
    n = n_buckets or default_buckets(df)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    keyed = df.withColumn(_TB, F.xxhash64(*[F.col(c) for c in df.columns]))
    if n <= 1:
        return keyed.withColumn(_B, F.lit(0))
    order = [F.col(c).asc_nulls_first() for c in [*partition_cols, *order_cols, _TB]]
    return checkpointed(keyed.repartitionByRange(n, *order).withColumn(_B, F.spark_partition_id()))


def ranged_shift(df: DataFrame, value_col: str, order_cols: Sequence[str], out_col: str,
                 direction: str = "lag", partition_cols: Sequence[str] = (),
                 n_buckets: int | None = None, exists_col: str | None = None) -> DataFrame:
    """``lag``/``lead`` of ``value_col`` by one row, ordered by ``order_cols``
    (ascending, NULLS FIRST) within ``partition_cols``, bucketed by range.

    ``exists_col`` adds a boolean telling whether a previous / next row exists
    at all (the shifted value itself may be NULL either way)."""
    if direction not in ("lag", "lead"):
        raise ValueError("direction must be 'lag' or 'lead'")
    order_cols = list(order_cols)
    b = add_range_bucket(df, order_cols, n_buckets, partition_cols)
    keys = list(partition_cols) + [_B]
    ordering = [F.col(c).asc_nulls_first() for c in order_cols] + [F.col(_TB)]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    shift = F.lag if direction == "lag" else F.lead
    # When the shifted value is the leading order key itself, a bucket's
    # last (first) value is simply its max (min): a fixed-width hash aggregate.
    # Otherwise it is max_by / min_by over the full ordering.
    simple = value_col == order_cols[0]
    order_struct = F.struct(*[F.col(c) for c in order_cols], F.col(_TB))
    if direction == "lag":
        inner = F.lag(value_col).over(w)
        edge_at = F.row_number().over(w) == 1
        # last value of each bucket, carried to the next non-empty bucket
        edge_val = F.max(value_col) if simple else F.max_by(F.col(value_col), order_struct)
    else:
        inner = F.lead(value_col).over(w)
        # the last row by the *same* ordering as the lead (exact duplicate rows
        # tie on the hash too, so a second, reversed ordering could disagree)
        edge_at = F.row_number().over(w) == F.count(F.lit(1)).over(Window.partitionBy(*keys))
        # NULLs come first
        edge_val = (F.when(F.count(value_col) == F.count(F.lit(1)), F.min(value_col)) if simple
                    else F.min_by(F.col(value_col), order_struct))
    staged = b.withColumn("_rng_inner", inner).withColumn("_rng_edge", edge_at)
    edges = b.groupBy(*keys).agg(edge_val.alias("_rng_val"))
    ew = Window.partitionBy(*partition_cols).orderBy(F.col(_B)) if partition_cols \
        else Window.orderBy(F.col(_B))
    edges = (edges.withColumn("_rng_carry", shift("_rng_val").over(ew))
                  .withColumn("_rng_has", shift(F.col(_B)).over(ew).isNotNull()).drop("_rng_val"))
    out = _null_safe_join(staged, edges, keys, "left")
    out = out.withColumn(out_col, F.when(F.col("_rng_edge"), F.col("_rng_carry")).otherwise(F.col("_rng_inner")))
    if exists_col:
        out = out.withColumn(exists_col, F.when(F.col("_rng_edge"), F.col("_rng_has")).otherwise(F.lit(True)))
    return out.drop("_rng_inner", "_rng_edge", "_rng_carry", "_rng_has", _B, _TB)


def ranged_prefix_sum(df: DataFrame, weight_col: str, order_col: str, out_col: str,
                      partition_cols: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Exclusive running sum of ``weight_col`` in ``order_col`` order
    (NULLS FIRST) per group.  Meant for rows with distinct order keys per group
    (a histogram); equal keys would be summed in hash order."""
    b = add_range_bucket(df, order_col, n_buckets, partition_cols)
    keys = list(partition_cols) + [_B]
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc_nulls_first(), F.col(_TB)) \
              .rowsBetween(Window.unboundedPreceding, -1)
    inner = b.withColumn("_rng_in", F.coalesce(F.sum(weight_col).over(w), F.lit(0)))
    totals = b.groupBy(*keys).agg(F.sum(weight_col).alias("_rng_tot"))
    ew = (Window.partitionBy(*partition_cols) if partition_cols else Window.partitionBy()) \
        .orderBy(F.col(_B)).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_rng_off", F.coalesce(F.sum("_rng_tot").over(ew), F.lit(0))) \
                   .drop("_rng_tot")
    out = _null_safe_join(inner, totals, keys, "left")
    return out.withColumn(out_col, F.col("_rng_in") + F.col("_rng_off")) \
              .drop("_rng_in", "_rng_off", _B, _TB)
