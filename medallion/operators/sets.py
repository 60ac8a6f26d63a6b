"""Set operators with SQL's distinct semantics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

A_MINUS_B = "a_minus_b"
B_MINUS_A = "b_minus_a"


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` not in ``b``; NULL equals NULL (``EXCEPT``)."""
    return a.subtract(b)


def symmetric_difference(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None,
                         which_col: str = "which_diff", strategy: str = "aggregate") -> DataFrame:
    """Distinct rows found on one side only, labelled ``a_minus_b`` /
    ``b_minus_a`` (U3).

    ``strategy="aggregate"``: union all with a side bit, one ``groupBy`` over
    all columns (partial aggregation collapses repeated rows before the
    shuffle) — one shuffle.  ``strategy="except"``: two ``EXCEPT`` plans.
    ``strategy="digest"``: see ``differing_buckets``; for tables expected to be equal."""
    cols = list(columns) if columns is not None else a.columns
    a2, b2 = a.select(*cols), b.select(*cols)
    if strategy == "except":
        left = a2.subtract(b2).select(F.lit(A_MINUS_B).alias(which_col), *cols)
        right = b2.subtract(a2).select(F.lit(B_MINUS_A).alias(which_col), *cols)
        return left.unionByName(right)
    if strategy == "digest" and all(_hashable(f.dataType) for d in (a2, b2) for f in d.schema):
        if [f.dataType for f in a2.schema] == [f.dataType for f in b2.schema]:
            a2, b2 = differing_rows(a2, b2)
    elif strategy not in ("aggregate", "digest"):
        raise ValueError("strategy must be 'aggregate', 'except' or 'digest'")
    tagged = a2.withColumn("_side", F.lit(1)).unionByName(b2.withColumn("_side", F.lit(2)))
    sides = tagged.groupBy(*cols).agg(F.bit_or("_side").alias("_sides"))
    return (sides.where(F.col("_sides") != 3)
                 .select(F.when(F.col("_sides") == 1, A_MINUS_B).otherwise(B_MINUS_A).alias(which_col), *cols))


#: Buckets of a digest comparison: the most rows a map task ships for equal tables, and
#: the bound of what is broadcast (one whole number each, 64 KB in all).
BUCKETS = 8192
_LOW = 0xFFFFFFFF


def _hashable(t: T.DataType) -> bool:
    """Maps cannot be hashed, nor rows that hold one."""
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t)
    return _hashable(t.elementType) if isinstance(t, T.ArrayType) else not isinstance(t, (T.MapType, T.VariantType))


def _row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row.  NULLs leave a hash as it is, so which columns are
    NULL is hashed too; inside arrays and structs the text form tells NULLs apart."""
    parts: list[Column] = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        parts.append(F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if isinstance(f.dataType, (T.ArrayType, T.StructType)) else c)
    nulls = F.concat_ws("", *[F.when(F.col(f"`{n}`").isNull(), "1").otherwise("0") for n in df.columns])
    return F.xxhash64(*parts, nulls), F.xxhash64(nulls, *reversed(parts), F.lit("again"))


def _digests(df: DataFrame, buckets: int) -> DataFrame:
    """Per bucket of row hashes an order-independent digest of its rows: their number and
    the sums of both halves of two hashes (128 bits; half sums cannot overflow)."""
    h1, h2 = _row_hashes(df)
    rows = df.select(h1.alias("h1"), h2.alias("h2"))
    halves = [F.sum(part(F.col(h))).alias(f"{h}_{name}") for h in ("h1", "h2") for name, part in
              (("lo", lambda c: c.bitwiseAND(F.lit(_LOW))), ("hi", lambda c: F.shiftrightunsigned(c, 32)))]
    return rows.groupBy(F.pmod("h1", F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), *halves)


def differing_buckets(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` numbers whose rows are not the same rows, as often, on both sides.  Each
    map task ships at most one digest per bucket."""
    both = _digests(a, buckets).withColumn("side", F.lit(1)).unionByName(_digests(b, buckets).withColumn("side", F.lit(2)))
    sums = [c for c in both.columns if c not in ("bucket", "side")]
    differ = F.count(F.lit(1)) < 2
    for c in sums:
        differ = differ | (F.min(c) != F.max(c))
    return both.groupBy("bucket").agg(differ.alias("differ")).where("differ").select("bucket")


def differing_rows(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Both tables without the rows of buckets whose digests agree.  Rows found on one side
    only are all among what is left; of equal tables nothing is left, and nothing is
    shuffled but digests.  At most ``buckets`` numbers are broadcast."""
    differ = differing_buckets(a, b, buckets)
    out = []
    for df in (a, b):
        bucket = F.pmod(_row_hashes(df)[0], F.lit(buckets))
        out.append(df.withColumn("_bucket", bucket).join(F.broadcast(differ), F.col("_bucket") == F.col("bucket"), "left_semi").select(
            *[F.col(f"`{c}`") for c in df.columns]))
    return out[0], out[1]
