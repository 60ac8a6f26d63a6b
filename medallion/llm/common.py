"""Helpers shared by the training-data operators.

A *word* is a run of characters other than U+0020 and U+0009..U+000D.  Operators
narrow their input to the columns they read, or carry whole rows in one struct
(``packed``), before they add columns of their own, so input columns of any name
come out as they went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  All-ASCII text takes the built-in ``lower``, which
    agrees there; other text maps letter by letter so that é/É stay apart."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def packed(df: DataFrame, **read: Column) -> DataFrame:
    """The rows of ``df`` in one struct, ``__row``, beside the columns to be read."""
    return df.select(F.struct(*[col(c) for c in df.columns]).alias("__row"), *[c.alias(n) for n, c in read.items()])


def unpacked(df: DataFrame, columns: list[str], **instead: Column) -> DataFrame:
    """The packed columns again, some of them replaced."""
    return df.select(*[instead.get(c, F.col("__row").getField(c)).alias(c) for c in columns])


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({WORD})"), F.lit(1))


def n_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage, keeps columns prunable and survives the loss of an executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()
