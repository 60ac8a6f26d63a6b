"""Exact de-duplication: 128-bit content hash, bytes compared inside groups.

Rows are grouped by (hash, normalised text): the hash deals the rows out and the
text in the key compares the bytes, so two texts that collide on the hash never
share a group.  The aggregate combines before its shuffle, so a group holding a
third of all rows leaves each task as one row, and texts cross the network once
per task and distinct text.  The groups go to the shared folder without their
texts; documents meet them by hash alone in a sort-merge join of narrow rows
whose hot partitions adaptive execution splits.  If the groups show two texts on
one hash, the documents with such hashes are joined by hash and text instead.

Null text counts as empty.  A null id is smaller (``keep="largest"``) or larger
(``keep="smallest"``) than any other, so it stays only where every id of the
group is null.  Rows that repeat both id and text form one group like any other
and exactly one of them stays.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import ascii_lower, col, has_rows, packed, staged, text_or_empty, unpacked


def content_hash(c: Column) -> Column:
    return F.unhex(F.md5(c))


def _groups(df: DataFrame, id_col: str, text_col: str, keep: str, normalise, hash_fn) -> DataFrame:
    pick = {"largest": F.max, "smallest": F.min}[keep]
    base = df.select(col(id_col).alias("__id"), normalise(text_or_empty(text_col)).alias("__t"))
    g = (base.select("__id", "__t", hash_fn(F.col("__t")).alias("__h"))
         .groupBy("__h", "__t").agg(pick("__id").alias("__keep"), F.count(F.lit(1)).alias("__n")))
    return staged(g.select("__h", "__keep", "__n", F.sha2("__t", 256).alias("__sha"),
                           F.xxhash64("__t").alias("__x")), "exact-groups")


def _labelled(df: DataFrame, id_col: str, text_col: str, keep: str, normalise, hash_fn) -> DataFrame:
    """The rows of ``df``, packed, with ``__id __keep __n __sha __kept``."""
    groups = _groups(df, id_col, text_col, keep, normalise, hash_fn)
    docs = packed(df, __id=col(id_col), __t=normalise(text_or_empty(text_col))).withColumn("__h", hash_fn(F.col("__t")))
    shared = groups.groupBy("__h").count().filter("count > 1").select("__h")
    plain = groups.drop("__x")
    if has_rows(shared):
        # two texts on one hash: there the text itself decides
        by_text = (docs.select("__t", "__h").join(shared, "__h", "left_semi").distinct()
                   .withColumn("__sha", F.sha2("__t", 256)).withColumn("__x", F.xxhash64("__t"))
                   .join(groups, ["__h", "__sha", "__x"]).drop("__x"))
        out = (docs.join(shared, "__h", "left_anti").join(plain, "__h")
               .unionByName(docs.join(by_text, ["__h", "__t"])))
    else:
        out = docs.join(plain, "__h")
    out = out.withColumn("__kept", F.col("__id").eqNullSafe(F.col("__keep")))
    if has_rows(df.groupBy(col(id_col)).count().filter("count > 1")):
        # repeated ids: one row of each (text, id) stays
        w = Window.partitionBy("__h", "__sha", "__id").orderBy(F.lit(1))
        out = out.withColumn("__kept", F.col("__kept") & (F.row_number().over(w) == 1))
    return out.drop("__t", "__h")


def exact_labels(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 normalise: Callable[[Column], Column] = ascii_lower,
                 hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept`` and the
    SHA-256 of the normalised text."""
    narrow = df.select(col(id_col), col(text_col))
    out = _labelled(narrow, id_col, text_col, keep, normalise, hash_fn)
    return out.select(F.col("__id").alias(id_col), F.col("__keep").alias("keep_id"),
                      F.col("__n").cast("long").alias("group_size"), F.col("__kept").alias("kept"),
                      F.col("__sha").alias("text_sha256"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                normalise: Callable[[Column], Column] = ascii_lower,
                hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows that stay, with their own columns."""
    return unpacked(_labelled(df, id_col, text_col, keep, normalise, hash_fn).filter("__kept"), df.columns)
