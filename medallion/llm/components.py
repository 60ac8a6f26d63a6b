"""Connected components by alternating star contractions.

Each round re-points every node's neighbours at the smallest node it sees, first
over larger neighbours, then over smaller ones; edges become stars in a few
rounds, logarithmic in the longest path.  Minima combine before the shuffle and
the joins of narrow rows are ones adaptive execution can split, so a node with
very many links is no single task.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    flip = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    # large: every neighbour of u counts for the minimum, the larger ones move;
    # small: only smaller neighbours count, and u moves with them
    near = edges.unionByName(flip) if large else edges
    least = near.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = near.filter("b > a") if large else near
    out = moved.join(least, moved["a"] == least["u"]).select(F.col("b").alias("x"), F.col("m").alias("y"))
    if not large:
        out = out.unionByName(least.select(F.col("u").alias("x"), F.col("m").alias("y")))
    # a is the larger end
    return (out.filter("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)`` that is not the
    smallest of its component; the smallest is the root.  No edges, no rows.
    Repeated edges, loops and edges with a null end change nothing."""
    now = staged(edges.select("a", "b").filter("a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    mark = _mark(now)
    while mark[0]:
        now = staged(_star(_star(now, True), False), "cc")
        seen = _mark(now)
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(edges: DataFrame):
    """Count and two digests that tell one set of edges from another."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())
