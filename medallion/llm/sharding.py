"""Minimax contiguous partition of atomic groups into shards, DataFrame functions only.

Rows of equal text are one atomic group; groups lie in the order of a 62-bit hash
of the text (two texts with one hash share a group).  The smallest shard capacity
that covers the order with ``n_shards`` contiguous runs is found by binary search,
each capacity checked greedily.

The groups themselves never reach the driver.  It sees the order cut into at most
``ATOMS`` hash ranges with their summed sizes; whatever the greedy walk could do
inside a range is bounded by the range's two ends, and only ranges in which a cut
of some still possible capacity may lie are split further, until each of them is
a single group.  The number of ranges does not grow with the data.

Cuts.  Under that capacity each shard takes what is nearest an even share of the
rest, as long as the rest still fits, so a group above the even share does not
leave other shards empty.

Slots are dealt inside (shard, id hash) cells of bounded size: cell counts give
each cell's first slot and only cells are ordered, so no shard is one task.

Null text has no bytes; a row's size is its UTF-8 bytes plus one.  Rows that repeat
id and text are distinct rows with slots of their own.  Fewer groups than shards
leave shards empty; an empty table gives an empty result; other columns are not read.
Up to ``MAX_SHARDS`` (256) shards: every open cut keeps ranges on the driver, so more
raise ``ValueError``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import col, staged

KEY_BITS = 62
ATOMS = 1 << 16
MAX_SHARDS = 256
CELL_ROWS = 50_000


class _Order:
    """Ranges of the order with their sizes; ``single`` ones cannot be cut."""

    def __init__(self, atoms: list[tuple[int, int, int, bool]]):
        self.atoms = atoms  # (first key, key bits left, size, single)
        self.ends = list(accumulate((a[2] for a in atoms)))
        self.total = self.ends[-1] if atoms else 0

    def reach(self, position: int) -> int:
        """Last boundary at or before ``position``."""
        i = bisect_right(self.ends, position)
        return self.ends[i - 1] if i else 0

    def feasible(self, capacity: int, shards: int) -> bool:
        at = 0
        for _ in range(shards):
            at = self.reach(at + capacity)
            if at >= self.total:
                return True
        return False

    def capacity(self, shards: int) -> int:
        """Smallest feasible capacity with cuts at these ranges' ends."""
        lo, hi = max([-(-self.total // shards), 0]), self.total
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.feasible(mid, shards) else (mid + 1, hi)
        return lo

    def open_ranges(self, shards: int) -> list[int]:
        """Ranges to split: the best capacity is between ``best - widest`` and
        ``best``, and a greedy cut of such a capacity may fall into them."""
        widest = max((a[2] for a in self.atoms if not a[3]), default=0)
        best = self.capacity(shards)
        low = high = 0
        out: set[int] = set()
        for _ in range(shards):
            low = self.reach(low + max(best - widest, 0))
            high = min(high + best, self.total)
            first, last = bisect_right(self.ends, low), bisect_left(self.ends, high)
            out.update(i for i in range(first, min(last + 1, len(self.atoms))) if not self.atoms[i][3])
        return sorted(out)

    def cuts(self, shards: int) -> list[int]:
        """End position of each shard but the last, as even as the capacity allows."""
        capacity = self.capacity(shards)
        starts = [0, *self.ends]
        need = [self.total] * (shards + 1)  # need[k]: earliest start that k shards still cover
        for k in range(1, shards + 1):
            need[k] = starts[bisect_left(starts, need[k - 1] - capacity)]
        at, out = 0, []
        for left in range(shards, 1, -1):
            most = self.reach(at + capacity)
            aim = at + (self.total - at) / left
            i = bisect_left(starts, aim)
            near = min(starts[max(i - 1, 0):i + 1], key=lambda x: abs(x - aim))
            at = max(min(max(near, need[left - 1]), most), at)
            out.append(at)
        return out


def _ranges(keys: DataFrame, prefix_bits: int, bits: int, chosen: list[int] | None):
    """Sizes of the ranges of ``prefix_bits + bits`` leading bits, inside the
    chosen prefixes; a bounded number of rows."""
    rest = KEY_BITS - prefix_bits - bits
    d = keys
    if chosen is not None:
        d = d.filter(F.shiftright("key", KEY_BITS - prefix_bits).isin(chosen))
    out = (d.groupBy(F.shiftright("key", rest).alias("range"))
           .agg(F.sum("size").alias("size"), (F.min("key") == F.max("key")).alias("single")))
    return [(r["range"] << rest, rest, r["size"], r["single"] or rest == 0) for r in out.collect()]


def shard_cuts(keys: DataFrame, n_shards: int, atoms: int = ATOMS) -> list[int]:
    """First key of shards 1..n-1 for ``keys(key, size)``: rows with
    ``key >= cut`` lie in that shard or a later one."""
    if not 1 <= n_shards <= MAX_SHARDS:
        raise ValueError(f"n_shards must be 1 to {MAX_SHARDS}, not {n_shards}")
    bits = min(atoms.bit_length() - 3, KEY_BITS)
    order = _Order(sorted(_ranges(keys, 0, bits, None)))
    while wanted := order.open_ranges(n_shards):
        # all ranges still open are split by the same number of further bits
        rest = max(order.atoms[i][1] for i in wanted)
        wanted = [i for i in wanted if order.atoms[i][1] == rest]
        step = max(1, min(rest, (atoms // len(wanted)).bit_length() - 1))
        prefixes = [order.atoms[i][0] >> rest for i in wanted]
        finer = _ranges(keys, KEY_BITS - rest, step, prefixes)
        skip = set(wanted)
        order = _Order(sorted([a for i, a in enumerate(order.atoms) if i not in skip] + finer))
    starts = [0, *order.ends]
    firsts = [a[0] for a in order.atoms] + [1 << KEY_BITS]
    return [firsts[bisect_left(starts, at)] for at in order.cuts(n_shards)]


def _text(c: str):
    return F.coalesce(col(c).cast("string"), F.lit(""))


def shard_rows(df: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
               atoms: int = ATOMS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per input row: id, ``size``, ``text_crc32``, ``law``, ``shard``,
    ``slot`` and ``grown_shard`` (null: capacities are found for a fixed number)."""
    t = _text(text_col)
    rows = staged(df.select(col(id_col).alias("id"), (F.octet_length(t) + 1).cast("long").alias("size"),
                            F.crc32(F.encode(t, "UTF-8")).alias("crc"),
                            F.shiftrightunsigned(F.xxhash64(t), 64 - KEY_BITS).alias("key")), "shard-rows")
    cuts = shard_cuts(rows, n_shards, atoms)
    shard = sum((F.when(F.col("key") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    cells = max(1, -(-rows.count() // (cell_rows * n_shards)) * 4)
    rows = rows.withColumn("shard", shard.cast("int")).withColumn("cell", F.pmod(F.xxhash64("id", "key"), F.lit(cells)))
    counts = rows.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell")
    first = counts.select("shard", "cell", (F.sum("n").over(before) - F.col("n")).alias("first"))
    inside = Window.partitionBy("shard", "cell").orderBy("key", "id")
    out = rows.withColumn("rn", F.row_number().over(inside)).join(first, ["shard", "cell"])
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                      "shard", (F.col("first") + F.col("rn") - 1).cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))
