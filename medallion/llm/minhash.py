"""Near-duplicate classes by BagMinHash signatures over multisets of shingles.

Signature.  A text is the multiset of its five-word shingles.  The weight axis of
a shingle is cut into dyadic blocks [0,1) [1,2) [2,4) ...; each block is a Poisson
process whose points carry a time, a register and a place inside the block, all
drawn from a hash of (shingle, block, point).  A point counts if its place is
below the shingle's weight, and a register keeps its earliest time.  Two texts
agree in a register with the probability of their weighted Jaccard similarity.
Processes advance together and stop once their time passes the latest register.

Candidates.  Bands of registers form buckets; texts that share one are candidates.
Verification.  A bucket is dealt in blocks of a bounded number of texts and shingles; inside
a block texts of different classes are compared, first by registers, then by the exact
overlap of their multisets, and each link merges two classes.  The text most like the
others (its *hub*) is compared first, so copies of one text are one class after one look at
each; pairs already in one class are skipped, since no link between them can change a
class.  Overlaps of a text with all its candidates are counted in one vectorised step.
Buckets whose texts all share a class are done.  Of the others, those of several blocks go
on: their hubs meet every block; then the texts outside the bucket's largest class (guests)
meet every block of it, themselves dealt in blocks.  Where guests are more than a block, only
texts that can have a link take part: of its rarest shingles each text gives so many that a
pair at the threshold shares one, and a text that shares none with another class is out.  No
pair that shares a bucket and lies in two classes is left out.

Equal texts (A-Z lower-cased) count once in all this.  Null text is empty.  Texts
of fewer than five words are one shingle; texts without a word have none and are
alike only to equal texts.  Ties for the document kept go to the smallest id; of
rows that repeat an id and a text one is kept.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import ascii_lower, col, has_rows, packed, staged, text_or_empty, unpacked
from medallion.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
#: Texts and shingles in a block; hubs that a bucket of several blocks sends to each; registers
#: that must agree before texts are compared (0.6 of them, 4.5 standard deviations below the
#: threshold).
BLOCK, BLOCK_SHINGLES, HUBS, AGREE = 2048, 1 << 19, 16, int(0.6 * REGISTERS)
_MEMO = 300_000

_K1, _K2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K1
    x = (x ^ (x >> np.uint64(27))) * _K2
    return x ^ (x >> np.uint64(31))


def _step(n: int) -> np.uint64:
    return np.uint64(n * int(_GOLD) % 2**64)


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


class _Words(dict):
    """Word → 64-bit hash, forgetting all when it is full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _MEMO:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def shingles(text: str) -> np.ndarray:
    """Hashes of the text's shingles in order, with repeats."""
    split = text.encode("utf-8").lower().split()  # bytes: A-Z, and the six ASCII spaces
    h = np.fromiter(map(_words.__getitem__, split), np.uint64, len(split))
    k = min(SHINGLE, len(h))
    if not k:
        return h
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = _mix(out + _GOLD + h[i:len(h) - k + 1 + i])
    return out


def signatures(weights: list[tuple[np.ndarray, np.ndarray]], m: int = REGISTERS) -> np.ndarray:
    """Register times (texts × m) of multisets given as (hashes, counts)."""
    sizes = np.array([len(h) for h, _ in weights])
    times = np.full((len(weights), m), np.inf)
    if not sizes.sum():
        return times
    doc = np.repeat(np.arange(len(weights)), sizes)
    elem, w = np.concatenate([h for h, _ in weights]), np.concatenate([c for _, c in weights]).astype(np.int64)
    parts = [(elem, doc, np.zeros(len(elem)), np.ones(len(elem)), w)]
    low = 1
    while (more := w > low).any():
        elem, doc, w = elem[more], doc[more], w[more]
        parts.append((_mix(elem + _step(low)), doc, np.full(len(elem), float(low)), np.full(len(elem), float(low)), w))
        low *= 2
    seed, doc, start, width, w = (np.concatenate(x) for x in zip(*parts))
    now, point = np.zeros(len(seed)), 0
    while len(seed):
        point += 1
        draw = _mix(seed + _step(point))
        now = now - np.log(_unit(draw)) / (m * width)
        other = _mix(draw ^ _K2)
        hit = (width == 1.0) | (start + _unit(_mix(other ^ _K1)) * width <= w)
        np.minimum.at(times, (doc[hit], (other % np.uint64(m)).astype(np.int64)[hit]), now[hit])
        live = now < times.max(axis=1)[doc]
        seed, doc, start, width, w, now = seed[live], doc[live], start[live], width[live], w[live], now[live]
    return times


def _bag(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(h, return_counts=True)


def _prints(times: np.ndarray) -> np.ndarray:
    return _mix(times.view(np.uint64) + _GOLD)


def _numbered(h: np.ndarray) -> np.ndarray:
    """Each occurrence of a shingle as an element of its own, sorted."""
    h = np.sort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    place = np.arange(len(h))
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    return np.sort(np.where(nth > 0, _mix(h + nth.astype(np.uint64) * _GOLD), h))


def _signed(batches: Iterator[pa.RecordBatch], full: bool) -> Iterator[pa.RecordBatch]:
    """node → buckets; with ``full`` also register bytes and numbered shingles."""
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            hs = [shingles(t.as_py()) for t in part.column(1)]
            prints = _prints(signatures([_bag(h) for h in hs]))
            if full:
                sig = (prints >> np.uint64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s.tobytes() for s in sig], pa.binary()),
                     pa.array([_numbered(h).tobytes() for h in hs], pa.binary())], names=["node", "sig", "bag"])
                continue
            keys = np.zeros((len(hs), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for r in range(ROWS):
                keys = _mix(keys + _GOLD + prints[:, r::ROWS])
            rows = [k if len(h) else None for k, h in zip(keys.view(np.int64), hs)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(h) for h in hs], pa.int64()), pa.array(rows, pa.list_(pa.int64()))],
                                             names=["node", "size", "buckets"])


def _numbers(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each bag's elements as small numbers, one bag after the other, and where bags begin."""
    ids = np.unique(np.concatenate(bags), return_inverse=True)[1].astype(np.int32)
    return ids, np.concatenate([[0], np.cumsum([len(x) for x in bags])])


def _overlaps(ids: np.ndarray, at: np.ndarray, flags: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """How many elements bag ``i`` has in common with each of ``others``."""
    mine = ids[at[i]:at[i + 1]]
    flags[mine] = 1
    sizes = at[others + 1] - at[others]
    first = np.cumsum(sizes) - sizes
    place = np.repeat((at[others] - first).astype(np.int32), sizes) + np.arange(int(sizes.sum()), dtype=np.int32)
    both = np.add.reduceat(flags[ids[place]], first)
    flags[mine] = 0
    return both


def _links(group: pa.Table) -> pa.Table:
    """Class merges found in one block, and its hub; where it has ``guest`` rows, merges
    between a guest and another row."""
    names, guest = group.column("comp").to_pylist(), np.array(group.column("guest").to_pylist(), bool)
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(names), REGISTERS)
    bags = [np.frombuffer(x, np.uint64) for x in group.column("bag").to_pylist()]
    ids, at = _numbers(bags)
    flags = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int32)
    size = np.diff(at).astype(float)
    mixed = guest.any()
    # how many registers hold the value that most texts hold there
    usual = np.array([np.bincount(sig[:, r], minlength=256).argmax() for r in range(REGISTERS)], np.uint8)
    score = (sig == usual).sum(axis=1)
    order = np.argsort(-score, kind="stable")
    index: dict[str, int] = {}
    label = np.array([index.setdefault(n, len(index)) for n in names])
    out = []
    for k, i in enumerate(order[:-1]):
        rest = order[k + 1:]
        rest = rest[label[rest] != label[i]]
        if mixed:
            rest = rest[guest[rest] != guest[i]]
        ratio = np.minimum(size[rest], size[i]) / np.maximum(size[rest], size[i])
        rest = rest[ratio >= THRESHOLD - 1e-9]
        rest = rest[(sig[rest] == sig[i]).sum(axis=1) >= AGREE]
        if not len(rest):
            continue
        both = _overlaps(ids, at, flags, i, rest)
        for j in rest[both >= THRESHOLD * (size[i] + size[rest] - both) - 1e-9]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append({"a": max(names[i], names[j]), "b": min(names[i], names[j])})
    hub = int(order[0])
    out.append({"bucket": group.column("bucket")[hub].as_py(), "node": group.column("node")[hub].as_py(), "score": int(score[hub])})
    return pa.Table.from_pylist(out, pa.schema([("a", pa.string()), ("b", pa.string()), ("bucket", pa.int64()), ("node", pa.string()),
                                                ("score", pa.int64())]))


def _linked(rows: DataFrame, bags: DataFrame) -> DataFrame:
    """Merges ``(a, b)`` and, where a is null, hubs ``(bucket, node, score)``."""
    found = rows.join(bags, "node").select("bucket", "block", "node", "comp", "guest", "sig", "bag").groupBy("bucket", "block")
    return staged(found.applyInArrow(_links, "a string, b string, bucket long, node string, score long"), "near-links")


def _merged(comps: DataFrame, edges: DataFrame) -> DataFrame:
    roots = components(edges.filter("a is not null").select("a", "b"))
    out = comps.join(roots, comps["comp"] == roots["node"], "left")
    return staged(out.select(comps["node"], F.coalesce("root", "comp").alias("comp")), "near-comp")


def _blocks(n: str, shingles: str, block: int) -> Column:
    return F.ceil(F.greatest(F.col(n) / block, F.col(shingles) / BLOCK_SHINGLES)).cast("int")


def _open(members: DataFrame, comps: DataFrame, block: int) -> DataFrame:
    """Members of buckets that hold two classes or more, with their block."""
    m = members.join(comps, "node")
    sizes = (m.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("all"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
             .filter("c0 < c1").select("bucket", _blocks("n", "all", block).alias("blocks")))
    return m.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int"))


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            bags = [np.frombuffer(x, np.int64) for x in part.column(1).to_pylist()]
            node = np.repeat(np.arange(len(bags)), [len(x) for x in bags])
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(node)), pa.array(np.concatenate(bags))], names=["node", "shingle"])


def _prefixes(bags: DataFrame) -> DataFrame:
    """``(node, shingle)``: of each text its rarest shingles (by count, then value), as
    many as can be left out at the threshold and one more.  Alike texts share one."""
    rows = staged(bags.select("node", "bag").mapInArrow(_shingle_rows, "node string, shingle long"), "near-shingles")
    known = rows.join(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")), "shingle")
    held = known.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("all"))
    n = F.size("all")
    given = F.slice("all", F.lit(1), n - F.ceil(n * THRESHOLD - 1e-6).cast("int") + 1)
    return held.select("node", F.explode(given).alias("s")).select("node", "s.shingle")


def _hubs_met(wide: DataFrame, links: DataFrame) -> DataFrame:
    """Rows that bring the hubs of a bucket's blocks to all its blocks, as guests."""
    w = Window.partitionBy("bucket").orderBy(F.col("score").desc(), "node")
    hubs = (links.filter("a is null").join(wide.select("bucket").distinct(), "bucket", "left_semi").select("bucket", "node", "score").distinct()
            .withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= HUBS).select("bucket", "node"))
    homes = wide.select("bucket", "node", "comp", "block", F.lit(False).alias("guest"))
    named = hubs.join(wide.select("bucket", "node", "comp", "blocks"), ["bucket", "node"])
    away = named.select("bucket", "node", "comp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("guest"))
    return homes.unionByName(away)


def _guests(wide: DataFrame) -> DataFrame:
    """``wide(bucket, node, comp, size)`` with ``guest`` (outside the largest class), the
    numbers of texts ``n`` and guests ``g`` of the bucket, and their shingles."""
    counts = wide.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("count"), F.sum("size").alias("size"))
    main = counts.groupBy("bucket").agg(F.max_by("comp", F.struct("count", "comp")).alias("main"), F.sum("count").alias("n"),
                                        (F.sum("count") - F.max("count")).alias("g"), F.sum("size").alias("n_size"),
                                        (F.sum("size") - F.max_by("size", F.struct("count", "comp"))).alias("g_size"))
    return wide.select("bucket", "node", "comp", "size").join(main, "bucket").withColumn("guest", F.col("comp") != F.col("main")).drop("main")


def _wide_live(wide: DataFrame, bags: DataFrame, block: int) -> DataFrame:
    """``wide`` without the texts that can have no link to another class, where a bucket
    has more guests than a block holds.  A text and its shingles are looked at once,
    however many buckets it is in."""
    rows = staged(_guests(wide), "near-guests")
    few, many = rows.filter(F.col("g") <= block), rows.filter(F.col("g") > block)
    if not has_rows(many):
        return wide
    nodes = many.select("node", "comp").distinct()
    given = staged(_prefixes(bags.join(nodes, "node", "left_semi")), "near-prefixes")
    met = given.join(nodes, "node")
    both = met.groupBy("shingle").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1").select("shingle")
    live = met.join(both, "shingle", "left_semi").select("node").distinct()
    kept = many.join(live, "node", "left_semi")
    return staged(few.unionByName(kept).select("bucket", "node", "comp", "size"), "near-live")


def _dealt(wide: DataFrame, block: int) -> DataFrame:
    """Every guest of a bucket to every block of its texts, both in blocks of bounded size."""
    r = _guests(wide)
    r = (r.withColumn("homes", _blocks("n", "n_size", block)).withColumn("stays", _blocks("g", "g_size", block))
         .withColumn("home", F.pmod(F.xxhash64("node", "bucket"), F.col("homes")).cast("int"))
         .withColumn("stay", F.pmod(F.xxhash64("bucket", "node", F.lit(1)), F.col("stays")).cast("int"))
         .filter("stays > 0"))
    home = (r.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("stays") - 1)))
            .select("bucket", "node", "comp", F.struct(F.col("home"), F.col("to").alias("stay")).alias("block"), F.lit(False).alias("guest")))
    away = (r.filter("guest").withColumn("to", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)))
            .select("bucket", "node", "comp", F.struct(F.col("to").alias("home"), F.col("stay")).alias("block"), F.lit(True).alias("guest")))
    return home.unionByName(away)


def near_classes(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(node, comp)`` for the texts of ``nodes(node, text)`` that share a
    bucket with another text: the smallest node of each class names it."""
    signed = staged(nodes.mapInArrow(lambda b: _signed(b, False), "node string, size long, buckets array<long>")
                    .filter("buckets is not null").dropDuplicates(["node"]), "near-sig")
    rows = signed.select("node", "size", F.posexplode("buckets").alias("band", "bucket"))
    shared = rows.groupBy("bucket").count().filter("count > 1").select("bucket")
    members = staged(rows.join(shared, "bucket"), "near-members")
    comps = members.select("node").distinct().select("node", F.col("node").alias("comp"))
    found = nodes.join(members.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    bags = staged(found.mapInArrow(lambda b: _signed(b, True), "node string, sig binary, bag binary"), "near-bags")
    links = None
    for lo, hi in ((0, 4), (4, BANDS)):
        few = members.filter((F.col("band") >= lo) & (F.col("band") < hi)).drop("band")
        seen = _linked(_open(few, comps, block).withColumn("guest", F.lit(False)), bags)
        comps = _merged(comps, seen)
        links = seen if links is None else links.unionByName(seen)
    wide = staged(_open(members.drop("band"), comps, block).filter("blocks > 1"), "near-wide")
    if has_rows(wide):
        comps = _merged(comps, _linked(_hubs_met(wide, links), bags))
        wide = staged(_open(members.drop("band"), comps, block).filter("blocks > 1").select("bucket", "node", "comp", "size"), "near-wide")
    if has_rows(wide):
        comps = _merged(comps, _linked(_dealt(_wide_live(wide, bags, block), block), bags))
    return comps


def _nodes(df: DataFrame, text_col: str):
    return df.withColumn("__t", ascii_lower(text_or_empty(text_col))).withColumn("__node", F.md5("__t"))


def near_labels(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``__node`` and, per row, id, ``class_id`` (smallest id of the class),
    ``class_size`` and ``kept``."""
    src = _nodes(df.select(col(id_col).alias("__id"), col(text_col).alias("__in")), "__in")
    comps = near_classes(src.select(F.col("__node").alias("node"), F.col("__t").alias("text")), block)
    rows = src.select("__id", "__node")
    rows = rows.join(comps, rows["__node"] == comps["node"], "left").select(
        "__id", "__node", F.coalesce("comp", "__node").alias("__comp"))
    rows = staged(rows, "near-rows")
    classes = staged(rows.groupBy("__comp").agg(F.min(F.struct(F.col("__id").isNull().alias("no"), "__id", "__node")).alias("__first"),
                                                F.count(F.lit(1)).alias("class_size")), "near-classes")
    out = rows.join(classes, "__comp")
    kept = (F.col("__id").eqNullSafe(F.col("__first.__id")) & (F.col("__node") == F.col("__first.__node")))
    return out.select(F.col("__id").alias(id_col), F.col("__first.__id").alias("class_id"), "class_size",
                      kept.alias("kept"), "__node")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One document of each class, with its own columns."""
    kept = (near_labels(df, id_col, text_col, block).filter("kept")
            .select(F.col(id_col).alias("__id"), "__node").distinct())
    docs = packed(df, __key=col(id_col), __in=col(text_col))
    docs = _nodes(docs, "__in").select("__row", "__key", F.col("__node").alias("__of"))
    out = docs.join(kept, (docs["__of"] == kept["__node"]) & docs["__key"].eqNullSafe(kept["__id"]), "left_semi")
    if has_rows(df.groupBy(col(id_col)).count().filter("count > 1")):
        w = Window.partitionBy("__of", "__key").orderBy(F.lit(1))
        out = out.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
    return unpacked(out, df.columns)
