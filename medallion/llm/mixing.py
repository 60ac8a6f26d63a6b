"""Temperature mixing of sources to target weights, by DataFrame functions only.

Weights.  A source's share of the tokens is raised to an exponent between 0 (all
sources equal) and 1 (as they are) and normalised.  Flatter weights mean more
entropy and more repetition of small sources.  The exponent is bisected, 32 ways
a round, to the flattest one within ``max_repeat`` (epochs of the most repeated
source), or, with ``min_entropy`` (nats), to the least flat one that reaches it;
where both are given the repetition limit has the last word.

Budget.  Without ``budget`` (tokens) it is the smallest at which every source is
taken once at least, so nothing is dropped.

Realisation.  A source of E epochs gives floor(E) whole copies of each document
and a part epoch: its documents in an order drawn from a hash, in 2^16 blocks of
that order.  Block sums find the block in which the quota ends, and only that
block's rows are ordered to find the last document inside the quota.  What a
source needs of this is one cut value, so documents are not shuffled for it.

Order of the mix.  Every epoch is a permutation of its own: a copy's hash of seed,
epoch and document gives its block, by the upper bits, and its place there.  The mix
is written epoch by epoch, block by block.

A null source is a source.  A document without a word (null text too) weighs one
token.  Rows that repeat id and text share their place in the order and are taken
together.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import col, n_words, packed, staged, text_or_empty, unpacked

BLOCK_BITS = 16
_WAYS, _ROUNDS = 32, 6
#: Sources up to which their table is broadcast; beyond, a shuffled join.
BROADCAST_SOURCES = 20_000


def _key(id_c: Column, text_c: Column, seed: int) -> Column:
    """Place in the source's order: 62 bits, the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_c, F.octet_length(text_c), F.crc32(F.encode(text_c, "UTF-8"))), 2)


def temperature_weights(totals: DataFrame, max_repeat: float | None = None, min_entropy: float | None = None,
                        budget: float | None = None) -> DataFrame:
    """``totals(source, tokens)`` with ``exponent``, ``weight``, ``quota`` (tokens)
    and ``epochs``."""
    whole = totals.agg(F.sum("tokens").cast("double").alias("t")).first()["t"] or 0.0
    p = totals.select((F.col("tokens") / F.lit(whole or 1.0)).alias("p"))

    def measured(grid: list[float]):
        a = p.select("p", F.explode(F.array(*map(F.lit, grid))).alias("a"))
        z, x = F.sum(F.expr("pow(p, a)")), F.expr("pow(p, a - 1)")
        entropy = F.log(z) - F.col("a") * F.sum(F.expr("pow(p, a) * ln(p)")) / z
        top = F.max(x) / (F.min(x) if budget is None else z * F.lit(whole / (budget or 1.0)))
        return a.groupBy("a").agg(entropy.alias("entropy"), top.alias("top")).orderBy("a").collect()

    def flattest(fits) -> float:
        """Smallest exponent that fits; what fits at one fits at all larger."""
        lo, hi = 0.0, 1.0
        for _ in range(_ROUNDS):
            rows = measured([lo + (hi - lo) * i / _WAYS for i in range(_WAYS + 1)])
            if not rows:
                return 1.0
            at = next((i for i, r in enumerate(rows) if fits(r)), len(rows) - 1)
            if at == 0:
                return rows[0]["a"]
            lo, hi = rows[at - 1]["a"], rows[at]["a"]
        return hi

    alpha = 1.0
    if min_entropy is not None:
        alpha = flattest(lambda r: r["entropy"] <= min_entropy)
    if max_repeat is not None:
        limit = flattest(lambda r: r["top"] <= max_repeat + 1e-12)
        alpha = limit if min_entropy is None else max(alpha, limit)
    d = totals.withColumn("__pw", F.pow(F.col("tokens") / F.lit(whole or 1.0), F.lit(alpha)))
    norm = d.agg(F.sum("__pw").alias("z"), F.max(F.col("tokens") / F.col("__pw")).alias("b")).first()
    z = norm["z"] or 1.0
    total = budget if budget is not None else (norm["b"] or 0.0) * z
    d = d.withColumn("weight", F.col("__pw") / F.lit(z))
    return d.select("source", "tokens", F.lit(alpha).alias("exponent"), "weight",
                    (F.col("weight") * F.lit(float(total))).alias("quota"),
                    (F.col("weight") * F.lit(float(total)) / F.col("tokens")).alias("epochs"))


def _cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``full`` epochs and ``cut``: the last place inside the part
    epoch's quota, -1 if none."""
    plan = plan.withColumn("full", F.floor(F.col("epochs") + 1e-9).cast("long"))
    plan = plan.withColumn("rest", F.greatest(F.lit(0.0), F.col("quota") - F.col("full") * F.col("tokens")))
    block = F.shiftright("key", 62 - BLOCK_BITS).alias("block")
    need = plan.filter("rest > 0").select(F.col("source").alias("s"), "rest")
    sums = rows.groupBy("source", block).agg(F.sum("n").alias("n"), F.max("key").alias("last"))
    run = Window.partitionBy("source").orderBy("block")
    sums = sums.withColumn("end", F.sum("n").over(run))
    sums = sums.join(need, sums["source"].eqNullSafe(need["s"]))
    inside = sums.filter("end <= rest").groupBy("source").agg(F.max("last").alias("cut"))
    split = sums.filter("end > rest and end - n < rest").select(F.col("source").alias("s"), "block", "rest",
                                                                  (F.col("end") - F.col("n")).alias("before"))
    cells = rows.withColumn("block", block)
    cells = cells.join(split, cells["source"].eqNullSafe(split["s"]) & (cells["block"] == split["block"]))
    upto = Window.partitionBy("source").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    some = (cells.select("source", "key", "n", "rest", "before").withColumn("end", F.col("before") + F.sum("n").over(upto))
            .filter("end <= rest").groupBy("source").agg(F.max("key").alias("cut")))
    cut = (inside.unionByName(some).groupBy(F.col("source").alias("c")).agg(F.max("cut").alias("cut")))
    return (plan.join(cut, plan["source"].eqNullSafe(cut["c"]), "left")
            .select("source", "weight", "epochs", "full", F.coalesce("cut", F.lit(-1)).alias("cut")))


def _mixed(df: DataFrame, id_col, text_col, source_col, seed, **targets) -> DataFrame:
    """``df`` with ``__source __n __key __weight __epochs __copies``."""
    d = df.withColumn("__source", col(source_col)).withColumn("__text", text_or_empty(text_col))
    d = d.withColumn("__n", F.greatest(n_words(F.col("__text")), F.lit(1)).cast("long"))
    d = d.withColumn("__key", _key(col(id_col), F.col("__text"), seed)).drop("__text")
    rows = staged(d.select(F.col("__source").alias("source"), F.col("__key").alias("key"), F.col("__n").alias("n")), "mix-rows")
    totals = staged(rows.groupBy("source").agg(F.sum("n").alias("tokens")), "mix-totals")
    plan = staged(_cuts(rows, temperature_weights(totals, **targets)), "mix-plan")
    plan = plan.select(F.col("source").alias("__s"), F.col("weight").alias("__weight"), F.col("epochs").alias("__epochs"),
                       F.col("full").alias("__full"), F.col("cut").alias("__cut"))
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    out = d.join(plan, d["__source"].eqNullSafe(plan["__s"]))
    return out.withColumn("__copies", F.col("__full") + F.when(F.col("__key") <= F.col("__cut"), 1).otherwise(0))


DEFAULT_REPEAT = 1.25


def mixing_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  seed: int = 17, max_repeat: float | None = DEFAULT_REPEAT, min_entropy: float | None = None,
                  budget: float | None = None) -> DataFrame:
    """One row per document: its source's weight and epochs, its copies in the
    mix, and its block and place in the part epoch's order."""
    narrow = df.select(col(id_col), col(text_col), col(source_col))
    d = _mixed(narrow, id_col, text_col, source_col, seed, max_repeat=max_repeat, min_entropy=min_entropy, budget=budget)
    return d.select(col(id_col), col(source_col), F.col("__n").alias("n_tokens"), F.col("__weight").alias("weight"),
                    F.col("__epochs").alias("epochs"), F.col("__copies").cast("long").alias("copies"),
                    F.shiftright("__key", 62 - BLOCK_BITS).cast("int").alias("block"), F.col("__key").alias("place"))


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  seed: int = 17, max_repeat: float | None = DEFAULT_REPEAT, min_entropy: float | None = None,
                  budget: float | None = None) -> DataFrame:
    """The mix: every document as often as it has copies, with its own columns, in
    the block order of each epoch."""
    rows = packed(df, __doc=col(id_col), __in=col(text_col), __from=col(source_col))
    d = _mixed(rows, "__doc", "__in", "__from", seed, max_repeat=max_repeat, min_entropy=min_entropy, budget=budget)
    d = d.filter("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("__copy"), F.col("__key")), 2)
    d = d.withColumn("__place", place).orderBy("__copy", F.shiftright("__place", 62 - BLOCK_BITS), "__place")
    return unpacked(d, df.columns)
