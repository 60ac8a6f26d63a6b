import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from medallion.llm.sharding import _Order, shard_cuts, shard_rows
from tests.llm.helpers import documents, prose


def smallest(sizes, k):
    lo, hi = max(sizes, default=0), sum(sizes)
    while lo < hi:
        mid, used, fill = (lo + hi) // 2, 1, 0
        for s in sizes:
            used, fill = (used, fill + s) if fill + s <= mid else (used + 1, s)
        lo, hi = (lo, mid) if used <= k else (mid + 1, hi)
    return lo


def test_capacity_is_the_smallest_with_few_ranges_in_sight(spark):
    rnd = random.Random(4)
    for n, k, hot in ((500, 8, 0), (500, 8, 4000), (40, 5, 90), (3, 8, 0)):
        sizes = {rnd.randrange(1 << 62): rnd.randint(1, 60) for _ in range(n)}
        if hot:
            sizes[rnd.choice(list(sizes))] = hot
        keys = spark.createDataFrame(list(sizes.items()), "key long, size long")
        cuts = shard_cuts(keys, k, atoms=64)
        got = defaultdict(int)
        for key, s in sizes.items():
            got[sum(key >= c for c in cuts)] += s
        ordered = [s for _, s in sorted(sizes.items())]
        assert max(got.values()) == smallest(ordered, k)
        assert len(got) == min(n, k)  # no shard is left empty
    assert _Order([]).cuts(3) == [0, 0]


def test_rows(spark):
    texts = [prose(k % 70, 5 + k % 30) for k in range(300)] + [None, "", "é", "é"]
    df = documents(spark, texts, ids=[*range(len(texts) - 1), None]).withColumn("shard", F.lit("clash"))
    rows = shard_rows(df, 8, cell_rows=3).collect()
    assert len(rows) == len(texts)
    text_of = dict(zip([*range(len(texts) - 1), None], texts))
    shard_of, slots = {}, defaultdict(list)
    for r in rows:
        t = text_of[r.doc_id] or ""
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None)
        assert shard_of.setdefault(t, r.shard) == r.shard
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_rows(df.filter("false"), 8).count() == 0
    twice = documents(spark, ["a", "a", "a"], ids=[1, 1, 1])
    assert sorted(r.slot for r in shard_rows(twice, 2).collect()) == [0, 1, 2]
