from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from medallion.llm.minhash import near_dedup, near_labels, shingles, signatures, _bag
from tests.llm.helpers import ascii_lower, documents, prose


def brute(rows):
    bags = [Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if (w := ascii_lower(t or "").split()) else None
            for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same = ascii_lower(rows[a][1] or "") == ascii_lower(rows[b][1] or "")
            if not same and bags[a] and bags[b]:
                same = sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values())
            if same:
                up[root(a)] = root(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(k)
    return {tuple(sorted(g)) for g in groups.values()}


def edited(text, places):
    w = text.split()
    for p in places:
        w[p] = "edit%d" % p
    return " ".join(w)


def family(n):
    """Copies of one text, each with other words changed: near the original, less
    near each other."""
    base = prose(9, 150)
    return [base] + [edited(base, [(k * 7) % 140, (k * 13 + 3) % 150]) for k in range(n)]


def test_classes_against_brute_force(spark):
    texts = family(60) + [prose(k, 80) for k in range(20)] + [prose(3, 80).upper(), None, "", "one two", "One  two", "solo"]
    texts += ["This " * 300, "This " * 310, "This " * 900]  # weights decide
    df = documents(spark, texts).withColumn("class_id", F.lit(1)).repartition(5)
    got = defaultdict(list)
    for r in near_labels(df, block=16).collect():
        got[r.class_id].append(r.doc_id)
        assert r.kept == (r.doc_id == r.class_id)
    assert {tuple(sorted(g)) for g in got.values()} == brute(list(enumerate(texts)))


def test_one_of_each_class_stays(spark):
    df = documents(spark, [*family(5), prose(1, 60), prose(1, 60), None], ids=[9, 8, 7, 6, 5, 4, 3, 3, None])
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in near_dedup(df).collect()) == [-1, 3, 4]
    assert near_dedup(df).columns == df.columns
    assert near_dedup(df.filter("false")).count() == 0


def test_registers_estimate_weighted_similarity():
    a, b = "x y " * 400 + prose(1, 400), "x y " * 100 + prose(1, 400) + " " + prose(2, 100)
    bags = [Counter(shingles(t).tolist()) for t in (a, b)]
    true = sum((bags[0] & bags[1]).values()) / sum((bags[0] | bags[1]).values())
    t = signatures([_bag(shingles(x)) for x in (a, b)], 4000)
    assert abs(np.mean(t[0] == t[1]) - true) < 0.04


def test_wide_bucket_of_many_classes(spark, monkeypatch):
    """Texts of one template below the threshold share buckets and stay classes of
    their own; no task holds a bucket, and links across blocks are found."""
    from medallion.llm import minhash

    base, texts = prose(9, 150).split(), []
    for k in range(110):
        texts.append(" ".join(base[:60] + prose(100 + k, 20).split() + base[80:]))
    texts += [edited(t, [149]) for t in texts[:12]]
    groups, dealt = [], minhash._linked

    def seen(rows, bags):
        groups.append(rows.groupBy("bucket", "block").count().agg(F.max("count")).first()[0] or 0)
        return dealt(rows, bags)

    monkeypatch.setattr(minhash, "_linked", seen)
    got = defaultdict(list)
    for r in near_labels(documents(spark, texts).repartition(3), block=8).collect():
        got[r.class_id].append(r.doc_id)
    want = brute(list(enumerate(texts)))
    assert {tuple(sorted(g)) for g in got.values()} == want and len(want) == 110
    # two passes inside blocks, the hubs, and guests against blocks
    assert len(groups) == 4 and max(groups) <= 32


def test_guests_are_dealt_in_blocks(spark):
    from medallion.llm.minhash import _dealt

    wide = spark.range(300).selectExpr("7L as bucket", "cast(id as string) as node", "if(id < 20, '0', cast(id as string)) as comp", "1L as size")
    groups, met = defaultdict(list), set()
    for r in _dealt(wide, 16).collect():
        groups[r.block].append(r)
    for rows in groups.values():
        assert len(rows) <= 80
        met |= {frozenset((a.comp, b.comp)) for a in rows for b in rows if a.guest and not b.guest and a.comp != b.comp}
    assert len(met) == 281 * 280 // 2


def test_template_texts_take_bounded_work(spark, monkeypatch):
    """2,000 texts of one template: copies of the template are one class, texts that
    share four fifths of it stay apart, and rows and overlaps stay few."""
    from medallion.llm import minhash

    base = prose(9, 150).split()
    near = [" ".join(base[:k % 140] + ["edit%d" % k] + base[k % 140 + 1:]) for k in range(1500)]
    far = [" ".join(base[:60] + prose(1000 + k, 20).split() + base[80:]) for k in range(500)]
    met, dealt = [], minhash._linked

    def seen(rows, bags):
        met.append(rows.count())
        return dealt(rows, bags)

    monkeypatch.setattr(minhash, "_linked", seen)
    got = Counter(r.class_id for r in near_labels(documents(spark, [" ".join(base), *near, *far]).repartition(4)).collect())
    assert sorted(got.values()) == [1] * 500 + [1501]
    # a text is looked at once a bucket: at most 20 rows each over all passes but the last
    assert sum(met) <= 20 * 2001


def test_hub_makes_copies_one_class_at_once():
    """In a block of copies the first row, the hub, links them all."""
    import pyarrow as pa

    from medallion.llm import minhash

    base = prose(4, 200)
    texts = [base] + [edited(base, [k % 200, (7 * k + 3) % 200]) for k in range(400)]
    hs = [shingles(t) for t in texts]
    sig = (minhash._prints(signatures([_bag(h) for h in hs])) >> np.uint64(56)).astype(np.uint8)
    group = pa.table({"bucket": [5] * 401, "block": [0] * 401, "node": [str(k) for k in range(401)], "comp": [f"{k:03d}" for k in range(401)],
                      "guest": [False] * 401, "sig": [s.tobytes() for s in sig], "bag": [minhash._numbered(h).tobytes() for h in hs]})
    calls, real = [], minhash._overlaps
    minhash._overlaps = lambda *a: (calls.append(len(a[4])), real(*a))[1]
    try:
        out = minhash._links(group).to_pylist()
    finally:
        minhash._overlaps = real
    assert sum(r["a"] is not None for r in out) == 400 and out[-1]["node"] == "0" and sum(calls) < 2000
