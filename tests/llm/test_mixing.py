import math
from collections import Counter, defaultdict

from medallion.llm.mixing import mix_documents, mixing_report, temperature_weights
from tests.llm.helpers import documents, prose


def corpus(spark):
    texts, sources = [], []
    for s, n in (("big", 60), ("mid", 20), ("low", 6), (None, 3)):
        for k in range(n):
            texts.append(prose(len(texts), 10 + k % 7))
            sources.append(s)
    return documents(spark, [*texts, None, ""], sources=[*sources, "low", "low"])


def test_weights_follow_the_exponent_and_its_targets(spark):
    t = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "source string, tokens long")
    got = {r.source: r for r in temperature_weights(t, max_repeat=2.0).collect()}
    alpha = got["a"].exponent
    assert abs(max(r.epochs for r in got.values()) - 2.0) < 1e-6 and abs(got["a"].epochs - 1.0) < 1e-9
    z = sum((n / 1110) ** alpha for n in (1000, 100, 10))
    assert all(abs(r.weight - (r.tokens / 1110) ** alpha / z) < 1e-9 for r in got.values())
    even = temperature_weights(t, min_entropy=0.9).collect()
    assert abs(-sum(r.weight * math.log(r.weight) for r in even) - 0.9) < 1e-6
    assert all(abs(r.epochs - 0.5) < 1e-9 for r in temperature_weights(t, max_repeat=0.5, budget=555).collect())


def test_copies_fill_the_quota(spark):
    df = corpus(spark)
    for opts in ({"max_repeat": 1.25}, {"max_repeat": 3.0}, {"max_repeat": 1.5, "budget": 400.0}):
        rows = mixing_report(df, **opts).collect()
        assert len(rows) == df.count()
        by = defaultdict(list)
        for r in rows:
            by[r.source].append(r)
        for rs in by.values():
            tokens, quota = sum(r.n_tokens for r in rs), rs[0].epochs * sum(r.n_tokens for r in rs)
            full = math.floor(rs[0].epochs + 1e-9)
            assert {r.copies - full for r in rs} <= {0, 1}
            taken, left = 0, quota - full * tokens
            for r in sorted(rs, key=lambda r: r.place):  # the whole order, without blocks
                taken += r.n_tokens
                assert (r.copies > full) == (taken <= left)
            if "budget" not in opts:
                assert full >= 1


def test_mix_repeats_rows(spark):
    df = corpus(spark)
    copies = {r.doc_id: r.copies for r in mixing_report(df, max_repeat=2.0).collect()}
    got = Counter(r.doc_id for r in mix_documents(df, max_repeat=2.0).collect())
    assert got == Counter({k: v for k, v in copies.items() if v})
    assert mix_documents(df).columns == df.columns
    none = df.filter("false")
    assert mix_documents(none).count() == 0 and mixing_report(none).count() == 0


def test_mix_is_a_permutation_of_each_epoch(spark):
    df = corpus(spark).coalesce(1)
    ids = [r.doc_id for r in mix_documents(df, max_repeat=3.0).collect()]
    n = df.count()
    first, second = ids[:n], ids[n:]
    assert sorted(first) == list(range(n)) and first != sorted(first)
    again = second[:len(set(second))]
    assert len(again) > 8 and sorted(again) == sorted(set(second))
    assert again != [i for i in first if i in set(again)] and again != sorted(again)
    assert ids == [r.doc_id for r in mix_documents(df.repartition(3), max_repeat=3.0).collect()]
    assert ids != [r.doc_id for r in mix_documents(df, max_repeat=3.0, seed=18).collect()]
