import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from medallion.llm.exact_dedup import exact_dedup, exact_labels
from tests.llm.helpers import ascii_lower, documents, prose


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[ascii_lower(t or "")].append(i)
    out = []
    for i, t in rows:
        g = groups[ascii_lower(t or "")]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(ascii_lower(t or "").encode()).hexdigest()))
    return sorted(out, key=str)


TEXTS = ["Abc é", "aBC é", "abc É", None, "", "x" * 200_000, "X" * 200_000, "y"] + [prose(k % 3, 30) for k in range(12)]


def test_against_brute_force(spark):
    df = documents(spark, TEXTS, ids=[*range(len(TEXTS) - 1), None]).withColumn("kept", F.lit("clash"))
    got = sorted(map(tuple, exact_labels(df, keep="largest").collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in df.collect()])


def test_colliding_hashes_are_told_apart_by_bytes(spark):
    df = documents(spark, TEXTS)
    weak = exact_labels(df, keep="largest", hash_fn=lambda c: F.octet_length(c) % 2)
    assert sorted(map(tuple, weak.collect()), key=str) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_smallest_and_repeated_rows(spark):
    df = documents(spark, ["a", "A", "a", "b"], ids=[4, 4, 7, 1])
    kept = [(r.doc_id, ascii_lower(r.text)) for r in exact_dedup(df).collect()]
    assert sorted(kept) == [(1, "b"), (4, "a")]
    assert exact_dedup(df).columns == df.columns


def test_empty_table(spark):
    df = documents(spark, ["a"]).filter("false")
    assert exact_labels(df).count() == 0 and exact_dedup(df).count() == 0
