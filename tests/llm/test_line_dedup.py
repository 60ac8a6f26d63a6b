import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa

from medallion.llm import line_dedup
from medallion.llm.line_dedup import (_first_key, by_words, drop_repeated_lines, line_classes, line_dedup_report, line_membership,
                                      within, word_edits)
from tests.llm.helpers import documents, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rnd, units, edits, new):
    units = list(units)
    for _ in range(edits):
        at = rnd.randint(0, len(units))
        units[at:at + rnd.randint(0, 1)] = rnd.choice(new)
    return units


def test_distance_against_the_matrix():
    rnd = random.Random(5)
    for _ in range(6000):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14)))
        b = "".join(changed(rnd, a, rnd.randint(0, 6), ["", "a", "b"]))
        for most in range(6):
            assert within(a, b, most) == within(b, a, most) == (distance(a, b) <= most), (a, b, most)
        assert within(list(a), list(b), 2) == (distance(a, b) <= 2)


def test_distance_of_very_long_lines():
    rnd = random.Random(6)
    a = "".join(rnd.choice("abcdefgh ") for _ in range(130_000))
    near, far = list(a), list(a)
    for k in range(40):
        near[k * 3000 + 7] = "x"
        far[k * 3000 + 7:k * 3000 + 9] = "yz!"
    began = time.process_time()
    assert within(a, "".join(near), 40) and not within(a, "".join(near), 39)
    assert not within(a, "".join(far), 40) and not within(a, a[::-1], 40)
    assert time.process_time() - began < 4


def test_pairs_meet_in_a_segment():
    """Lines within the edits share a key; the vectorised keys are those of the pairs."""
    rnd = random.Random(7)
    for n in (8, 9, 15, 16, 20, 24, 30, 96, 130):
        for _ in range(40):
            a = [rnd.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rnd.randrange(3)) for _ in range(n)]
            b = changed(rnd, a, word_edits(n), [[], ["other"], ["alpha1"]])
            x, y = (" ".join(w) + " " * 0 for w in sorted((a, b), key=len))
            if len(x) < 96 or not (by_words(x, 96) and by_words(y, 96)) or not within(x.encode().split(), y.encode().split(), word_edits(len(x.split()))):
                continue
            key = _first_key(x.encode().split(), y.encode().split(), True, 2)
            keys, lines, own = line_dedup._keys([(1, x), (2, y)], 2, 20, 96)
            mine, theirs = (set(keys[(lines == i) & (own == o)].tolist()) for i, o in ((1, True), (2, False)))
            assert key in mine & theirs


def test_keys_do_not_depend_on_the_lines_beside(monkeypatch):
    """Words are hashed for many lines at once; a line's keys are those it has alone."""
    lines = [(k, prose(k % 9, 8 + 7 * (k % 11)) + "  \té" * (k % 3)) for k in range(60)] + [(60, "x" * 120), (61, "short one of twenty characters")]
    alone = sorted((k, n, bool(o)) for row in lines for k, n, o in zip(*(x.tolist() for x in line_dedup._keys([row], 2, 20, 96))))
    for chars in (1 << 20, 700):
        monkeypatch.setattr(line_dedup, "PART_CHARS", chars)
        assert sorted(zip(*(x.tolist() for x in line_dedup._keys(lines, 2, 20, 96)))) == alone
    hashes, count = line_dedup._word_hashes([b"", b" one  two\tone", b"two"])
    assert count.tolist() == [0, 3, 1] and hashes[0] == hashes[2] != hashes[1] == hashes[3]


def peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_pairs_does_not_grow_with_their_number(monkeypatch):
    """Lines that all share a key are verified in steps, and no pair is remembered."""
    monkeypatch.setattr(line_dedup, "PAIRS", 1000, raising=False)
    words = prose(3, 40).split()
    texts = [" ".join(words[:39] + [f"end{k}"]) for k in range(250)]
    key, line, own = line_dedup._keys(list(enumerate(texts)), 2, 20, 96)
    shard, low = line_dedup._placed(key, 1)
    full = shard << 32 | low
    pick = full == full[own & (line == 0)][0]
    n = int(pick.sum())
    group = pa.table({"one": [False] * n, "g": full[pick], "key": full[pick], "pa": pa.array([0] * n, pa.int32()), "pb": pa.array([0] * n, pa.int32()),
                      "node": [f"{k:032d}" for k in line[pick]], "own": own[pick], "part": pa.array([0] * n, pa.int32()),
                      "text": [texts[k] for k in line[pick]]})
    out = []
    assert peak(lambda: out.append(line_dedup._block_links(2, 96, 1)(group))) < 4
    assert sum(r["n"] for r in out[0].to_pylist()) == 250 * 249


def linked(a, b, most=2, least=20, long_from=96):
    if by_words(a, long_from) and by_words(b, long_from):
        x, y = sorted((a.split(), b.split()), key=len)
        return len(y) - len(x) <= word_edits(len(x)) and distance(x, y) <= word_edits(len(x))
    if by_words(a, long_from):
        a, b = b, a
    if by_words(b, long_from) and len(b) < len(a):
        return False
    return min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= most and distance(a, b) <= most


def brute(rows):
    lines = [(i, n, x.strip(" \t\n\x0b\x0c\r")) for i, t in rows for n, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    texts = sorted({x[2] for x in lines})
    up, links = {x: x for x in texts}, dict.fromkeys(texts, 0)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, a in enumerate(texts):
        for b in texts[:k]:
            if linked(a, b):
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    first = {}
    for i, n, x in sorted(lines):
        first.setdefault(root(x), (i, n))
    return {(i, n, links[x], first[root(x)] == (i, n)) for i, n, x in lines}


def test_lines_against_brute_force(spark):
    rnd = random.Random(2)
    base = [prose(k, 6) for k in range(12)]
    texts = [None, "", "\n \n", "short\nshort\nshirt", "a" * 40 + "\n" + "a" * 41 + "\n" + "a" * 43]
    for _ in range(60):
        picked = []
        for _ in range(4):
            x = list(rnd.choice(base))
            for _ in range(rnd.randint(0, 2)):
                x[rnd.randrange(len(x))] = rnd.choice("xyz é")
            picked.append("".join(x) + rnd.choice(["", " ", "\r"]))
        texts.append("\n".join(picked))
    df = documents(spark, texts)
    got = {(r.doc_id, r.line_no, r.n_links, r.kept) for r in line_classes(df, block=8).collect()}
    want = brute(list(enumerate(texts)))
    assert got == want
    report = {r.doc_id: r for r in line_dedup_report(df).collect()}
    assert all(r.removed_lines == sorted(n for i, n, _, k in want if i == d and not k) for d, r in report.items())


def test_lines_are_taken_out(spark):
    same = prose(1, 6)
    df = documents(spark, [same + "\nown line one here", "first\n" + same + "x", None])
    out = {r.doc_id: r.text for r in drop_repeated_lines(df).collect()}
    assert out == {0: same + "\nown line one here", 1: "first", 2: None}
    assert drop_repeated_lines(df.filter("false")).count() == 0


def test_long_lines_against_brute_force(spark, monkeypatch):
    """Words replaced, put in and left out on long lines, lines at the border of the two
    units, and lines without words; keys that are frequent in a block go past the shards."""
    rnd = random.Random(8)
    base = [prose(k, n) for k, n in ((1, 12), (2, 16), (3, 30), (4, 45), (5, 100))] + ["ab" * 60, "é" * 150, "abc de " * 14 + "x"]
    texts = []
    for _ in range(110):
        t = rnd.choice(base)
        w = changed(rnd, t.split(" "), rnd.randint(0, 4), [[], ["other"], ["x1"], ["replaced", "twice"]])
        x = list(" ".join(w) or "-")
        for _ in range(rnd.randint(0, 2)):
            x[rnd.randrange(len(x))] = rnd.choice("xyz é")
        texts.append("".join(x).strip())
    texts = sorted({x for x in texts if x})
    near = [(i, j) for i in range(len(texts)) for j in range(i) if linked(texts[i], texts[j])]
    links = {i: sum(i in pair for pair in near) for i in range(len(texts))}
    assert sum(distance(texts[i], texts[j]) > 2 for i, j in near) > 30
    df = documents(spark, texts).repartition(3)
    for block in (256, 2):
        assert {r.doc_id: r.n_links for r in line_classes(df, block=block).collect()} == links
    monkeypatch.setattr(line_dedup, "FREQUENT", 3)
    monkeypatch.setattr(line_dedup, "SHARD_BYTES", 2000)
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 20)
    assert {r.doc_id: r.n_links for r in line_classes(df).collect()} == links


def test_frequent_keys_go_past_the_shards():
    """Of a key that many lines of a block share, the shard learns four rows."""
    lines = [(k, prose(1, 40) + f" end{k}") for k in range(500)]

    class Task:
        def partitionId(self):
            return 0

    real = line_dedup.TaskContext.get
    line_dedup.TaskContext.get = staticmethod(Task)
    try:
        batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in lines]), pa.array([t for _, t in lines])], names=["line", "text"])
        sent = [r for b in line_dedup._to_shards(iter([batch]), 4, 2, 20, 96) for r in b.to_pylist()]
    finally:
        line_dedup.TaskContext.get = real
    known = sum(len(r["sides"]) for r in sent if r["known"])
    asked = sum(len(r["sides"]) for r in sent if not r["known"])
    assert known >= 500 * 4 and asked < 500 * 8
    per_key = {}
    for r in sent:
        if not r["known"]:
            for k in np.frombuffer(r["keys"], np.uint32).tolist():
                per_key[r["shard"], k] = per_key.get((r["shard"], k), 0) + 1
    assert max(per_key.values()) < line_dedup.FREQUENT


def test_membership_has_every_line_and_document(spark):
    a, b = prose(1, 6), prose(2, 6)
    df = documents(spark, [a + "\n" + b, b + "x\nown", None, " \n\r\n", b, a, None, ""], ids=[1, 2, 3, 4, 5, None, None, 5])
    rows = line_membership(df).collect()
    assert sorted((str(r.doc_id), str(r.line_no)) for r in rows) == sorted(
        [("1", "0"), ("1", "1"), ("2", "0"), ("2", "1"), ("3", "None"), ("4", "None"), ("5", "0"), ("None", "0"), ("None", "None"),
         ("5", "None")])
    cls = {(r.doc_id, r.line_no): r.class_id for r in rows}
    assert cls[1, 1] == cls[2, 0] == cls[5, 0] and cls[1, 0] == cls[None, 0] and len(set(cls.values())) == 4
    assert {r.kept for r in rows if r.line_no is None} == {None}


def test_registered_query_gives_the_membership(spark, sf001):
    from medallion.llm.queries import QUERIES

    out = QUERIES["op4_line_dedup"](spark, sf001)
    assert out.columns == ["doc_id", "line_no", "class_id", "n_links", "kept"]
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_rows_that_repeat_an_id_keep_one_line(spark):
    a = prose(1, 6)
    for ids in ([1, 1, 2], [None, None, None]):
        rows = line_classes(documents(spark, [a, a, a + "y"], ids=ids)).collect()
        assert sorted(r.kept for r in rows) == [False, False, True]
    same = documents(spark, [a, a], ids=[1, 1])
    assert [r.text for r in drop_repeated_lines(same).collect()] == [a, a]  # rows of one id cannot be told apart
