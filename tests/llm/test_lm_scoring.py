import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm.elias_fano import EliasFano, Trie
from medallion.llm.lm_scoring import lm_scores
from tests.llm.helpers import ascii_lower, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("n, top", [(0, 1), (1, 5), (50, 60), (1000, 10**6), (3000, 2**63), (300, 3)])
def test_sequence(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    e = EliasFano.build(v)
    assert (e.values(np.arange(n)) == v).all()
    q = np.concatenate([v, rng.integers(0, top + 2, 300, dtype=np.uint64)])
    assert (e.successor(q) == np.searchsorted(v, q)).all()


def test_trie_finds_each_bigram_and_no_other():
    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(1, 60, (900, 2)).astype(np.uint64) * np.uint64(2**57 + 1), axis=0)
    code = np.arange(1, len(pairs) + 1)
    trie = Trie.build(pairs[:, 0], pairs[:, 1], code, lambda c: c.astype(np.uint16))
    known = {tuple(p): i + 1 for i, p in enumerate(pairs.tolist())}
    grid = np.array([(a, b) for a in range(0, 62) for b in range(0, 62)], np.uint64) * np.uint64(2**57 + 1)
    got = trie.lookup(trie.contexts(grid[:, 0]), grid[:, 1])
    assert got.tolist() == [known.get(tuple(p), 0) for p in grid.tolist()]


def brute(rows, order=2):
    words = [WORD.findall(ascii_lower(t or "")) for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    uni, pairs, ctx, tris, ctx3 = (Counter() for _ in range(5))
    for w, h in zip(words, held):
        if not h:
            s = [None, *w, 0]
            uni.update(s[1:])
            pairs.update(zip(s, s[1:]))
            ctx.update(s[:-1])
            tris.update(zip(s, s[1:], s[2:]))
            ctx3.update(zip(s, s[1:-1]))
    kinds, kinds3 = Counter(a for a, _ in pairs), Counter((a, b) for a, b, _ in tris)
    n, v = sum(uni.values()), len(uni)
    out = []
    for (i, _), w, h in zip(rows, words, held):
        s, base, score = [None, *w, 0], 0.0, 0.0
        for k, (a, b) in enumerate(zip(s, s[1:])):
            p1 = (uni[b] + 0.1) / (n + 0.1 * (v + 1)) if n else 1
            p = (max(pairs[a, b] - 0.75, 0) + 0.75 * kinds[a] * p1) / ctx[a] if ctx[a] else p1
            if order > 2 and k and ctx3[z := (s[k - 1], a)]:
                p = (max(tris[(*z, b)] - 0.75, 0) + 0.75 * kinds3[z] * p) / ctx3[z]
            base, score = base + math.log10(p1), score + math.log10(p)
        out.append((i, h, len(s) - 1, sum(uni[b] > 0 for b in s[1:]), n, base, score))
    return out


SMALL = {"block_bytes": 3000, "shard_bytes": 2000, "hot_share": 0.02}


@pytest.mark.parametrize("opts", [{}, SMALL, {"order": 3}, SMALL | {"order": 3}])
def test_scores_against_counters(spark, opts):
    texts = [prose(k, 20 + k) for k in range(60)] + ["the the the the cat", None, "", " \n", "The CAT É", "w" * 100_000, prose(1, 20)]
    ids = [*range(len(texts) - 1), None]
    df = documents(spark, texts, ids=ids).withColumn("score", F.lit("clash"))
    key = lambda r: (r[0] is None, r[0])
    got = sorted(map(tuple, lm_scores(df, **opts).collect()), key=key)
    for g, w in zip(got, sorted(brute(list(zip(ids, texts)), opts.get("order", 2)), key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=2e-3)


def test_no_text_and_nothing_to_learn_from(spark):
    assert lm_scores(documents(spark, ["a"]).filter("false")).count() == 0
    with pytest.raises(ValueError):
        lm_scores(documents(spark, ["a"]), order=4)
    assert lm_scores(documents(spark, ["a b"]), held_out=F.lit(True), order=3).first().score == 0.0
    r = lm_scores(documents(spark, ["a b"]), held_out=F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_further_level_is_keyed_by_places(tmp_path):
    """A level over a level, mapped from a file and from memory, finds each n-gram."""
    rng = np.random.default_rng(4)
    tri = np.unique(rng.integers(1, 30, (4000, 3)).astype(np.uint64), axis=0)
    pairs, of = np.unique(tri[:, :2], axis=0, return_inverse=True)
    code = lambda c: c.astype(np.uint16)
    for path in (None, str(tmp_path / "a.trie")):
        lower = Trie.build(pairs[:, 0], pairs[:, 1], np.arange(len(pairs)), code).mapped(path)
        upper = Trie.build(of.reshape(-1).astype(np.uint64), tri[:, 2], np.arange(1, len(tri) + 1), code).mapped(path and path + "3")
        place = lower.places(lower.contexts(tri[:, 0]), tri[:, 1])
        assert (place == of.reshape(-1)).all()
        assert (upper.lookup(upper.contexts(place.astype(np.uint64)), tri[:, 2]) == np.arange(1, len(tri) + 1)).all()
        assert (upper.lookup(upper.contexts(place.astype(np.uint64)), tri[:, 2] + np.uint64(50)) == 0).all()


def test_tries_leave_no_file(spark):
    import pathlib

    from medallion.session import ensure_checkpoint_dir
    root = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    assert lm_scores(documents(spark, [prose(1, 50)] * 3), order=3).count() == 3
    assert not list(root.rglob("*.trie"))


def test_a_block_holds_few_bytes_a_token():
    """Numbering a block's bigrams takes one sort in place, so a task's memory stays small."""
    import tracemalloc

    from medallion.llm.lm_scoring import _Block, _numbered

    rng = np.random.default_rng(5)
    texts, words, tokens = 300, 30_000, 300_000
    stream = (words * rng.random(tokens) ** 3).astype(np.uint32)
    row = {"ids": list(range(texts)), "held": [False] * texts, "sizes": [tokens // texts] * texts,
           "vocab": rng.integers(3, 2**63, words).astype(np.uint64).tobytes(),
           "low": stream.astype(np.uint16).tobytes(), "high": (stream >> 16).astype(np.uint16).tobytes()}
    _Block(row, 9, np.array([1], np.uint64))
    tracemalloc.start()
    b = _Block(row, 9, np.array([1], np.uint64))
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 40 * tokens and peak < 60 * tokens, (held / tokens, peak / tokens)
    again = b.ctx[b.pair].astype(np.int64) * len(b.hashes) + b.nxt[b.pair]
    start = np.repeat([0], texts)
    assert (b.nxt[b.pair].reshape(texts, -1)[:, :-1].ravel() == stream + 2).all() and (b.ctx[b.pair].reshape(texts, -1)[:, 0] == start).all()
    for below in (int(again.max()) + 1, 2**62):  # sorted in place, and where that needs more than 63 bits
        values, at = _numbered(again.copy(), below)
        assert (values[at] == again).all() and (np.diff(values) > 0).all()
