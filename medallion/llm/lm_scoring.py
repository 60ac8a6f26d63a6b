"""N-gram language-model scores from Elias-Fano tries, trained and queried in shards.

Model.  Interpolated absolute discounting: P(w|v) = (c(vw) - D) / c(v) + D n(v) / c(v) P1(w)
with c(v) occurrences and n(v) different successors of v, the additive-smoothed unigram
P1(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)), and P1 alone after an unseen context.  At order 3
P(w|uv) is the same over P(w|v), with the counts of what follows uv; a text's first word has
no such context.  Each text is its words and an end; its first word follows a start mark.
Discounted counts are stored as 16-bit logarithmic codes (steps of 0.07 %), totals per
context exactly.

Data flow.  Texts become blocks of about ``block_bytes``, each a stream of local word
numbers, written once to the shared folder.  A block sends its different bigrams, with
their training counts, to shards that own them by context; a shard adds the counts,
builds its trie, and answers every request of each block in the order it came.  Trigrams
go with the bigram that is their context and form a further level of the shard's trie, keyed
by the context's place.  Totals
of a context are the counts of that word as a token, so the answers also hold all unigram
counts.  Blocks meet their answers and score their documents.  Both shuffles carry one
packed row per (block, shard), and nothing held by one task grows with the corpus: the
number of shards does.  A word with more than ``HOT`` of all tokens, or more than
``CONTEXT_SHARDS`` shards would hold, spreads its successors over all shards; the totals of
such words are the only counts that pass the driver.  Tries are mapped over files in the
shared folder where it is a path of the file system, else over memory.

Words are read after A-Z are lower-cased and told apart by a 64-bit hash.  Null text is
empty: its only token is the end.  Rows that repeat an id are texts of their own.  With no
training text, N = V = 0 and every token has probability 1.
"""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import ascii_lower, col, staged, text_or_empty
from medallion.llm.elias_fano import Trie
from medallion.session import scratch_dir

DISCOUNT, ADD = 0.75, 0.1
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 4 << 20
HOT, CONTEXT_SHARDS = 0.001, 4
_START, _END = np.uint64(1), np.uint64(2)
_MEMO = 200_000
_STEPS = 1024


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _MEMO:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def _code(count: np.ndarray) -> np.ndarray:
    return (1 + np.rint(np.log2((count - DISCOUNT) / (1 - DISCOUNT)) * _STEPS)).astype(np.uint16)


def _decode(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, (1 - DISCOUNT) * np.exp2((code.astype(float) - 1) / _STEPS), 0.0)


def default_held_out(id_c: Column) -> Column:
    return (F.crc32(F.coalesce(id_c.cast("string"), F.lit("")).cast("binary")) % 10) == 0


# ---- blocks ------------------------------------------------------------------


def _to_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    task, n = TaskContext.get().partitionId(), 0
    ids, held, sizes, hashes, size = [], [], [], [], 0

    def block():
        nonlocal n
        vocab, stream, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        by_count = np.argsort(-count, kind="stable")  # frequent words get small numbers
        place = np.empty(len(by_count), np.uint32)
        place[by_count] = np.arange(len(by_count))
        stream = place[stream]
        n += 1
        lens = np.array(sizes)
        train = ~np.array(held)
        return pa.RecordBatch.from_pylist([{
            "block": f"{task}-{n}", "ids": list(ids), "held": list(held), "sizes": list(sizes),
            "vocab": vocab[by_count].tobytes(), "low": stream.astype(np.uint16).tobytes(),
            "high": (stream >> 16).astype(np.uint16).tobytes(), "tokens": int(lens.sum() + len(lens)),
            "train_tokens": int((lens + 1)[train].sum()), "train_texts": int(train.sum())}], schema)

    for part in (b.slice(at, 128) for b in batches for at in range(0, b.num_rows, 128)):
        for i, text, out in zip(*(c.to_pylist() for c in part.columns)):
            words = text.encode("utf-8").split()
            ids.append(i)
            held.append(out)
            sizes.append(len(words))
            hashes.append(np.fromiter(map(_words.__getitem__, words), np.uint64, len(words)))
            size += len(text) + 16
            if size >= block_bytes:
                yield block()
                ids, held, sizes, hashes, size = [], [], [], [], 0
    if ids:
        yield block()


def _numbered(x: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers of ``x`` (0 to ``below``), ascending, and the place of each
    item among them.  ``x`` is written over: one sort in place of (number, position), as
    long as both fit in 63 bits, holds far less than a sort of positions."""
    bits = max(len(x) - 1, 1).bit_length()
    if max(below, 1).bit_length() + bits > 63:
        values, at = np.unique(x, return_inverse=True)
        return values, at.astype(np.int32)
    x <<= bits
    x |= np.arange(len(x), dtype=np.int64)
    x.sort()
    position = (x & ((1 << bits) - 1)).astype(np.int32)
    x >>= bits
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    at = np.empty(len(x), np.int32)
    at[position] = np.cumsum(new, dtype=np.int32) - 1
    return x[new], at


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


class _Block:
    """A block's texts as bigrams, in the order of their shards."""

    def __init__(self, row: dict, shards: int, hot: np.ndarray, order: int = 2):
        self.ids, self.held = row["ids"], np.array(row["held"], bool)
        sizes = np.array(row["sizes"], np.int64)
        stream = (np.frombuffer(row["low"], np.uint16).astype(np.int64)
                  | np.frombuffer(row["high"], np.uint16).astype(np.int64) << 16) + 2
        self.hashes = np.concatenate([[_START, _END], np.frombuffer(row["vocab"], np.uint64)]).astype(np.uint64)
        self.sizes = sizes + 1
        ends = np.cumsum(self.sizes)
        words = np.ones(int(ends[-1]), bool)
        words[ends - 1] = False
        nxt = np.ones(len(words), np.int64)
        nxt[words] = stream
        ctx = np.empty_like(nxt)
        ctx[1:] = nxt[:-1]
        ctx[ends - self.sizes] = 0
        self.text = np.repeat(np.arange(len(sizes), dtype=np.int32), self.sizes)
        m = len(self.hashes)
        ctx *= m
        ctx += nxt
        del words, stream, nxt
        pairs, self.pair = _numbered(ctx, m * m)
        del ctx
        self.ctx = (pairs // m).astype(np.int32)
        pairs %= m
        self.nxt = pairs.astype(np.int32)
        del pairs
        self.shard = self._owners(shards, hot)
        self.order = np.argsort(self.shard, kind="stable").astype(np.int32)
        self.runs3 = None
        if order > 2:
            self._trigrams(ends - self.sizes, m)

    def _owners(self, shards: int, hot: np.ndarray) -> np.ndarray:
        """The shard of each bigram."""
        own = self.hashes[self.ctx]
        spread = np.flatnonzero(np.isin(self.hashes, hot)[self.ctx])
        with np.errstate(over="ignore"):
            own[spread] ^= self.hashes[self.nxt[spread]] * np.uint64(0x9E3779B97F4A7C15)
            own ^= own >> np.uint64(32)
            own *= np.uint64(0xD6E8FEB86659FD93)
        own >>= np.uint64(32)
        own %= np.uint64(shards)
        return own.astype(np.int32)

    def _trigrams(self, starts: np.ndarray, m: int) -> None:
        """Different (bigram, next word), in the order of their bigrams' shards."""
        later = np.ones(len(self.pair), bool)
        later[starts] = False
        self.at3 = np.flatnonzero(later)
        pair = self.pair[self.at3]
        tri, self.tri = _numbered(self.pair[self.at3 - 1].astype(np.int64) * m + self.nxt[pair], len(self.ctx) * m)
        self.ctx3, self.nxt3 = tri // m, tri % m
        self.pair3 = np.empty(len(tri), np.int64)  # the bigram that ends the trigram
        self.pair3[self.tri] = pair
        self.runs3 = np.bincount(self.ctx3, minlength=len(self.ctx))
        rank = np.empty(len(self.order), np.int64)
        rank[self.order] = np.arange(len(self.order))
        self.order3 = np.argsort(rank[self.ctx3], kind="stable")
        self.edge3 = np.concatenate([[0], np.cumsum(self.runs3[self.order])])

    def shares(self):
        """(shard, places of its bigrams, start of each context among them, places of the
        trigrams that follow these bigrams)."""
        edges = np.flatnonzero(np.diff(self.shard[self.order])) + 1
        at = 0
        for places in np.split(self.order, edges):
            c = self.ctx[places]
            new = np.ones(len(c), bool)
            new[1:] = c[1:] != c[:-1]
            third = None if self.runs3 is None else self.order3[self.edge3[at]:self.edge3[at + len(places)]]
            at += len(places)
            yield int(self.shard[places[0]]), places, np.flatnonzero(new), third


def _requests(batches, shards: int, hot: np.ndarray, order: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _each(batch):
            b = _Block(row, shards, hot, order)
            learned = ~b.held[b.text]
            train = np.bincount(b.pair[learned], minlength=len(b.ctx)).astype(np.uint32)
            if order > 2:
                train3 = np.bincount(b.tri[learned[b.at3]], minlength=len(b.ctx3)).astype(np.uint32)
            out = []
            for shard, places, starts, third in b.shares():
                runs = np.diff(np.append(starts, len(places))).astype(np.uint32)
                out.append({"shard": shard, "block": row["block"], "h1": b.hashes[b.ctx[places[starts]]].tobytes(),
                            "runs": runs.tobytes(), "h2": b.hashes[b.nxt[places]].tobytes(), "n": train[places].tobytes()})
                if order > 2:
                    out[-1] |= {"runs3": b.runs3[places].astype(np.uint32).tobytes(), "h3": b.hashes[b.nxt3[third]].tobytes(),
                                "n3": train3[third].tobytes()}
                if len(out) == 16:
                    yield pa.RecordBatch.from_pylist(out, _REQUEST)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, _REQUEST)


_REQUEST = pa.schema([("shard", pa.int32()), ("block", pa.string()), *((k, pa.binary()) for k in ("h1", "runs", "h2", "n", "runs3", "h3", "n3"))])
_ANSWER = pa.schema([("shard", pa.int32()), ("block", pa.string()), ("totals", pa.binary()), ("kinds", pa.binary()),
                     ("codes", pa.binary()), ("totals3", pa.binary()), ("kinds3", pa.binary()), ("codes3", pa.binary()),
                     ("hot_word", pa.int64()), ("n", pa.int64()), ("k", pa.int64())])


def _summed(context: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """N-grams sorted by (context, word), each once, with their counts added."""
    order = np.lexsort((word, context))
    context, word, n = context[order], word[order], n[order]
    new = np.ones(len(context), bool)
    new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    first = np.flatnonzero(new)
    return context[first], word[first], np.add.reduceat(n, first) if len(first) else n


@contextlib.contextmanager
def _mapped(trie: Trie, folder: str | None):
    """The trie over a mapping that is gone afterwards; a file is named by the attempt."""
    path = None
    if folder is not None:
        os.makedirs(folder, exist_ok=True)
        path = f"{folder}/{uuid.uuid4().hex}.trie"
    try:
        yield trie.mapped(path)
    finally:
        if path is not None:
            with contextlib.suppress(FileNotFoundError):
                os.unlink(path)


def _read(rows: list[dict], name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(r[name], kind) for r in rows]


def _further(trie: Trie, rows: list[dict], places: list[np.ndarray], folder: str | None, out: list[dict]) -> None:
    """Answers about trigrams: a level keyed by the places of their bigrams."""
    runs, h3, n3 = _read(rows, "runs3", np.uint32), _read(rows, "h3", np.uint64), _read(rows, "n3", np.uint32)
    context = np.concatenate([np.repeat(p, k) for p, k in zip(places, runs)])
    word, n = np.concatenate(h3), np.concatenate(n3).astype(np.int64)
    seen = n > 0  # their bigrams are learned too
    with _mapped(Trie.build(*_summed(context[seen].astype(np.uint64), word[seen], n[seen]), _code), folder) as upper:
        for o, p, k, y in zip(out, places, runs, h3):
            at = np.where(p >= 0, upper.contexts(np.maximum(p, 0).astype(np.uint64)), -1)
            o |= {"totals3": upper.of(upper.totals, at).astype(np.uint32).tobytes(), "kinds3": upper.of(upper.kinds, at).astype(np.uint32).tobytes(),
                  "codes3": upper.lookup(np.repeat(at, k), y).tobytes()}


def _answers(hot: np.ndarray, order: int, folder: str | None):
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        h1, h2, runs = _read(rows, "h1", np.uint64), _read(rows, "h2", np.uint64), _read(rows, "runs", np.uint32)
        n = np.concatenate(_read(rows, "n", np.uint32)).astype(np.int64)
        seen = n > 0
        context = np.concatenate([np.repeat(x, k) for x, k in zip(h1, runs)])[seen]
        with _mapped(Trie.build(*_summed(context, np.concatenate(h2)[seen], n[seen]), _code), folder) as trie:
            out, places = [], []
            for r, x, y, k in zip(rows, h1, h2, runs):
                at = trie.contexts(x)
                places.append(trie.places(np.repeat(at, k), y))
                out.append({"shard": r["shard"], "block": r["block"], "totals": trie.of(trie.totals, at).astype(np.int64).tobytes(),
                            "kinds": trie.of(trie.kinds, at).astype(np.int64).tobytes(), "codes": trie.of(trie.codes, places[-1]).tobytes()})
            if order > 2:
                _further(trie, rows, places, folder, out)
            names = trie.levels["contexts"].values(np.arange(trie.levels["contexts"].count))
            is_hot = np.isin(names, hot)
            out += [{"shard": rows[0]["shard"], "hot_word": int(h.view(np.int64)), "n": int(t), "k": int(k)}
                    for h, t, k in zip(names[is_hot], trie.totals[is_hot], trie.kinds[is_hot])]
            # the other contexts, without the start mark, are this shard's part of V
            out.append({"shard": rows[0]["shard"], "n": int((~is_hot & (names != _START)).sum())})
        return pa.Table.from_pylist(out, _ANSWER)

    return run


def _scores(shards: int, hot_stats: dict[int, tuple[int, int]], total: int, kinds: int, texts: int, schema: pa.Schema, order: int):
    hot = np.array(sorted(hot_stats), np.uint64)
    floor = total + ADD * (kinds + 1)

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        by_shard = {r["shard"]: r for r in answers.to_pylist()}
        for row in (r for batch in blocks.to_batches() for r in _each(batch)):
            b = _Block(row, shards, hot, order)
            count, followers = np.zeros(len(b.hashes)), np.zeros(len(b.hashes))
            held = np.zeros(len(b.ctx))
            if order > 2:
                count3, followers3, held3 = np.zeros(len(b.ctx)), np.zeros(len(b.ctx)), np.zeros(len(b.ctx3))
            for shard, places, starts, third in b.shares():
                r, c = by_shard[shard], b.ctx[places[starts]]
                count[c] = np.frombuffer(r["totals"], np.int64)
                followers[c] = np.frombuffer(r["kinds"], np.int64)
                held[places] = _decode(np.frombuffer(r["codes"], np.uint16))
                if order > 2:
                    count3[places], followers3[places] = np.frombuffer(r["totals3"], np.uint32), np.frombuffer(r["kinds3"], np.uint32)
                    held3[third] = _decode(np.frombuffer(r["codes3"], np.uint16))
            for i in np.flatnonzero(np.isin(b.hashes, hot)):
                count[i], followers[i] = hot_stats[int(b.hashes[i])]
            token = count.copy()
            token[1] = texts
            p1 = (token + ADD) / floor
            c = count[b.ctx]
            p = np.where(c > 0, (held + DISCOUNT * followers[b.ctx] * p1[b.nxt]) / np.maximum(c, 1), p1[b.nxt])
            if not total:
                p, p1 = np.ones_like(p), np.ones_like(p1)
            n = len(b.sizes)
            per_text = lambda x: np.bincount(b.text, weights=x, minlength=n)
            each = np.log10(p)[b.pair]
            if order > 2 and total:
                c = count3[b.ctx3]
                p3 = np.where(c > 0, (held3 + DISCOUNT * followers3[b.ctx3] * p[b.pair3]) / np.maximum(c, 1), p[b.pair3])
                each[b.at3] = np.log10(p3)[b.tri]
            score, base, known = per_text(each), per_text(np.log10(p1)[b.nxt][b.pair]), per_text((token > 0)[b.nxt][b.pair])
            out.append(pa.table([pa.array(b.ids, schema.field(0).type), pa.array(b.held), pa.array(b.sizes),
                                 pa.array(known.astype(np.int64)), pa.array(np.full(n, total)), pa.array(base),
                                 pa.array(score)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def _file_system(path: str) -> str | None:
    """A path that executors open themselves, None for other stores."""
    if path.startswith("/"):
        return path
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else None


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None,
              block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, hot_share: float = HOT, order: int = 2) -> DataFrame:
    """One row per document: id, ``held_out`` (not learned from), ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` (unigrams) and ``score`` by n-grams up to
    ``order`` (2 or 3)."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    out_flag = default_held_out(col(id_col)) if held_out is None else held_out
    src = df.select(col(id_col).alias("id"), ascii_lower(text_or_empty(text_col)).alias("t"), out_flag.alias("held"))
    kind = src.schema["id"].dataType.simpleString()
    id_arrow = src.select("id").limit(0).toArrow().schema.field(0).type
    fields = (f"block string, ids array<{kind}>, held array<boolean>, sizes array<long>, vocab binary, low binary, "
              "high binary, tokens long, train_tokens long, train_texts long")
    arrow = pa.schema([("block", pa.string()), ("ids", pa.list_(id_arrow)), ("held", pa.list_(pa.bool_())),
                       ("sizes", pa.list_(pa.int64())), ("vocab", pa.binary()), ("low", pa.binary()), ("high", pa.binary()),
                       ("tokens", pa.int64()), ("train_tokens", pa.int64()), ("train_texts", pa.int64())])
    blocks = staged(src.mapInArrow(lambda b: _to_blocks(b, block_bytes, arrow), fields), "lm-blocks")
    sums = blocks.agg(F.sum("tokens").alias("tokens"), F.sum("train_tokens").alias("n"), F.sum("train_texts").alias("t"),
                      F.sum(F.octet_length("low") + F.octet_length("vocab")).alias("bytes")).first()
    tokens = sums["tokens"] or 0
    shards = max(1, -(-6 * (order - 1) * tokens // shard_bytes))
    hot_share = min(hot_share, CONTEXT_SHARDS / shards)
    hot_words = np.array([r["h"] % 2**64 for r in _frequent(blocks, hot_share, tokens)], np.uint64)
    hot_words = np.unique(np.append(hot_words, _START))
    folder = _file_system(scratch_dir(df.sparkSession, "lm-tries"))
    asked = blocks.select("block", "ids", "held", "sizes", "vocab", "low", "high").mapInArrow(
        lambda b: _requests(b, shards, hot_words, order),
        "shard int, block string, h1 binary, runs binary, h2 binary, n binary, runs3 binary, h3 binary, n3 binary")
    answers = staged(asked.groupBy("shard").applyInArrow(
        _answers(hot_words, order, folder),
        "shard int, block string, totals binary, kinds binary, codes binary, totals3 binary, kinds3 binary, codes3 binary, hot_word long, n long, k long"),
        "lm-answers")
    hot_stats = {int(h): (0, 0) for h in hot_words}
    for r in (answers.filter("hot_word is not null").groupBy("hot_word").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).collect()):
        hot_stats[r["hot_word"] % 2**64] = (r["n"], r["k"])
    kinds = answers.filter("block is null and hot_word is null").agg(F.sum("n")).first()[0] or 0
    texts = sums["t"] or 0
    kinds += sum(n > 0 for h, (n, _) in hot_stats.items() if h != int(_START)) + (texts > 0)
    result = pa.schema([("id", id_arrow), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    scored = (blocks.select("block", "ids", "held", "sizes", "vocab", "low", "high").groupBy("block")
              .cogroup(answers.filter("block is not null").select("shard", "block", "totals", "kinds", "codes", "totals3", "kinds3", "codes3").groupBy("block"))
              .applyInArrow(_scores(shards, hot_stats, int(sums["n"] or 0), int(kinds), int(texts), result, order),
                            f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    return scored.withColumnRenamed("id", id_col)


def _frequent(blocks: DataFrame, share: float, tokens: int) -> list:
    """Words with more than ``share`` of all tokens: at most 1/share of them.  Such
    a word has that share of some block, so blocks name only their own."""
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            for r in _each(batch):
                vocab = np.frombuffer(r["vocab"], np.uint64)
                stream = np.frombuffer(r["low"], np.uint16)[np.frombuffer(r["high"], np.uint16) == 0]
                n = np.bincount(stream, minlength=min(len(vocab), 1))[:len(vocab)]
                top = np.flatnonzero(n > share * r["tokens"])
                yield pa.RecordBatch.from_arrays([pa.array(vocab[top].view(np.int64)), pa.array(n[top].astype(np.int64))], schema=schema)

    named = blocks.select("vocab", "low", "high", "tokens").mapInArrow(run, "h long, n long")
    return named.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") > F.lit(share * tokens)).collect()
