"""Alignment of two tokenizers' tokens by lockstep merging, and corpus counts of links.

A text is read with a space before it.  Tokenizer A is a byte-level BPE file, B a
SentencePiece file, which adds that space itself; special strings are plain text.
Places where tokens of both end (*cuts*) part the text into groups, and every A token
of a group is linked with every B token of it.

Lockstep.  One state vector holds, for each text of a batch, the next A and B token and
where their group began.  A step compares all ends at once: the token that ends first
makes room for the next one of its side, which is linked with the other side's tokens of
the group so far (a *run*); where both end there is a cut.  Finished texts leave the
vector.  Long texts enter as several lanes, parted at places where both sides end.

Counts.  A block of texts keeps its different id pairs and each text's places among them,
written once to the shared folder.  The number of texts that hold a pair is summed over
blocks, the highest per A id is found, and each block gets back the counts of its pairs:
rows are one per (block, pair), not per (text, pair), so frequent pairs are combined before
every shuffle.  Blocks hold a bounded number of pairs; nothing passes the driver.

Null text is empty; texts that are empty, or whose joined token bytes differ from space
and text on either side, have no tokens: zeros and an empty digest.  Rows that repeat an
id are texts of their own.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.bpe import PATTERN, _byte_alphabet
from medallion.llm.common import col, staged, text_or_empty
from medallion.llm.token_counts import KNOWN, splitter

#: Tokens of a lockstep batch, A tokens of a lane, pairs a block holds, links of a piece.
BATCH_TOKENS, LANE, BLOCK_PAIRS, LINKS = 1_500_000, 1000, 2_000_000, 4_000_000
_TEXT_BYTES = 2 << 20
#: Runs of white space that the faster library's pattern cannot step back over.
_GAP = regex.compile(r"\s{1000}")


# ---- lockstep ------------------------------------------------------------------


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray, lane: int = LANE) -> np.ndarray:
    """(first A, first B, end of A) rows: every text, and of a text of more than ``lane``
    A tokens one lane from the first shared end after each ``lane`` of them.  ``starts``
    holds the (first A, first B, end of A, end of B) rows of the texts."""
    out = []
    for a, b, a_end, b_end in starts.tolist():
        out.append((a, b, a_end))
        at = a + lane
        while at < a_end:
            window = ends_a[at:min(at + lane, a_end)]
            place = b + np.searchsorted(ends_b[b:b_end], window)
            hits = np.flatnonzero(ends_b[np.minimum(place, b_end - 1)] == window)
            if len(hits):
                i, j = at + int(hits[0]) + 1, int(place[hits[0]]) + 1
                if i >= a_end:
                    break
                out[-1] = (*out[-1][:2], i)
                out.append((i, j, a_end))
                at = i + lane
            else:
                at += lane
    return np.array(out, np.int64).reshape(-1, 3)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs and cuts of all lanes, merged step by step.  ``begin`` has the lanes (first A,
    first B, end of A); a lane's last A and B tokens end together.

    Returns (side, token, first of the other side, number) of each run of links, side 1
    being a B token, and (A token, B token) of each cut."""
    i, j, stop = begin[:, 0].copy(), begin[:, 1].copy(), begin[:, 2].copy()
    from_a, from_b = i.copy(), j.copy()  # where the group began
    runs: list[np.ndarray] = [np.zeros_like(i)]
    tokens, others, sizes = [i.copy()], [j.copy()], [np.ones_like(i)]
    cut_a, cut_b = [], []
    while len(i):
        x, y = ends_a[i], ends_b[j]
        both = x == y
        done = both.nonzero()[0]
        if len(done):
            cut_a.append(i[done])
            cut_b.append(j[done])
        go_a, go_b = x <= y, x >= y
        i = i + go_a
        j = j + go_b
        if len(done):
            from_a[done], from_b[done] = i[done], j[done]
            over = both & (i >= stop)
            if over.any():
                stay = ~over
                i, j, stop, from_a, from_b, go_a, both = (v[stay] for v in (i, j, stop, from_a, from_b, go_a, both))
        # after a cut, and where A advanced, the new A token meets the group's B tokens
        tokens.append(np.where(go_a, i, j))
        others.append(np.where(go_a, from_b, from_a))
        sizes.append(np.where(go_a, j - from_b, i - from_a) + 1)
        runs.append(~go_a)
    flat = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in (runs, tokens, others, sizes, cut_a, cut_b)]
    return tuple(v.astype(np.int64, copy=False) for v in flat)


def linked(runs: tuple[np.ndarray, ...], most: int = LINKS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(A token, B token) of every link, in pieces of about ``most``."""
    side, token, other, size = runs
    piece = np.cumsum(size) // most
    for at in np.split(np.arange(len(size)), np.flatnonzero(np.diff(piece)) + 1):
        n = size[at]
        first = np.repeat(np.cumsum(n) - n, n)
        far = np.repeat(other[at], n) + np.arange(len(first)) - first
        near, is_b = np.repeat(token[at], n), np.repeat(side[at], n) == 1
        yield np.where(is_b, far, near), np.where(is_b, near, far)


# ---- tokens --------------------------------------------------------------------


def _by_rank(spec: dict, bytes_of: list[bytes]):
    """The vocabulary as ranks, where its merges make ids in rising order and every token
    longer than a byte: lowest id first is then lowest merge first.  Otherwise None."""
    import tiktoken

    model, vocab = spec["model"], spec["model"]["vocab"]
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if (splitter(spec.get("pre_tokenizer")).pattern != PATTERN or model.get("end_of_word_suffix") or made != sorted(set(made))
            or len(made) + 256 != len(vocab) or made[:1] < [max(vocab[c] for c in _byte_alphabet())]):
        return None
    return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={bytes_of[i]: i for i in vocab.values()}, special_tokens={})


class _Pair:
    """Both tokenizers and their tables of token bytes."""

    def __init__(self, spec_a: str, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(spec_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        back, spec = _byte_alphabet(), json.loads(spec_a)
        if spec.get("normalizer"):
            raise ValueError("tokenizer A must keep the bytes of a text: a file with a normalizer does not")
        vocab = spec["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocab.values(), default=0) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(back[c] for c in token)
        self.fast = _by_rank(spec, self.bytes_a)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # an id with what follows it: an A token's comma or bar, a B token's comma or semicolon
        self.names = np.array([f"{i}{mark}".encode() for n, mark in ((len(self.bytes_a), ","), (len(self.bytes_a), "|"), (len(self.bytes_b), ","),
                                                                     (len(self.bytes_b), ";")) for i in range(n)], object)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where the text is empty or a side's bytes differ."""
        a = self._encode_a([" " + t for t in texts])
        b = self.b.encode(texts, num_threads=1)
        for k, t in enumerate(texts):
            want = (" " + t).encode("utf-8")
            if not t or b"".join(map(self.bytes_b.__getitem__, b[k])) != want or b"".join(map(self.bytes_a.__getitem__, a[k])) != want:
                a[k], b[k] = [], []
        return a, b

    def _encode_a(self, texts: list[str]) -> list[list[int]]:
        """Texts of characters on whose classes all Unicode versions agree take the faster
        library where it merges as the file says, the others the file's own."""
        out: list[list[int]] = [[]] * len(texts)
        slow = []
        for k, t in enumerate(texts):
            if self.fast is not None and KNOWN.fullmatch(t) and not _GAP.search(t):
                out[k] = self.fast.encode_ordinary(t)
            else:
                slow.append(k)
        if slow:
            for k, e in zip(slow, self.a.encode_batch_fast([texts[k] for k in slow], add_special_tokens=False)):
                out[k] = e.ids
        return out


_PAIRS: dict[str, _Pair] = {}


def _pair_of(spec_a: str, model_b: bytes) -> _Pair:
    key = hashlib.sha256(spec_a.encode() + model_b).hexdigest()
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = _Pair(spec_a, model_b)
    return _PAIRS[key]


class _Batch:
    """Texts of one lockstep batch, flattened."""

    def __init__(self, pair: _Pair, a: list[list[int]], b: list[list[int]]):
        self.pair = pair
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a, b))
        self.a, self.b = (np.fromiter(chain.from_iterable(ids), np.int32, int(n.sum())) for ids, n in ((a, self.n_a), (b, self.n_b)))
        self.at_a, self.at_b = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        ends = []
        for ids, n, at, size in ((self.a, self.n_a, self.at_a, pair.size_a), (self.b, self.n_b, self.at_b, pair.size_b)):
            total = np.concatenate([[0], np.cumsum(size[ids])])
            ends.append(total[1:] - np.repeat(total[at[:-1]], n))
        full = np.flatnonzero(self.n_a)
        starts = np.stack([self.at_a[full], self.at_b[full], self.at_a[full + 1], self.at_b[full + 1]], axis=1)
        *self.runs, cut_a, cut_b = lockstep(*ends, lanes(*ends, starts))
        self.cut_a, self.cut_b = np.sort(cut_a), np.sort(cut_b)
        self.text = np.repeat(np.arange(len(a)), self.n_a)
        self.n_groups = np.bincount(self.text[self.cut_a], minlength=len(a))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, id pair, links) in order, and every pair of a text once; an id pair is
        the A id times 2^20 plus the B id."""
        keys, links = [], []
        for i, j in linked(self.runs):
            key = (self.text[i] << 40) | (self.a[i].astype(np.int64) << 20) | self.b[j]
            key, n = np.unique(key, return_counts=True)
            keys.append(key)
            links.append(n)
        if len(keys) == 1:
            key, n = keys[0], links[0]
        else:
            key, back = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(back, weights=np.concatenate(links), minlength=len(key)).astype(np.int64)
        return key >> 40, key & ((1 << 40) - 1), n

    def digests(self) -> list[str]:
        """SHA-256 of the groups as text, '' without tokens."""
        n_a, n_b, p = len(self.a), len(self.b), self.pair
        last_a, last_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
        last_a[self.cut_a], last_b[self.cut_b] = True, True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b, until_a = np.concatenate([[0], self.cut_b + 1]), np.append(self.cut_a + 1, 0)
        names = np.empty(n_a + n_b, np.int64)
        names[np.arange(n_a) + before_b[group_a]] = self.a + last_a * len(p.bytes_a)
        names[np.arange(n_b) + until_a[group_b]] = self.b + (2 * len(p.bytes_a) + last_b * len(p.bytes_b))
        said, at, out = p.names[names], self.at_a + self.at_b, []
        for k in range(len(self.n_a)):
            out.append(hashlib.sha256(b"".join(said[at[k]:at[k + 1]].tolist())[:-1]).hexdigest() if self.n_a[k] else "")
        return out


# ---- blocks --------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], pair: _Pair, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    task, made = TaskContext.get().partitionId(), 0
    rows: dict[str, list] = {}
    held = 0

    def fresh() -> None:
        nonlocal rows, held
        rows = {k: [] for k in ("ids", "n_a", "n_b", "n_groups", "n_links", "digest", "sizes", "key", "n")}
        held = 0

    def block() -> pa.RecordBatch:
        nonlocal made
        key, n = np.concatenate(rows["key"]), np.concatenate(rows["n"])
        known, place, count = np.unique(key, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")  # frequent pairs get small numbers
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        place = rank[place]
        big = np.flatnonzero(n > 255)
        made += 1
        # both numbers of a place apart, and links over 255 in a list of their own, pack well
        return pa.RecordBatch.from_pylist([{
            "block": (task << 32) + made, **{k: rows[k] for k in ("ids", "n_a", "n_b", "n_groups", "n_links", "digest", "sizes")},
            "low": place.astype(np.uint16).tobytes(), "high": (place >> 16).astype(np.uint16).tobytes(),
            "links": np.minimum(n, 255).astype(np.uint8).tobytes(), "more_at": big.astype(np.int64).tobytes(), "more": n[big].astype(np.int64).tobytes(),
            "pairs": known[order], "texts": count[order].astype(np.int32)}], schema)

    def work(ids: list, a: list[list[int]], b: list[list[int]]) -> None:
        nonlocal held
        batch = _Batch(pair, a, b)
        text, key, n = batch.pairs()
        rows["ids"] += ids
        rows["n_a"] += batch.n_a.tolist()
        rows["n_b"] += batch.n_b.tolist()
        rows["n_groups"] += batch.n_groups.tolist()
        rows["n_links"] += np.bincount(text, weights=n, minlength=len(ids)).astype(np.int64).tolist()
        rows["sizes"] += np.bincount(text, minlength=len(ids)).tolist()
        rows["digest"] += batch.digests()
        rows["key"].append(key)
        rows["n"].append(n)
        held += len(key)

    fresh()
    ids, a, b, tokens = [], [], [], 0
    for names, texts in _slices(batches):
        x, y = pair.encode(texts)
        ids += names
        a += x
        b += y
        tokens += sum(map(len, x)) + sum(map(len, y))
        if tokens >= BATCH_TOKENS:
            work(ids, a, b)
            ids, a, b, tokens = [], [], [], 0
            if held >= BLOCK_PAIRS:
                yield block()
                fresh()
    if ids:
        work(ids, a, b)
    if rows["ids"]:
        yield block()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of some MB at a time."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            t = t.as_py()
            ids.append(i)
            texts.append(t)
            size += len(t) + 64
            if size >= _TEXT_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _finished(schema: pa.Schema):
    def run(key: tuple, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        count = np.zeros(len(answers), np.int64)
        best = np.zeros(len(answers), bool)
        place = answers.column("place").to_numpy()
        count[place], best[place] = answers.column("count").to_numpy(), answers.column("best").to_numpy(zero_copy_only=False)
        out = []
        for r in blocks.to_pylist():
            at = np.frombuffer(r["low"], np.uint16).astype(np.int64) | np.frombuffer(r["high"], np.uint16).astype(np.int64) << 16
            n = np.frombuffer(r["links"], np.uint8).astype(np.int64)
            n[np.frombuffer(r["more_at"], np.int64)] = np.frombuffer(r["more"], np.int64)
            edge = np.concatenate([[0], np.cumsum(np.array(r["sizes"], np.int64))])
            total = [np.concatenate([[0], np.cumsum(v)]) for v in (n * best[at], n * count[at])]
            n_best, count_sum = (t[edge[1:]] - t[edge[:-1]] for t in total)
            out.append(pa.table([pa.array(r["ids"], schema.field(0).type), *(pa.array(r[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")),
                                 pa.array(n_best), pa.array(count_sum), pa.array(r["digest"])], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def aligned_blocks(df: DataFrame, spec_a: str, model_b: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of aligned texts, written to the shared folder: per text its counts and
    digest, per block its different id pairs with the number of texts that hold each."""
    src = df.select(col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    kind = src.schema["id"].dataType.simpleString()
    id_type = src.select("id").limit(0).toArrow().schema.field(0).type
    long_list = ("n_a", "n_b", "n_groups", "n_links")
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(id_type)), *((k, pa.list_(pa.int64())) for k in long_list),
                        ("digest", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64())), ("low", pa.binary()), ("high", pa.binary()),
                        ("links", pa.binary()), ("more_at", pa.binary()), ("more", pa.binary()), ("pairs", pa.list_(pa.int64())),
                        ("texts", pa.list_(pa.int32()))])
    ddl = (f"block long, ids array<{kind}>, " + ", ".join(f"{k} array<long>" for k in long_list)
           + ", digest array<string>, sizes array<long>, low binary, high binary, links binary, more_at binary, more binary, "
             "pairs array<long>, texts array<int>")
    # both files are of fixed size, whatever the data (2 MB and 0.5 MB)
    shared = df.sparkSession.sparkContext.broadcast((spec_a, model_b))
    return staged(src.mapInArrow(lambda b: _blocks(b, _pair_of(*shared.value), schema), ddl), "align-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, count, best)``: in how many texts an id pair is linked, and whether no pair
    of its A id is in more."""
    one = blocks.select(F.explode(F.arrays_zip("pairs", "texts")).alias("p"))
    counts = staged(one.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.texts").alias("count")), "align-counts")
    a = F.shiftright("pair", 20)
    top = counts.groupBy(a.alias("a")).agg(F.max("count").alias("top"))
    return counts.withColumn("a", a).join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def align_report(df: DataFrame, spec_a: str, model_b: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``
    (links whose pair is the most frequent of its A id, ties included), ``count_sum``
    (counts summed over links) and ``groups_sha256``."""
    blocks = aligned_blocks(df, spec_a, model_b, id_col, text_col)
    asked = blocks.select(F.col("block").alias("to"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(blocks), "pair").select("to", "place", "count", "best")
    kind = dict(blocks.dtypes)["ids"].removeprefix("array<").removesuffix(">")
    id_type = blocks.select("ids").limit(0).toArrow().schema.field(0).type.value_type
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = pa.schema([("id", id_type), *((k, pa.int64()) for k in names), ("groups_sha256", pa.string())])
    texts = blocks.drop("pairs", "texts")
    out = texts.groupBy("block").cogroup(answers.groupBy("to")).applyInArrow(
        _finished(schema), f"id {kind}, " + ", ".join(f"{k} long" for k in names) + ", groups_sha256 string")
    return out.withColumnRenamed("id", id_col)


def align_links(df: DataFrame, spec_a: str, model_b: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment itself: per document its groups as ``array<struct<a, b>>`` of id lists."""
    src = df.select(col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    kind = src.schema["id"].dataType.simpleString()
    id_type = src.select("id").limit(0).toArrow().schema.field(0).type
    group = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
    shared = df.sparkSession.sparkContext.broadcast((spec_a, model_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair_of(*shared.value)
        for names, texts in _slices(batches):
            b = _Batch(pair, *pair.encode(texts))
            groups: list[list] = [[] for _ in names]
            i = j = 0
            for x, y in zip((b.cut_a + 1).tolist(), (b.cut_b + 1).tolist()):
                groups[b.text[i]].append({"a": b.a[i:x].tolist(), "b": b.b[j:y].tolist()})
                i, j = x, y
            yield pa.RecordBatch.from_arrays([pa.array(names, id_type), pa.array(groups, group)], names=["id", "groups"])

    return src.mapInArrow(run, f"id {kind}, groups array<struct<a: array<int>, b: array<int>>>").withColumnRenamed("id", id_col)
