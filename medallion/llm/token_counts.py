"""Token counts by the whole-token shortcut.

Before any text is read, each string of the vocabulary is encoded by itself: those that
give back one token are *whole*.  A pre-token that is whole counts as one token with no
merge; only the others are merged, by rank, and their counts are remembered.

Read from the tokenizer file: vocabulary, merges, end-of-word suffix, added tokens, and of
the normaliser and pre-tokeniser the parts named in ``_normal`` and ``splitter``; a file
with others raises ``ValueError``.  Characters below U+0530 are normalised and split here;
a text with others is handed to the file's own normaliser and pre-tokeniser, so both use
one version of the Unicode tables.  Added tokens inside a text count as one each.

Null text is empty: no bytes, no tokens.  Texts are counted whole, whatever their length; a
pre-token of n bytes takes n log n steps.  Rows that repeat an id are counted each, an empty
table gives no rows, and other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator

import regex
from pyspark.sql import DataFrame

from medallion.llm.bpe import PATTERN, _byte_alphabet
from medallion.llm.common import col, text_or_empty

LIMIT = 2048
_MEMO, _PIECE_MEMO_CHARS = 300_000, 64
#: Characters whose classes all versions of the Unicode tables agree on.
KNOWN = regex.compile(r"[\x00-ԯ]*")


def _lowered(text: str) -> str:
    """Each character by itself: no final sigma."""
    return text.replace("Σ", "σ").lower()


def _normal(spec: dict | None) -> Callable[[str], str]:
    kind = spec["type"] if spec else None
    if kind is None:
        return lambda t: t
    if kind == "Sequence":
        steps = [_normal(s) for s in spec["normalizers"]]

        def run(text: str) -> str:
            for step in steps:
                text = step(text)
            return text
        return run
    if kind == "NFC":
        return lambda t: unicodedata.normalize("NFC", t)
    if kind == "Lowercase":
        return _lowered
    if kind == "Replace" and "Regex" in spec["pattern"]:
        find, into = regex.compile(spec["pattern"]["Regex"]), spec["content"].replace("\\", r"\\")
        return lambda t: find.sub(into, t)
    raise ValueError(f"normalizer {kind} is not supported")


def splitter(spec: dict | None) -> regex.Pattern:
    """The pattern whose matches are the pre-tokens."""
    steps = spec["pretokenizers"] if spec and spec["type"] == "Sequence" else [spec or {"type": None}]
    last = steps[-1]
    if last["type"] != "ByteLevel" or last["add_prefix_space"]:
        raise ValueError("the pre-tokenizer must end in ByteLevel without a prefix space")
    if len(steps) == 1 and last["use_regex"]:
        return regex.compile(PATTERN)
    first = steps[0]
    if (len(steps) == 2 and not last["use_regex"] and first["type"] == "Split" and "Regex" in first["pattern"]
            and first["behavior"] == "Removed" and first["invert"]):
        return regex.compile(first["pattern"]["Regex"])
    raise ValueError("this sequence of pre-tokenizers is not supported")


class Merger:
    """Vocabulary and merges of a tokenizer file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model.get("type") != "BPE" or any(model.get(k) for k in ("unk_token", "dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("only BPE without unknown token, dropout, prefixes, byte fallback and ignored merges is supported")
        self.back = _byte_alphabet()
        self.letter = {b: c for c, b in self.back.items()}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        if any(c + s not in self.vocab for c in self.back for s in {"", self.suffix}):
            raise ValueError("the vocabulary lacks single bytes")

    def ids(self, letters: str) -> list[int]:
        """Ids of a pre-token given in the byte alphabet: merges by rank, the leftmost
        of one rank first."""
        token = [self.vocab[c] for c in letters]
        if not token:
            return token
        token[-1] = self.vocab[letters[-1] + self.suffix]
        n, find = len(token), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1]) for i in range(n - 1) if (m := find((token[i], token[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i]
            if token[i] < 0 or j >= n or find((token[i], token[j])) != (rank, made):
                continue
            token[i], token[j] = made, -1
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                if m := find((made, token[j])):
                    heapq.heappush(heap, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := find((token[h], made))):
                heapq.heappush(heap, (m[0], h, m[1]))
        return [t for t in token if t >= 0]

    def count(self, piece: str) -> int:
        return len(self.ids("".join(map(self.letter.__getitem__, piece.encode("utf-8")))))


def whole_tokens(spec_json: str) -> frozenset[str]:
    """The texts of the vocabulary that encode alone as the one token they name."""
    m, out = Merger(json.loads(spec_json)), set()
    for token, i in m.vocab.items():
        if not token.endswith(m.suffix):
            continue
        letters = token[:len(token) - len(m.suffix)] if m.suffix else token
        try:
            text = bytes(m.back[c] for c in letters).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if text and m.ids(letters) == [i]:
            out.add(text)
    return frozenset(out)


class _Counts(dict):
    """Pre-token → number of tokens: 1 for whole ones, others merged when first met."""

    def __init__(self, merger: Merger, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.merger, self.whole = merger, whole

    def __missing__(self, piece: str) -> int:
        n = self.merger.count(piece)
        if len(piece) <= _PIECE_MEMO_CHARS:
            if len(self) >= len(self.whole) + _MEMO:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[piece] = n
        return n


class TokenCounter:
    def __init__(self, spec_json: str, whole: frozenset[str]):
        spec = json.loads(spec_json)
        self.spec_json, self._library = spec_json, None
        self.normal, self.split = _normal(spec.get("normalizer")), splitter(spec.get("pre_tokenizer"))
        self.counts, self.whole = _Counts(Merger(spec), whole), whole
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens with conditions are not supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None

    def _pieces(self, text: str) -> list[str]:
        if KNOWN.fullmatch(text):
            return self.split.findall(self.normal(text))
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.spec_json)
        t, back = self._library, self.counts.merger.back
        text = t.normalizer.normalize_str(text) if t.normalizer else text
        return [bytes(back[c] for c in letters).decode("utf-8") for letters, _ in t.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, text: str) -> tuple[int, int, int]:
        """(tokens, pre-tokens, pre-tokens counted by the shortcut)."""
        parts, n = [text], 0
        if self.added:
            parts = self.added.split(text)
            n = len(parts) - 1
        pieces = [p for part in parts for p in self._pieces(part)] if len(parts) > 1 else self._pieces(text)
        return n + sum(map(self.counts.__getitem__, pieces)), len(pieces), sum(map(self.whole.__contains__, pieces))


_COUNTERS: dict[str, TokenCounter] = {}


def _counter_of(spec_json: str, whole: frozenset[str]) -> TokenCounter:
    key = hashlib.sha256(spec_json.encode()).hexdigest()
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = TokenCounter(spec_json, whole)
    return _COUNTERS[key]


def token_counts(df: DataFrame, spec_json: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit``, ``n_pieces``
    (pre-tokens) and ``n_whole`` (of these, counted without a merge)."""
    src = df.select(col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    kind = src.schema["id"].dataType.simpleString()
    # both are as large as the vocabulary, whatever the data
    shared = df.sparkSession.sparkContext.broadcast((spec_json, whole_tokens(spec_json)))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        counter = _counter_of(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                size = pc.binary_length(part.column(1)).cast(pa.int64())
                n, pieces, whole = (pa.array(x, pa.int64()) for x in zip(*(counter.count(t.as_py()) for t in part.column(1))))
                yield pa.RecordBatch.from_arrays([part.column(0), size, n, pc.greater(n, limit), pieces, whole],
                                                 names=["id", "n_bytes", "n_tokens", "over_limit", "n_pieces", "n_whole"])

    out = src.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, n_pieces long, n_whole long")
    return out.withColumnRenamed("id", id_col)
