"""Byte-level BPE by per-prefix dynamic programming.

For a piece of text (the pre-tokeniser's unit) every prefix has exactly one last
token in its BPE encoding.  An automaton over the vocabulary reports each token
that ends at a place; the token that fits is the one which is compatible with the
last token stored for the prefix before it.  Back-pointers from the end give the
exact ids, in time linear in the piece.

Two tokens are compatible if BPE keeps them apart: no merge joins a piece on the
right edge of the first to a piece on the left edge of the second before either
is consumed by its own next merge.

The work runs in ``mapInArrow`` over whole rows; a worker keeps one vocabulary
and a bounded memory of encoded pieces.  Null text is empty: no ids, empty text.
Rows that repeat an id are encoded each, an empty table gives no rows, and other
columns are not read.  A tokenizer file with a normaliser, another pre-tokeniser or
conditions on its added tokens raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import col, text_or_empty

# The pre-tokeniser pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_MEMO = 400_000
_PIECE_MEMO_CHARS = 64
_NEVER = 1 << 60


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-in → byte: printable Latin-1 bytes stand for themselves,
    the others take the characters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return out


def _supported(spec: dict) -> None:
    """Raise for what this codec would encode otherwise than the file says."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if spec.get("normalizer"):
        raise ValueError("a tokenizer with a normalizer is not supported")
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("only the byte-level pre-tokenizer without a prefix space is supported")
    if model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                                       "byte_fallback", "ignore_merges")):
        raise ValueError("only plain byte-level BPE is supported")
    if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens with conditions are not supported")


class BpeCodec:
    """A byte-level BPE vocabulary read from a tokenizer JSON file."""

    def __init__(self, spec: dict):
        import ahocorasick

        _supported(spec)
        model, back = spec["model"], _byte_alphabet()
        raw = {k: bytes(back[c] for c in k) for k in model["vocab"]}
        self.bytes_of: dict[int, bytes] = {i: raw[k] for k, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.names = {i: str(i) for i in self.bytes_of}
        self._merge: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        self._rank: dict[int, int] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            pair, made = (model["vocab"][a], model["vocab"][b]), model["vocab"][a + b]
            self._merge[pair] = rank
            if made not in self._parts:
                self._parts[made], self._rank[made] = pair, rank
        self._fits: dict[tuple[int, int], bool] = {}
        self._memo: dict[str, tuple[int, ...]] = {}
        self._find = ahocorasick.Automaton()
        for k, i in model["vocab"].items():
            if len(raw[k]) == 1 or i in self._parts:
                self._find.add_word(raw[k].decode("latin-1"), (len(raw[k]), i))
        self._find.make_automaton()
        self._split = regex.compile(PATTERN)
        self._specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(piece, rank of the merge that consumes it) from the token down its
        left (0) or right (1) edge."""
        out, until = [(token, _NEVER)], _NEVER
        while token in self._parts:
            until, token = self._rank[token], self._parts[token][side]
            out.append((token, until))
        return out

    def compatible(self, a: int, b: int) -> bool:
        got = self._fits.get((a, b))
        if got is None:
            left = self._edge(b, 0)
            # of equal ranks the one further left comes first
            got = not any((m := self._merge.get((x, y))) is not None and m < x_until and m <= y_until
                          for x, x_until in self._edge(a, 1) for y, y_until in left)
            if len(self._fits) >= 2 * _MEMO:
                self._fits.clear()
            self._fits[a, b] = got
        return got

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8").decode("latin-1")
        n = len(data)
        last: list[int] = [-1] * (n + 1)
        start_of = [0] * (n + 1)
        fits, known = self.compatible, self._fits
        for end, (size, token) in self._find.iter(data):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                ok = known.get((before, token))
                if not (fits(before, token) if ok is None else ok):
                    continue
            last[end], start_of[end] = token, start
        ids = []
        while n:
            ids.append(last[n])
            n = start_of[n]
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text; special tokens in it keep their own ids."""
        if self._specials is None:
            return self._plain(text, [])
        ids: list[int] = []
        at = 0
        for m in self._specials.finditer(text):
            self._plain(text[at:m.start()], ids)
            ids.append(self.special[m.group()])
            at = m.end()
        return self._plain(text[at:] if at else text, ids)

    def _plain(self, text: str, ids: list[int]) -> list[int]:
        memo = self._memo
        for piece in self._split.findall(text):
            got = memo.get(piece)
            if got is None:
                got = self._encode_piece(piece)
                if len(piece) <= _PIECE_MEMO_CHARS:
                    if len(memo) >= _MEMO:
                        memo.clear()
                    memo[piece] = got
            ids.extend(got)
        return ids

    def decode(self, ids) -> str:
        look = self.bytes_of
        return b"".join([look[i] for i in ids]).decode("utf-8", errors="replace")


_CODECS: dict[str, BpeCodec] = {}


def codec_of(spec_json: str) -> BpeCodec:
    """The codec of a tokenizer file's text, one per worker."""
    key = hashlib.sha256(spec_json.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = BpeCodec(json.loads(spec_json))
    return _CODECS[key]


def read_spec(path: str) -> str:
    """The tokenizer file, read on the driver (its size does not depend on the
    data: a vocabulary of 50,257 entries, about 2 MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


_DIGEST = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


def _map(df: DataFrame, id_col: str, text_col: str, spec: str, fields: dict[str, str], row) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(spec)
    src = df.select(col(id_col).alias("__id"), text_or_empty(text_col).alias("__t"))
    id_type = src.schema["__id"].dataType.simpleString()

    def run(batches: Iterator):
        import pyarrow as pa

        kinds = [{"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}[k] for k in fields.values()]
        codec = codec_of(shared.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 64):
                rows = [row(codec, t.as_py()) for t in texts[at:at + 64]]
                yield pa.RecordBatch.from_arrays([ids[at:at + 64], *map(pa.array, zip(*rows), kinds)],
                                                 names=["__id", *fields])

    ddl = ", ".join(f"{name} {kind}" for name, kind in fields.items())
    return src.mapInArrow(run, f"__id {id_type}, {ddl}").withColumnRenamed("__id", id_col)


def _digests(codec: BpeCodec, text: str) -> tuple[int, str, str]:
    ids = codec.encode(text)
    names = codec.names
    return (len(ids), hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest(),
            hashlib.sha256(codec.decode(ids).encode("utf-8")).hexdigest())


def bpe_digest(df: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: count of ids, digests of the ids and of the text
    decoded from them."""
    return _map(df, id_col, text_col, spec, _DIGEST, _digests)


def bpe_encode(df: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its ids as ``ids array<int>``."""
    return _map(df, id_col, text_col, spec, {"ids": "array<int>"}, lambda c, t: (c.encode(t),))


def bpe_decode(df: DataFrame, spec: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ids with their text; unknown ids raise ``KeyError``."""
    src = df.select(col(id_col), F.to_json(F.coalesce(col(ids_col), F.array().cast("array<int>"))).alias("__ids"))
    return _map(src, id_col, "__ids", spec, {"text": "string"}, lambda c, t: (c.decode(json.loads(t)),))
