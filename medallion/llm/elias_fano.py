"""Elias-Fano sequences and a level-by-level n-gram trie over numpy arrays.

A monotone sequence keeps the low bits of each value in whole bytes and the high
bits as unary gaps in a bit vector with a small directory.  The trie's first level
holds the contexts, the second their successors; pointers mark where each context's
successors start.  A successor is stored as its rank among the trie's words plus the
last value of the range before, so the whole level is one monotone sequence, and a
lookup searches from the value its context starts at.  A further level is a trie of the
same kind whose contexts are places in the level before it.  Levels are written to one
mapping, over a file if one is named and over anonymous memory otherwise; all lookups take
arrays.
"""

from __future__ import annotations

import mmap
import os

import numpy as np

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_ONES = _BITS.sum(axis=1).astype(np.int64)
#: _SELECT[bit][byte][k]: place of the k-th (from 0) such bit in the byte.
_SELECT = np.full((2, 256, 8), 8, np.int64)
for _b in (0, 1):
    for _v in range(256):
        _at = np.flatnonzero(_BITS[_v] == _b)
        _SELECT[_b, _v, :len(_at)] = _at


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit values."""

    def __init__(self, count: int, shift: int, low: np.ndarray, high: np.ndarray):
        self.count, self.shift, self.low, self.high = count, shift, low, high
        ones = np.concatenate([[0], np.cumsum(_ONES[high])])
        self.ones, self.zeros = ones, 8 * np.arange(len(ones)) - ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        shift = min(56, 8 * max(0, -(-max(0, (top // max(n, 1)).bit_length() - 4) // 8)))
        low = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :shift // 8].copy()
        high = (values >> np.uint64(shift)).astype(np.int64)
        bits = np.zeros((int(high[-1]) if n else 0) + n + 1, np.uint8)
        bits[high + np.arange(n)] = 1
        return cls(n, shift, low, np.packbits(bits, bitorder="little"))

    def _select(self, bit: int, k: np.ndarray) -> np.ndarray:
        cum = self.ones if bit else self.zeros
        byte = np.searchsorted(cum, k, side="right") - 1
        byte = np.minimum(byte, len(self.high) - 1)
        return 8 * byte + _SELECT[bit, self.high[byte], np.minimum(k - cum[byte], 7)]

    def _lows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for b in range(self.shift // 8):
            out |= self.low[at, b].astype(np.uint64) << np.uint64(8 * b)
        return out

    def values(self, at: np.ndarray) -> np.ndarray:
        high = (self._select(1, at) - at).astype(np.uint64)
        return high << np.uint64(self.shift) | self._lows(at)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value not below ``x``; ``count`` if there is none."""
        high = (x >> np.uint64(self.shift)).astype(np.int64)
        last = int(self.zeros[-1])
        edge = lambda h: np.where(h <= 0, 0, np.where(h > last, self.count, np.minimum(
            self._select(0, np.clip(h - 1, 0, max(last - 1, 0))) - h + 1, self.count)))
        lo, hi = edge(high), edge(high + 1)
        want = x & np.uint64((1 << self.shift) - 1)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            less = np.zeros(len(x), bool)
            less[open_] = self._lows(mid[open_]) < want[open_]
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        return lo

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each value, -1 where it is not in the sequence."""
        at = self.successor(x)
        out = np.full(len(x), -1, np.int64)
        some = np.flatnonzero(at < self.count)
        some = some[self.values(at[some]) == x[some]]
        out[some] = at[some]
        return out


class Trie:
    """N-grams (context, word hash) with a code each and totals per context.  A context is
    a word's hash, or an n-gram's place in the level before."""

    LEVELS = ("contexts", "words", "pointers", "successors")

    def __init__(self, levels: dict[str, EliasFano], totals, kinds, codes):
        self.levels, self.totals, self.kinds, self.codes = levels, totals, kinds, codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, count: np.ndarray, code) -> Trie:
        """From bigrams sorted by (context, word), each once."""
        new = np.ones(len(context), bool)
        new[1:] = context[1:] != context[:-1]
        start = np.flatnonzero(new)
        words = np.unique(word)
        rank = np.searchsorted(words, word).astype(np.uint64)
        ends = np.append(start, len(context))[1:].astype(np.int64)
        last = rank[ends - 1] + np.uint64(1) if len(ends) else rank
        base = np.concatenate([[0], np.cumsum(last)[:-1]]).astype(np.uint64) if len(ends) else rank
        owner = np.cumsum(new) - 1
        seq = base[owner] + rank if len(context) else rank
        levels = {"contexts": context[start], "words": words, "pointers": np.append(start, len(context)).astype(np.uint64),
                  "successors": seq}
        totals = np.add.reduceat(count, start) if len(start) else count[:0]
        return cls({k: EliasFano.build(v.astype(np.uint64)) for k, v in levels.items()}, totals,
                   ends - start, code(count))

    def mapped(self, path: str | None = None) -> Trie:
        """The trie over a memory mapping: of a new file at ``path`` (the caller removes
        it), or without a file."""
        arrays = [a for k in self.LEVELS for a in (self.levels[k].low, self.levels[k].high)]
        arrays += [self.totals, self.kinds, self.codes]
        size = sum(a.nbytes for a in arrays) + 1
        if path is None:
            space = mmap.mmap(-1, size)
        else:
            with open(path, "xb+") as f:
                f.truncate(size)
                space = mmap.mmap(f.fileno(), size)
        whole, at, views = np.frombuffer(space, np.uint8), 0, []
        for a in arrays:
            whole[at:at + a.nbytes] = np.frombuffer(np.ascontiguousarray(a).tobytes(), np.uint8)
            views.append(whole[at:at + a.nbytes].view(a.dtype).reshape(a.shape) if a.dtype.itemsize == 1
                         else np.frombuffer(space, a.dtype, a.size, at).reshape(a.shape))
            at += a.nbytes
        levels = {k: EliasFano(self.levels[k].count, self.levels[k].shift, views[2 * i], views[2 * i + 1])
                  for i, k in enumerate(self.LEVELS)}
        return Trie(levels, *views[8:])

    def contexts(self, context: np.ndarray) -> np.ndarray:
        return self.levels["contexts"].find(context)

    def places(self, at: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of the n-grams (context at place ``at``, word), -1 if not there."""
        out = np.full(len(at), -1, np.int64)
        rank = self.levels["words"].find(word)
        some = np.flatnonzero((at >= 0) & (rank >= 0))
        if not len(some):
            return out
        at, rank = at[some], rank[some].astype(np.uint64)
        first, end = (self.levels["pointers"].values(at + i).astype(np.int64) for i in (0, 1))
        seq = self.levels["successors"]
        # a range starts one above the last value of the range before
        base = np.where(first > 0, seq.values(np.maximum(first - 1, 0)) + np.uint64(1), np.uint64(0))
        place = seq.find(base + rank)
        ok = (place >= first) & (place < end)
        out[some[ok]] = place[ok]
        return out

    def of(self, values: np.ndarray, place: np.ndarray) -> np.ndarray:
        """What the level holds at each place (``totals``, ``kinds`` or ``codes``), 0 at -1."""
        return np.where(place >= 0, values[np.maximum(place, 0)], 0).astype(values.dtype) if len(values) else np.zeros(len(place), values.dtype)

    def lookup(self, at: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of the n-grams (context at place ``at``, word); 0: not there."""
        return self.of(self.codes, self.places(at, word))
