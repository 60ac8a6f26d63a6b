"""Near-duplicate lines by an edit-distance join.

Units.  Lines of ``long_from`` characters and ``min_words`` words or more are compared word by
word, others character by character.  Two lines are linked if the edits between them (units
put in, left out or replaced) are at most those allowed for the shorter: ``max_edits``
characters, or ``word_edits`` of its number of words.  A line of words and one of characters
are compared as the shorter one is, if that is the one of characters.

Join.  Cut the shorter line into as many segments as edits are allowed, and one more: one of
them stands unchanged in the longer, near the same place.  Each line gives its own segments
(index side) and the substrings of it that can meet a segment of any partner of fitting length
(probe side); the start places follow the multi-match rule.  A task packs the keys of many
lines for shards by hash; a shard keeps the keys that an index line and another probe line
share.  A key that many lines of one task have goes past the shards, which only learn of it,
so no shard holds all rows of a frequent key.  Then the texts of the lines that are left join,
keys are dealt in blocks of bounded size, and pairs of an index and a probe row that agree in
length and in a sketch of their units are verified by banded bit-parallel edit distance.

A pair is counted at the first key the two share only, so links are counted once and
need not be listed: blocks give each line's number of links and a spanning set of
merges for the classes.  A key with more rows than a block holds is dealt as pairs of
blocks, so no key is one task and no pair is left out.

Lines are the ``\\n``-separated parts of a text with white space trimmed.  Lines under
``min_chars`` characters match only equal lines, blank ones none.  Of each class the
line that occurs first, by (id, line number), stays; null ids come last.  Null text
has no lines; very long lines cost time in proportion to length and edits.  An empty table
gives no rows, other columns are not read.  Of rows that repeat an id only one keeps a line
of a class.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce
from operator import ne, or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import col, staged, text_or_empty
from medallion.llm.components import components

MAX_EDITS, MIN_CHARS, LONG_FROM, MIN_WORDS, BLOCK = 2, 20, 96, 8, 2048
#: Word edits allowed from so many words on.
WORD_EDITS = ((8, 1), (16, 2), (24, 4))
#: Bytes of text for each shard; lines and characters of a task's block; lines of a key in a
#: block from which it goes past the shards.
SHARD_BYTES, BLOCK_LINES, BLOCK_CHARS, FREQUENT = 32 << 20, 100_000, 16 << 20, 64
#: Characters of the lines whose words are hashed at once, or one line.
PART_CHARS = 1 << 20
#: Rows of a group of keys whose pairs are verified together; pairs whose lengths and sketches
#: are compared at once, or those of one index row.
GROUP_ROWS, PAIRS = 2000, 50_000
_SPACES = " \t\n\x0b\x0c\r"
_ALL = 2**64 - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so powers of it have inverses
_UNBASE = pow(_BASE, -1, 2**64)


def word_edits(n: int) -> int:
    """Edits allowed for a line of ``n`` words."""
    return max((e for least, e in WORD_EDITS if n >= least), default=0)


def segments(length: int, max_edits: int) -> list[tuple[int, int]]:
    """(start, length) of the near-equal segments of a line of that length; the
    longer ones come last."""
    k = max_edits + 1
    short, long_ones = length // k, length % k
    out, at = [], 0
    for i in range(k):
        n = short + (i >= k - long_ones)
        out.append((at, n))
        at += n
    return out


def probe_starts(length: int, partner: int, i: int, start: int, n: int, max_edits: int) -> range:
    """Places in a line of ``length`` where segment ``i`` of a shorter or equal
    partner may stand: from both ends, whichever end the segment is nearer."""
    diff = length - partner
    lo = max(start - i, start + diff - (max_edits - i), 0)
    hi = min(start + i, start + diff + (max_edits - i), length - n)
    return range(lo, hi + 1)


@lru_cache(100_000)
def _slices(length: int, words: bool, max_edits: int, own: bool) -> tuple[tuple[int, int, int, int], ...]:
    """(segment, edits, start, length) of a line's own segments or of its probes; a
    substring that serves partners of several lengths is one probe."""
    edits = word_edits if words else lambda n: max_edits
    if own:
        return tuple((i, edits(length), at, n) for i, (at, n) in enumerate(segments(length, edits(length))))
    out = set()
    for partner in range(max(length - (max(e for _, e in WORD_EDITS) if words else max_edits), 1), length + 1):
        e = edits(partner)
        if length - partner <= e < partner and e:
            for i, (start, n) in enumerate(segments(partner, e)):
                out.update((i, e, at, n) for at in probe_starts(length, partner, i, start, n, e))
    return tuple(sorted(out))


def within(a: Sequence, b: Sequence, most: int) -> bool:
    """Edit distance at most ``most``, by bit vectors of the cells near the diagonal: a
    column of 2 ``most`` + 1 cells is a number, and a unit of ``b`` one step of it."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return False
    if not most or not b:
        return len(a) <= most or list(a) == list(b)
    if len(a) == len(b) and sum(map(ne, a, b)) <= most:
        return True
    # units that both start or both end with do not matter
    lo = _common(a, b)
    a, b = a[lo:], b[lo:]
    hi = _common(a[::-1], b[::-1])
    a, b = a[:len(a) - hi], b[:len(b) - hi]
    m, n = len(a), len(b)
    if m <= most or not n:
        return m <= most
    # bit k of a column stands for row j + k - most - 1 of a: the top bit is the lowest row
    width = 2 * most + 2
    mask, top, last = (1 << width) - 1, 1 << (width - 1), 1 << (width - 2)
    rows = _places(a)
    up, down, cost = (mask << (most + 1)) & mask, 0, most
    far = 2 * most + n - m  # from here on the rest cannot bring it back
    for j, unit in enumerate(b):
        at = j - most - 1
        here = rows.get(unit, 0)
        here = (here >> at if at >= 0 else here << -at) & mask
        zero = ((((here & up) + up) ^ up) | here | down) & mask
        right, left = (down | ~(zero | up)) & mask, zero & up
        if j < m - most:
            cost += not zero & top  # along the lowest diagonal
        else:  # along the last row
            cost += bool(right & last) - bool(left & last)
            last >>= 1
        if cost > far:
            return False
        zero >>= 1
        up, down = (left | ~(zero | right)) & mask, zero & right
    return cost <= most


def _places(a: Sequence) -> dict:
    """Unit → number whose bits are its places."""
    where: dict = {}
    for i, x in enumerate(a):
        where.setdefault(x, []).append(i)
    out = {}
    for x, places in where.items():
        bits = bytearray(places[-1] // 8 + 1)
        for i in places:
            bits[i >> 3] |= 1 << (i & 7)
        out[x] = int.from_bytes(bits, "little")
    return out


def _common(a: Sequence, b: Sequence) -> int:
    """Length of the common start."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        part = min(step, n - at)
        if a[at:at + part] == b[at:at + part]:
            at += part
            step *= 2
        elif part == 1:
            break
        else:
            n, step = at + part, max(part // 2, 1)
    return at


# ---- keys ----------------------------------------------------------------------


_SPACE = np.isin(np.arange(256), list(_SPACES.encode()))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n`` - 1 of the base and of its inverse."""
    return tuple(np.cumprod(np.append(np.uint64(1), np.full(n - 1, b, np.uint64)), dtype=np.uint64) for b in (_BASE, _UNBASE))


@lru_cache(1)
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _power_table(PART_CHARS + (PART_CHARS >> 2))


def _sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the first k ``values``, each times its power of the base, and the inverse powers:
    the hash of values a to b - 1 is ``(sums[b] - sums[a]) * back[a]``, wherever they stand."""
    n = len(values) + 1
    power, back = _usual_powers() if n <= len(_usual_powers()[0]) else _power_table(n)
    sums = np.zeros(n, np.uint64)
    np.cumsum(values * power[:n - 1], out=sums[1:])
    return sums, back[:n]


def _spans(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Cuts texts of so many characters into runs of ``PART_CHARS`` or one text, at least one run."""
    start, chars = 0, 0
    for k, n in enumerate(sizes):
        if k > start and chars + n > PART_CHARS:
            yield start, k
            start, chars = k, 0
        chars += n
    yield start, len(sizes)


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and the number of words of each."""
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(_SPACE[data])) + 1  # where words start and end, by turns
    start, end = edge[::2], edge[1::2]
    after = np.cumsum([len(t) + 1 for t in texts])
    count = np.diff(np.searchsorted(start, after, "right"), prepend=0)
    sums, back = _sums(data.astype(np.uint64) + np.uint64(1))
    return _mixed((sums[end] - sums[start]) * back[start]), count


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEED = 0xD6E8FEB86659FD93


def _seed(i: int, edits: int) -> int:
    return (i * 64 + edits + 1) * _SEED & _ALL


def _word_slice(hashes: Sequence[int], i: int, edits: int) -> int:
    """Key of a substring given by its words' hashes."""
    total = 0
    for h in reversed(hashes):
        total = (total * _BASE + int(h)) & _ALL
    return int(_mixed(np.array([total + _seed(i, edits) & _ALL], np.uint64))[0])


def _char_slice(text: str, i: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), i + 1)


def by_words(text: str, long_from: int) -> bool:
    return len(text) >= long_from and len(text.encode("utf-8", "surrogatepass").split()) >= MIN_WORDS


def _units(text: str, words: bool) -> Sequence:
    return text.encode("utf-8", "surrogatepass").split() if words else text


@lru_cache(100_000)
def _slice_table(words: int, own: bool) -> np.ndarray:
    """Rows of the start, end and seed number of a line's slices by words."""
    return np.array([(at, at + n, i * 64 + e + 1) for i, e, at, n in _slices(words, True, 0, own)], np.int64).reshape(-1, 3).T


def _word_keys(ids: np.ndarray, hashes: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, line, is index side) of lines of words, the words of all of them one after another."""
    sums, back = _sums(hashes)
    start = np.cumsum(count) - count
    for own in (True, False):
        tables = [_slice_table(n, own) for n in count.tolist()]
        each = np.array([t.shape[1] for t in tables])
        at, end, seed = np.concatenate(tables, axis=1)
        begin = np.repeat(start, each)
        end += begin
        at += begin
        key = _mixed((sums[end] - sums[at]) * back[at] + seed.astype(np.uint64) * np.uint64(_SEED))
        yield key, np.repeat(ids, each), np.full(len(key), own)


def _part_keys(lines: list[tuple[int, str]], max_edits: int, min_chars: int, long_from: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    keys, owners, sides = [], [], []
    long = [(line, text) for line, text in lines if len(text) >= max(long_from, min_chars, max_edits + 1)]
    by_word: set[int] = set()
    if long:
        hashes, count = _word_hashes([text.encode("utf-8", "surrogatepass") for _, text in long])
        many = count >= MIN_WORDS
        if many.any():
            ids = np.array([line for line, _ in long], np.int64)[many]
            by_word = set(ids.tolist())
            yield from _word_keys(ids, hashes[np.repeat(many, count)], count[many])
    for line, text in lines:
        if len(text) < max(min_chars, max_edits + 1):
            continue
        if line in by_word:
            if len(text) >= long_from + max_edits:
                continue
        else:
            for i, _, at, n in _slices(len(text), False, max_edits, True):
                keys.append(_char_slice(text[at:at + n], i))
                owners.append(line)
                sides.append(True)
        # a line of words just above the border may be the longer one of a pair by characters
        for i, _, at, n in _slices(len(text), False, max_edits, False):
            keys.append(_char_slice(text[at:at + n], i))
            owners.append(line)
            sides.append(False)
    yield np.array(keys, np.uint64), np.array(owners, np.int64), np.array(sides, bool)


def _keys(lines: list[tuple[int, str]], max_edits: int, min_chars: int, long_from: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, line, is index side) of some lines, each named once; the keys of a line and side
    come in the order of its segments."""
    parts = [part for a, b in _spans([len(text) for _, text in lines]) for part in _part_keys(lines[a:b], max_edits, min_chars, long_from)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _placed(key: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, key within it) of a 64-bit key; shards follow the order of the keys."""
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)


_SENT = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("lines", pa.binary()), ("sides", pa.binary()), ("known", pa.bool_())])


def _to_shards(batches: Iterator[pa.RecordBatch], shards: int, max_edits: int, min_chars: int, long_from: int) -> Iterator[pa.RecordBatch]:
    """Rows of packed (key, line, side) for shards; ``known`` rows hold whole keys that are
    frequent in their block and need no shard to find their partners."""
    task, made = TaskContext.get().partitionId(), 0
    held: dict[int, str] = {}
    chars = 0

    def rows() -> Iterator[pa.RecordBatch]:
        nonlocal made
        key, line, own = _keys(list(held.items()), max_edits, min_chars, long_from)
        order = np.argsort(key, kind="stable")
        key, line, own = key[order], line[order], own[order]
        shard, low = _placed(key, shards)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        run = np.diff(np.append(first, len(key)))
        often = np.repeat(run >= FREQUENT, run)
        full = (shard << 32) | low
        out = []
        for at in range(0, int(often.sum()), 100_000):
            made += 1
            pick = np.flatnonzero(often)[at:at + 100_000]
            out.append(((task + made) % shards, full[pick], line[pick], own[pick], True))
        # of a frequent key the shard learns two lines of each side, which is all it asks
        nth = np.arange(len(key)) - np.repeat(first, run)
        nth_own = np.cumsum(own) - np.repeat((np.cumsum(own) - own)[first], run)
        nth_probe = nth + 1 - nth_own
        told = ~often | np.where(own, nth_own <= 2, nth_probe <= 2)
        shard, low, line, own = shard[told], low[told], line[told], own[told]
        edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        out += [(int(shard[a]), low[a:b], line[a:b], own[a:b], False) for a, b in zip(edges, edges[1:]) if a < b]
        for at in range(0, len(out), 64):
            part = out[at:at + 64]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), *(pa.array([r[k].tobytes() for r in part], pa.binary())
                                              for k in (1, 2, 3)), pa.array([r[4] for r in part])], schema=_SENT)

    for batch in batches:
        for line, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if line in held:
                continue
            held[line] = text
            chars += len(text)
            if len(held) >= BLOCK_LINES or chars >= BLOCK_CHARS:
                yield from rows()
                held, chars = {}, 0
    if held:
        yield from rows()


def _shared(group: pa.Table) -> pa.Table:
    """Rows of the keys that an index line and another probe line share."""
    keys, lines, sides, out = [], [], [], []
    for shard, k, ln, s, known in zip(*(c.to_pylist() for c in group.columns)):
        line, own = np.frombuffer(ln, np.int64), np.frombuffer(s, bool)
        if known:
            out.append((np.frombuffer(k, np.int64), line, own))
        else:
            keys.append((shard << 32) | np.frombuffer(k, np.uint32).astype(np.int64))
            lines.append(line)
            sides.append(own)
    if keys:
        key, line, own = np.concatenate(keys), np.concatenate(lines), np.concatenate(sides)
        order = np.argsort(key, kind="stable")
        key, line, own = key[order], line[order], own[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        differ = np.minimum.reduceat(line, first) < np.maximum.reduceat(line, first)
        sided = np.logical_or.reduceat(own, first) & ~np.logical_and.reduceat(own, first)
        keep = np.repeat(differ & sided, np.diff(np.append(first, len(key))))
        out.append((key[keep], line[keep], own[keep]))
    return pa.table([pa.array(np.concatenate(x)) for x in zip(*out)], names=["key", "line", "own"])


# ---- pairs ---------------------------------------------------------------------


def _first_key(a: Sequence, b: Sequence, words: bool, max_edits: int) -> int:
    """Key of the first segment of ``a`` that stands in ``b`` where it may, 0 if none does: what
    ``_keys`` gives both lines, by its definition."""
    edits = word_edits(len(a)) if words else max_edits
    for i, (start, n) in enumerate(segments(len(a), edits)):
        piece = a[start:start + n]
        for at in probe_starts(len(b), len(a), i, start, n, edits):
            if b[at:at + n] == piece:
                return _word_slice(_word_hashes(piece)[0], i, edits) if words else _char_slice(piece, i)
    return 0


_BINS = 32


class _Texts:
    """Units, lengths, sketches and keys of the lines of a group, by their number in it."""

    def __init__(self, texts: list[str], max_edits: int, long_from: int, shards: int):
        self.text = texts
        self.chars = np.array([len(t) for t in texts], np.int64)
        self._units: dict[tuple[int, bool], Sequence] = {}
        self._char_sketch = np.full((len(texts), _BINS), -1, np.int32)
        # how many words fall into each of some bins: an edit changes two of them at most
        self.count = np.zeros(len(texts), np.int64)
        self._word_sketch = np.zeros((len(texts), _BINS), np.int32)
        for a, b in _spans(self.chars.tolist()):
            hashes, self.count[a:b] = _word_hashes([t.encode("utf-8", "surrogatepass") for t in texts[a:b]])
            which = np.repeat(np.arange(b - a), self.count[a:b]) * _BINS + (hashes % np.uint64(_BINS)).astype(np.int64)
            self._word_sketch[a:b] = np.bincount(which, minlength=(b - a) * _BINS).reshape(-1, _BINS)
        self.words = (self.chars >= long_from) & (self.count >= MIN_WORDS)
        self.edits = np.array([word_edits(n) if w else max_edits for n, w in zip(self.count.tolist(), self.words.tolist())], np.int64)
        key, line, own = _keys(list(enumerate(texts)), max_edits, 0, long_from)
        shard, low = _placed(key, shards)
        key = shard << 32 | low
        self.own: list[list[int]] = [[] for _ in texts]
        for n, k in zip(line[own].tolist(), key[own].tolist()):
            self.own[n].append(k)
        self.probes: list[set[int]] = [set() for _ in texts]
        met = ~own & np.isin(key, key[own])
        for n, k in zip(line[met].tolist(), key[met].tolist()):
            self.probes[n].add(k)

    def units(self, n: int, words: bool) -> Sequence:
        if (n, words) not in self._units:
            self._units[n, words] = _units(self.text[n], words)
        return self._units[n, words]

    def sketch(self, nodes: np.ndarray, words: bool) -> np.ndarray:
        if words:
            return self._word_sketch[nodes]
        for n in np.unique(nodes[self._char_sketch[nodes, 0] < 0]).tolist():
            codes = np.frombuffer(self.text[n].encode("utf-32-le", "surrogatepass"), np.uint32)
            self._char_sketch[n] = np.bincount(codes % _BINS, minlength=_BINS)
        return self._char_sketch[nodes]


def _near(x: np.ndarray, y: np.ndarray, held: _Texts) -> Iterator[tuple[np.ndarray, bool]]:
    """Places of the pairs of an index line and a probe line that agree in length and sketch,
    and whether they are compared by words."""
    for w in (True, False):
        size = held.count if w else held.chars
        at = np.flatnonzero((held.words[x] & held.words[y]) if w else ~held.words[x])
        longer = size[y[at]] - size[x[at]]
        at = at[(longer >= 0) & (longer <= held.edits[x[at]])]
        apart = np.abs(held.sketch(x[at], w) - held.sketch(y[at], w)).sum(axis=1)
        yield at[apart <= 2 * held.edits[x[at]]], w


def _first_links(key: np.ndarray, node: np.ndarray, index: np.ndarray, probe: np.ndarray, held: _Texts) -> Iterator[tuple[int, int]]:
    """Linked pairs of an index and a probe row of one key that is the first they share; rows
    are in the order of their keys."""
    mine, theirs = np.flatnonzero(index), np.flatnonzero(probe)
    start = np.searchsorted(key[theirs], key[mine])
    each = np.searchsorted(key[theirs], key[mine], "right") - start
    upto = np.cumsum(each)
    a = 0
    while a < len(mine):
        b = max(int(np.searchsorted(upto, upto[a] - each[a] + PAIRS, "right")), a + 1)
        n = each[a:b]
        left = np.repeat(mine[a:b], n)
        right = theirs[np.arange(len(left)) + np.repeat(start[a:b] - (np.cumsum(n) - n), n)]
        for at, w in _near(node[left], node[right], held):
            for k, x, y in zip(key[left[at]].tolist(), node[left[at]].tolist(), node[right[at]].tolist()):
                # a pair is verified where it meets first, and nowhere else
                own, probes = held.own[x], held.probes[y]
                if next((o for o in own if o in probes), None) != k:
                    continue
                # of two lines of one length the smaller is the indexed one; a longer line of
                # words meets a line of characters only by the latter's rule
                s, t = held.units(x, w), held.units(y, w)
                if len(s) == len(t) and held.text[x] >= held.text[y] and w == held.words[y]:
                    continue
                if within(s, t, int(held.edits[x])):
                    yield x, y
        a = b


def _block_links(max_edits: int, long_from: int, shards: int):
    """Links and merges of the keys of a group: some keys of few rows, or two blocks of one."""
    def run(group: pa.Table) -> pa.Table:
        named = group["node"].combine_chunks().dictionary_encode()
        names, node = named.dictionary.to_pylist(), named.indices.to_numpy()
        held = _Texts(group["text"].take(np.unique(node, return_index=True)[1]).to_pylist(), max_edits, long_from, shards)
        key, own, part = (group[c].to_numpy() for c in ("key", "own", "part"))
        index = own & (part == group["pa"][0].as_py())
        probe = ~own & (part == group["pb"][0].as_py())
        order = np.lexsort((node, own, key))
        key, node, index, probe = key[order], node[order], index[order], probe[order]
        count = [0] * len(names)
        up = list(range(len(names)))
        out = []

        def root(x):
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for x, y in _first_links(key, node, index, probe, held):
            count[x] += 1
            count[y] += 1
            p, q = sorted((root(x), root(y)))
            if p != q:
                up[q] = p
                out.append((names[q], names[p], 0))
        out += [(names[x], None, n) for x, n in enumerate(count) if n]
        return pa.table({"a": pa.array([r[0] for r in out], pa.string()), "b": pa.array([r[1] for r in out], pa.string()),
                         "n": pa.array([r[2] for r in out], pa.int64())})

    return run


def _lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line that is not blank: id, row (tells rows of one id apart; holds once written), no, text."""
    src = df.select(col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), text_or_empty(text_col).alias("t"))
    d = src.select("id", "row", F.posexplode(F.split("t", "\n")).alias("no", "text"))
    # btrim looks at every character, and few lines need it
    spaced = reduce(or_, (f(F.col("text"), F.lit(c)) for f in (F.startswith, F.endswith) for c in _SPACES))
    return d.withColumn("text", F.when(spaced, F.btrim("text", F.lit(_SPACES))).otherwise(F.col("text"))).filter("text <> ''")


def line_links(lines: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, block: int = BLOCK,
               long_from: int = LONG_FROM, size: int | None = None) -> DataFrame:
    """``(a, b, n)`` for the distinct texts of ``lines(text)``, named by their MD5:
    merges (b not null) and numbers of links (b null; to be summed per a).  ``size``: bytes
    of all lines, if known."""
    long_enough = lines.filter(F.char_length("text") >= min_chars).select(F.xxhash64("text").alias("line"), "text")
    if size is None:
        size = long_enough.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + size // SHARD_BYTES
    sent = long_enough.mapInArrow(lambda b: _to_shards(b, shards, max_edits, min_chars, long_from),
                                  "shard int, keys binary, lines binary, sides binary, known boolean")
    shared = staged(sent.groupBy("shard").applyInArrow(_shared, "key long, line long, own boolean"), "line-keys")
    # hashed, so that texts that are not needed are not sorted
    found = (long_enough.join(shared.select("line").distinct().hint("shuffle_hash"), "line", "left_semi")
             .select("line", F.md5("text").alias("node"), "text").dropDuplicates(["line", "node"]))
    found = staged(found, "line-texts")
    rows = shared.distinct().join(found.select("line", "node"), "line")
    sizes = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("any_own"), F.min("own").alias("all_own"),
                                     F.min("line").alias("lo"), F.max("line").alias("hi"))
             .filter("lo < hi and any_own and not all_own")
             .select("key", F.ceil(F.col("n") / block).cast("int").alias("parts"), "lo"))
    rows = rows.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("node", "key"), F.col("parts")).cast("int"))
    # index rows of a part meet the probe rows of every part
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o")
    pairs = rows.select("key", "line", "node", "own", "part", "parts", "lo", other)
    pairs = pairs.select("key", "line", "node", "own", "part", "parts", "lo", F.when(F.col("own"), F.col("part")).otherwise(F.col("o")).alias("pa"),
                         F.when(F.col("own"), F.col("o")).otherwise(F.col("part")).alias("pb"))
    pairs = pairs.join(found, ["line", "node"])
    # keys of one block share groups of some thousand rows: those of one least line, which
    # has a bounded number of keys, so the keys that two lines share mostly meet
    groups = 1 + shared.count() // GROUP_ROWS
    one = F.col("parts") == 1
    pairs = pairs.select(F.when(one, F.pmod(F.xxhash64("lo"), F.lit(groups))).otherwise(F.col("key")).alias("g"), one.alias("one"),
                         "key", "pa", "pb", "node", "own", "part", "text")
    return staged(pairs.groupBy("one", "g", "pa", "pb").applyInArrow(_block_links(max_edits, long_from, shards), "a string, b string, n long"),
                  "line-links")


def line_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = MAX_EDITS,
                 min_chars: int = MIN_CHARS, block: int = BLOCK, long_from: int = LONG_FROM) -> DataFrame:
    """One row per line that is not blank: id, ``line_no``, ``class_id`` (MD5 of one
    text of the class), ``n_links`` (other texts within the distance) and ``kept``."""
    lines = _lines(df, id_col, text_col)
    size = df.agg(F.sum(F.octet_length(text_or_empty(text_col)))).first()[0] or 0
    links = line_links(lines.select("text"), max_edits, min_chars, block, long_from, size)
    roots = components(links.filter("b is not null").select("a", "b")).select(F.col("node").alias("r_node"), "root")
    n = links.filter("b is null").groupBy(F.col("a").alias("l_node")).agg(F.sum("n").alias("n_links"))
    known = n.join(roots, n["l_node"] == roots["r_node"], "left").select("l_node", "n_links", "root")
    rows = lines.select("id", "row", "no", F.md5("text").alias("node"))
    rows = rows.join(known, rows["node"] == known["l_node"], "left").select(
        "id", "row", "no", F.coalesce("root", "node").alias("cls"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rows = staged(rows, "line-rows")
    first = rows.groupBy("cls").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "no", "row")).alias("first"))
    out = rows.join(staged(first.select(F.col("cls").alias("c"), "first"), "line-first"), F.col("cls") == F.col("c"))
    kept = (F.col("row") == F.col("first.row")) & (F.col("no") == F.col("first.no"))
    return out.select(F.col("id").alias(id_col), F.col("no").alias("line_no"), F.col("cls").alias("class_id"), "n_links",
                      kept.alias("kept"))


def line_membership(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = MAX_EDITS,
                    min_chars: int = MIN_CHARS, block: int = BLOCK, long_from: int = LONG_FROM) -> DataFrame:
    """``line_classes`` and one row for each row of ``df`` that has no line, with nulls
    after its id: every row of ``df`` is there, also those of a repeated or null id."""
    c = line_classes(df, id_col, text_col, max_edits, min_chars, block, long_from)
    blank = F.btrim(text_or_empty(text_col), F.lit(_SPACES)) == ""
    return c.unionByName(df.filter(blank).select(col(id_col).alias(id_col)), allowMissingColumns=True)


def line_dedup_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = MAX_EDITS,
                      min_chars: int = MIN_CHARS, block: int = BLOCK, long_from: int = LONG_FROM) -> DataFrame:
    """One row per document id that has lines: ``n_lines``, ``n_removed``, ``n_links``
    (summed over its lines) and ``removed_lines`` (their numbers, in order)."""
    c = line_classes(df, id_col, text_col, max_edits, min_chars, block, long_from)
    return c.groupBy(col(id_col)).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(~F.col("kept")).alias("n_removed"), F.sum("n_links").alias("n_links"),
        F.array_sort(F.collect_list(F.when(~F.col("kept"), F.col("line_no")))).alias("removed_lines"))


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = MAX_EDITS,
                        min_chars: int = MIN_CHARS, block: int = BLOCK, long_from: int = LONG_FROM) -> DataFrame:
    """``df`` with the lines that are not kept taken out of its texts; ids must
    be unique for the texts to be told apart."""
    cut = (line_classes(df, id_col, text_col, max_edits, min_chars, block, long_from)
           .groupBy(col(id_col).alias("__cut"), "line_no").agg(F.max("kept").alias("any")).filter("not any")
           .groupBy("__cut").agg(F.collect_set("line_no").alias("__no")))
    d = df.withColumn("__key", col(id_col)).join(cut, F.col("__key").eqNullSafe(F.col("__cut")), "left")
    t = F.array_join(F.filter(F.split(text_or_empty(text_col), "\n"),
                              lambda x, i: ~F.coalesce(F.array_contains("__no", i), F.lit(False))), "\n")
    d = d.withColumn(text_col, F.when(col(text_col).isNull(), F.lit(None)).otherwise(t))
    return d.select(*[col(c) for c in df.columns])
