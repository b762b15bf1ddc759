"""Whole-column text helpers: words of many texts at once, as flat numpy arrays.

A batch of texts becomes one byte buffer (Arrow's own layout). Words are byte
ranges of it, and every word has a 64-bit polynomial hash, so the operators
never loop over words in Python. Each text is taken whole; a null text has no
words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a task (one longer text is still whole).
CHUNK_BYTES = 1 << 19

_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_U = np.uint64


def _powers(n: int, base: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    filled, step = 1, base & (2**64 - 1)
    while filled < n:
        more = min(filled, n - filled)
        out[filled:filled + more] = out[:more] * _U(step)
        filled += more
        step = step * step & (2**64 - 1)
    return out


class _Powers:
    """Growing tables of the powers of an odd number and of its inverse."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = n + n // 8
            self.up, self.down = _powers(size, self.base), _powers(size, self.inverse)
        return self.up[:n], self.down[:n]


_BYTE_POWERS = _Powers(0xD6E8FEB86659FD93)
_WORD_POWERS = _Powers(0xA0761D6478BD642F)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; equal input gives equal output on every machine."""
    x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def folded_table() -> np.ndarray:
    """Byte table for words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z
    became a-z: 0 separates, other bytes stand for themselves."""
    table = np.zeros(256, dtype=np.uint8)
    for lo, hi in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[lo:hi + 1] = np.arange(lo, hi + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


def plain_table() -> np.ndarray:
    """Byte table for words ``[^\\x20\\x09-\\x0D]+``, unchanged."""
    table = np.arange(256, dtype=np.int16)
    table[0] = 256  # a NUL byte is a word byte here
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


FOLDED, PLAIN = folded_table(), plain_table()


class Words:
    """Words of a run of texts: ``start``/``end`` byte ranges, ``hash``, and
    ``first[i]:first[i + 1]`` for the words of text i."""

    __slots__ = ("raw", "start", "end", "hash", "first", "sums")

    def __init__(self, raw, start, end, hashed, first, sums=None):
        self.raw, self.start, self.end, self.hash, self.first, self.sums = raw, start, end, hashed, first, sums

    def part(self, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
        """Hashes of other byte ranges (prefixes, suffixes) of the same buffer."""
        _, down = _BYTE_POWERS.get(len(self.raw) + 1)
        return mix((self.sums[end] - self.sums[start]) * down[start] + (end - start).astype(np.uint64) * _MULT, seed)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array (no copy)."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    if column.null_count:  # a null's range may hold anything
        column = column.fill_null("")
        return _buffer(column)
    return raw, at


def words(column: pa.Array, table: np.ndarray = FOLDED, hashes: bool = True) -> Words:
    """All words of all texts of ``column``."""
    raw, at = _buffer(column)
    raw = raw[at[0]:at[-1]]
    at = at - at[0]
    mapped = table[raw]
    inside = mapped != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < at[1:]]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = edges[1:] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at)
    hashed, total = np.empty(0, np.uint64), None
    if hashes:
        up, down = _BYTE_POWERS.get(len(raw) + 1)
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((mapped.astype(np.uint64) + _U(1)) * up[:-1], out=total[1:])
        hashed = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _MULT)
    return Words(raw, start, end, hashed, first, total)


def windows(hashed: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A hash of every run of n consecutive words (of the flat array: windows
    that cross a text boundary are for the caller to leave out)."""
    if len(hashed) < n:
        return np.empty(0, np.uint64)
    up, down = _WORD_POWERS.get(len(hashed) + 1)
    total = np.zeros(len(hashed) + 1, dtype=np.uint64)
    np.cumsum(mix(hashed, seed) * up[:-1], out=total[1:])
    return mix((total[n:] - total[:-n]) * down[:len(hashed) - n + 1], seed + 1)


def window_mask(first: np.ndarray, n: int) -> np.ndarray:
    """Which flat positions start a window of n words within one text."""
    total = int(first[-1])
    ok = np.ones(max(total - n + 1, 0), dtype=bool)
    for k in range(1, n):  # a boundary k words ahead cuts the window
        at = first[1:-1] - k
        at = at[(at >= 0) & (at < len(ok))]
        ok[at] = False
    return ok


def chunks(batch: pa.RecordBatch | pa.Table, text: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, rows whole."""
    column = batch.column(batch.schema.get_field_index(text))
    if not len(column):
        return
    _, at = _buffer(column)
    total = at - at[0]
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(total, total[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield batch.slice(lo, hi - lo)
        lo = hi


class HashIndex:
    """Open-addressing table from 64-bit hashes to small numbers, probed for
    whole arrays at once. Holds at most ``limit`` keys; the owner starts a new
    one when it is full, so a task's memory is bounded."""

    def __init__(self, bits: int = 12, limit_bits: int = 21):
        self.limit = 1 << limit_bits
        self._make(bits)

    def _make(self, bits: int) -> None:
        self.bits, self.size = bits, 0
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.values = np.full(1 << bits, -1, dtype=np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _MULT >> _U(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it is unknown."""
        out = np.full(len(keys), -1, dtype=np.int32)
        left, slot, mask = np.arange(len(keys)), self._slots(keys), (1 << self.bits) - 1
        while len(left):
            value = self.values[slot]
            hit = (value >= 0) & (self.keys[slot] == keys[left])
            out[left[hit]] = value[hit]
            go = ~hit & (value >= 0)
            left, slot = left[go], (slot[go] + 1) & mask
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not in the table yet."""
        while (self.size + len(keys)) * 2 > len(self.keys):
            old = self.values >= 0
            had, was = self.keys[old], self.values[old]
            self._make(self.bits + 1)
            self._put(had, was)
        self._put(keys, values)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        left, slot, mask = np.arange(len(keys)), self._slots(keys), (1 << self.bits) - 1
        while len(left):
            free = self.values[slot] < 0
            at, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[at], self.values[at] = keys[left[won]], values[left[won]]
            rest = np.ones(len(left), dtype=bool)
            rest[won] = False
            left, slot = left[rest], (slot[rest] + 1) & mask
        self.size += len(keys)

    def full(self, more: int) -> bool:
        return self.size + more > self.limit


def expand(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices of all ranges ``starts[i] : starts[i] + lengths[i]``, in order."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
