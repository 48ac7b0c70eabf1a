"""Words, their hashes and n-grams of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A batch is worked on in slices of whole texts, so memory follows the slice (or the longest single text), not the batch.
Hashes have 64 bits and depend on the bytes alone, so every executor and every run gets the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_bytes = np.arange(256)
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, a-z and everything beyond ASCII; upper case counts once it is folded
LETTERS = ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x41) & (_bytes <= 0x5A)) | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)
# [^\x20\x09-\x0D]
VISIBLE = ~((_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D)))
FOLD = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes).astype(np.uint8)
SAME = _bytes.astype(np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _UNBASE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table)
    return _powers[0][:n], _powers[1][:n]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end]; equal bytes have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[:-1], out=total[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((total[ends] - total[starts]) * down[starts] + lengths * np.uint64(0xA24BAED4963EE407))


@dataclass
class Words:
    """Words of the texts first .. first + n - 1 of a batch; word i of all is data[start[i]:end[i]]."""

    first: int
    data: np.ndarray  # folded bytes of the texts, one after the other
    bounds: np.ndarray  # of texts in data
    start: np.ndarray
    end: np.ndarray
    offsets: np.ndarray  # of texts among the words

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self) -> np.ndarray:
        return hashes(self.data, self.start, self.end)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and text bounds of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    bounds = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, bounds


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of set positions; no run crosses a bound."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = bounds[(bounds > 0) & (bounds < n)]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[inner] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[inner - 1] = False
    return start, np.flatnonzero(inside & ~after) + 1


def slices(bounds: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together have up to ``size`` bytes, or one text alone."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def words(column: pa.Array, letters: np.ndarray, fold: np.ndarray = SAME, size: int = SLICE_BYTES) -> Iterator[Words]:
    """Words of a string column, slice by slice: maximal runs of ``letters`` bytes, after ``fold``."""
    data, bounds = text_buffers(column)
    for at, to in slices(bounds, size):
        part, own = data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        start, end = runs(letters[part], own)
        yield Words(at, fold[part], own, start, end, np.searchsorted(start, own))


def grams(word_hashes: np.ndarray, offsets: np.ndarray, n: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows and the bounds of texts among them.

    With ``short``, a text of fewer words, but not none, has one window of all its words.
    """
    counts = np.diff(offsets)
    windows = np.maximum(counts - n + 1, 0)
    few = (counts > 0) & (counts < n)
    made = np.where(few & short, 1, windows)
    bounds = np.concatenate([[0], np.cumsum(made)])
    total = len(word_hashes)
    full = np.zeros(max(total - n + 1, 0), np.uint64)
    for k in range(n):
        full = full * np.uint64(0x9FB21C651E98DF25) + word_hashes[k : k + len(full)]
    full = mix(full + np.uint64(n))
    owner = np.repeat(np.arange(len(counts)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    out = np.zeros(bounds[-1], np.uint64)
    out[bounds[owner] + inside] = full[offsets[owner] + inside]
    if short:
        for t in np.flatnonzero(few):
            h = np.zeros(1, np.uint64)
            for x in word_hashes[offsets[t] : offsets[t + 1]]:
                h = h * np.uint64(0x9FB21C651E98DF25) + x
            out[bounds[t]] = mix(h + np.uint64(counts[t]))[0]
    return out, bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, how often each occurs, and the new bounds."""
    values = values.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][bounds[:-1] < len(values)]] = True
    at = np.flatnonzero(new)
    return values[at], np.diff(np.append(at, len(values))), np.searchsorted(at, bounds)


def repeated(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each value stands twice or more in its text."""
    order = np.empty(len(values), np.int64)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        order[a:b] = a + values[a:b].argsort()
    ranked = values[order]
    twin = ranked[1:] == ranked[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(values))]
    twin[inner - 1] = False
    same = np.zeros(len(values), bool)
    same[order[1:]] |= twin
    same[order[:-1]] |= twin
    return same
