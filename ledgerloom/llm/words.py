"""Words and word hashes of whole Arrow text columns, computed on their byte buffers with numpy.

A word is ``[^\\x20\\x09-\\x0D]+``. Hashes are 64-bit; A-Z are lower-cased first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: White space and ASCII punctuation, for words without the marks around them.
MARKS = SPACE.copy()
MARKS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWER = 0xD6E8FEB86659FD93
_INVERSE = pow(_POWER, -1, 2**64)
_STEP = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x += _ODD
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values() -> np.ndarray:
    low = np.arange(256, dtype=np.uint64)
    low[65:91] += np.uint64(32)
    values = mix(low)
    values[SPACE] = 0
    return values


_VALUES = _byte_values()
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(_STEP, n)
        up = np.full(size, _POWER, np.uint64)
        down = np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _POWERS[0], _POWERS[1]


class Rows:
    """A flat array that grows by doubling."""

    def __init__(self, dtype):
        self.data, self.n = np.zeros(1 << 12, dtype), 0

    def add(self, values) -> None:
        to = self.n + len(values)
        if to > len(self.data):
            wide = np.empty(max(to, len(self.data) * 3 // 2), self.data.dtype)
            wide[: self.n] = self.data[: self.n]
            self.data = wide
        self.data[self.n : to] = values
        self.n = to

    def all(self) -> np.ndarray:
        return self.data[: self.n]


def free_name(columns, wish: str) -> str:
    """``wish``, with underscores after it until no column has that name in any case."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 offsets of its rows; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if buffers[2] is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spans(data: np.ndarray, cuts: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; no word crosses one of ``cuts``. ``gaps``: by byte, what parts words."""
    word = ~gaps[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _segments(data: np.ndarray, offsets: np.ndarray):
    """Ranges of about ``_STEP`` bytes that end where a row or a word does."""
    at, n = 0, len(data)
    while at < n:
        to = min(at + _STEP, n)
        if to < n:
            row = offsets[np.searchsorted(offsets, to, "right") - 1]
            gaps = np.flatnonzero(SPACE[data[max(at, to - 4096) : to]])
            if row > at:
                to = int(row)
            elif len(gaps):
                to = max(at, to - 4096) + int(gaps[-1]) + 1
            else:  # a word longer than that: up to its end
                end = int(offsets[np.searchsorted(offsets, to, "left")])
                gaps = np.flatnonzero(SPACE[data[to:end]])
                to = to + int(gaps[0]) if len(gaps) else end
        yield at, to
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, tails: bool = False, gaps: np.ndarray = SPACE):
    """Hash and row of every word, in order; with ``tails``, also its last two bytes as one number."""
    values = _VALUES if gaps is SPACE else np.where(gaps, np.uint64(0), _VALUES)
    hashes, rows, ends_of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in _segments(data, offsets):
        part = data[lo:hi]
        start, end = spans(part, offsets - lo, gaps)
        if not len(start):
            continue
        up, down = _powers(len(part))
        x = values[part]
        x *= up[: len(part)]
        h = np.add.reduceat(x, start)
        h *= down[start]
        h ^= (end - start).astype(np.uint64)
        hashes.append(mix(h))
        rows.append(np.searchsorted(offsets, start + lo, "right") - 1)
        if tails:
            low = np.where((part >= 65) & (part < 91), part + 32, part).astype(np.int64)
            ends_of.append(low[end - 1] + 256 * np.where(end - start > 1, low[np.maximum(end - 2, 0)], 0))
    got = np.concatenate(hashes), np.concatenate(rows)
    return (*got, np.concatenate(ends_of)) if tails else got


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingles of every row; a row of fewer words has its whole sequence as one."""
    if not len(hashes):
        return [np.zeros(0, np.uint64)] * n_rows
    at = np.searchsorted(rows, np.arange(n_rows + 1))
    grams = hashes.copy()
    for k in range(1, width):
        grams[:-k] = grams[:-k] * _ODD + hashes[k:]
    grams = mix(grams)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(grams[a : b - width + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mix(whole * _ODD + hashes[k : k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
