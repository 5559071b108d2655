"""Bloom filters of bounded size with two bits a cell: never, once, twice or more."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm import blocks
from ledgerloom.llm.words import mix

N_HASHES = 2
_BLOCKS = 64


def cells_for(n_keys: int, max_bytes: int, cells_per_key: int = 12) -> int:
    """Number of cells, a power of two; four of them take a byte."""
    want = max(1 << 16, n_keys * cells_per_key)
    return min(1 << (want - 1).bit_length(), 1 << ((max_bytes * 4).bit_length() - 1))


def _cells(keys: np.ndarray, n_cells: int) -> list[np.ndarray]:
    one = mix(keys)
    two = mix(one)
    return [(h & np.uint64(n_cells - 1)).astype(np.int64) for h in (one, two)][:N_HASHES]


def _join(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Halves of a block: cells met, cells met twice."""
    x, y = x.reshape(2, -1), y.reshape(2, -1)
    return np.stack([x[0] | y[0], x[1] | y[1] | (x[0] & y[0])]).reshape(-1)


def build(keys: DataFrame, n_keys: int, max_bytes: int) -> np.ndarray:
    """First pass. ``keys`` has one long column; the filter has at most ``max_bytes`` bytes.

    Each partition counts its cells, saturating at two; merging adds the counts. Beyond the cap the
    filter only lets more keys through as possibly repeated; it never misses a repeated one.
    """
    n_cells, name = cells_for(n_keys, max_bytes), keys.columns[0]

    def fill(batches):
        count = np.zeros(n_cells, np.uint8)
        for b in batches:
            own = np.frombuffer(b.column(name).cast(pa.int64()).to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
            for k in range(0, len(own), 1 << 16):
                for cells in _cells(own[k : k + (1 << 16)], n_cells):
                    found, times = np.unique(cells, return_counts=True)
                    count[found] = np.minimum(count[found] + times, 2)
        met, twice = np.packbits(count > 0), np.packbits(count > 1)
        yield blocks.batch(np.stack([met.reshape(_BLOCKS, -1), twice.reshape(_BLOCKS, -1)], 1), _BLOCKS)

    parts = keys.mapInArrow(fill, blocks.SCHEMA)
    whole = blocks.merged(parts, _BLOCKS, n_cells // _BLOCKS // 4, "uint8", _join, keys.rdd.getNumPartitions())
    return whole.reshape(_BLOCKS, 2, -1)


def repeated(keys: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Second pass: True where a key may have been met twice; never False where it was."""
    return _test(keys, np.ascontiguousarray(filled[:, 1]).reshape(-1))


def member(keys: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """True where a key may have been met at all."""
    return _test(keys, np.ascontiguousarray(filled[:, 0]).reshape(-1))


def _test(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for cells in _cells(keys.view(np.uint64), len(bits) * 8):
        out &= (bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
    return out
