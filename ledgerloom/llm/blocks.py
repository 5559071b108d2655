"""Arrays of a fixed size that partitions fill and executors merge, block by block.

Filters and sketches here have a size that a parameter bounds, whatever the input. Each partition
hands out its blocks that aren't all zero; two rounds of merging keep one open array a task, and the
driver gets the merged array only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "block int, part int, payload binary"
_ARROW = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("payload", pa.binary())])


def split(array: np.ndarray, n_blocks: int) -> Iterator[tuple[int, bytes]]:
    """The blocks of ``array`` that hold anything."""
    for k, block in enumerate(array.reshape(n_blocks, -1)):
        if block.any():
            yield k, block.tobytes()


def batch(array: np.ndarray, n_blocks: int) -> pa.RecordBatch:
    found = list(split(array, n_blocks))
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    return pa.record_batch([pa.array([k for k, _ in found], pa.int32()), pa.array([part] * len(found), pa.int32()), pa.array([b for _, b in found], pa.binary())], schema=_ARROW)


def merged(parts: DataFrame, n_blocks: int, block_len: int, dtype: str, join: Callable[[np.ndarray, np.ndarray], np.ndarray], n_parts: int) -> np.ndarray:
    """Merge ``SCHEMA`` rows with ``join`` (associative, commutative) and return the whole array."""

    def merge(batches):
        open_blocks: dict[int, np.ndarray] = {}
        for b in batches:
            for k, payload in zip(b.column("block").to_pylist(), b.column("payload"), strict=True):
                block = np.frombuffer(payload.as_buffer(), dtype)
                open_blocks[k] = join(open_blocks[k], block) if k in open_blocks else block.copy()
        part = TaskContext.get().partitionId()
        for k, block in open_blocks.items():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([part], pa.int32()), pa.array([block.tobytes()], pa.binary())], schema=_ARROW)

    salts = max(1, math.isqrt(max(1, n_parts)))
    some = parts.repartition(min(n_blocks * salts, 4096), F.col("block"), F.col("part") % salts).mapInArrow(merge, SCHEMA)
    whole = np.zeros((n_blocks, block_len), dtype)
    for row in some.repartition(n_blocks, "block").mapInArrow(merge, SCHEMA).toLocalIterator():
        whole[row["block"]] = np.frombuffer(row["payload"], dtype)
    return whole.reshape(-1)
