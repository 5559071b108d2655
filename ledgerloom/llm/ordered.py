"""Positions of rows within their groups in a global order, with no task that holds a whole group.

Rows are dealt by ranges of (group, order), so a group of any size lies in consecutive partitions. Each
partition counts its own rows by group; a table of at most two rows a partition then says what earlier
partitions hold of its first group, and whether its last group goes on in a later one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.plans.scratch import settle

#: Bits of ``_edge``: the first and the last row of a partition.
HEAD, TAIL = 1, 2


def by_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """Sorted partitions that follow each other by ``keys``; nulls come first."""
    return df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)


def run_starts(columns: list[pa.Array]) -> np.ndarray:
    """Rows that differ from the one before in any column; the first row does."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        out[1:] |= codes[1:] != codes[:-1]
    return out


def positions(starts: np.ndarray, before: int) -> np.ndarray:
    """Of each row its place in its run; the first run has ``before`` earlier rows, if it doesn't start here."""
    at = np.arange(len(starts))
    since = np.maximum.accumulate(np.where(starts, at, -1))
    return np.where(since < 0, at + before, at - since)


class Runs:
    """Numbers the rows of consecutive batches by runs of equal ``columns``."""

    def __init__(self, columns: list[str]):
        self.columns, self.last, self.count = columns, None, 0

    def number(self, batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """(starts, places); ``batch`` is not empty."""
        own = [batch.column(c) for c in self.columns]
        starts = run_starts(own)
        starts[0] = self.last is None or self.last != [c[0].as_py() for c in own]
        places = positions(starts, self.count)
        self.last, self.count = [c[len(c) - 1].as_py() for c in own], int(places[-1]) + 1
        return starts, places


def with_edges(batches, arrays) -> pa.RecordBatch:
    """Adds ``_part`` and ``_edge`` to ``arrays(batch)`` of each batch that isn't empty; the last row of all is the tail."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    waiting, first = None, True

    def marked(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
        nonlocal first
        edge = np.zeros(len(batch), np.int32)
        edge[0] |= HEAD * first
        edge[-1] |= TAIL * last
        first = False
        return batch.append_column("_part", pa.array(np.full(len(batch), part, np.int32))).append_column("_edge", pa.array(edge))

    for batch in batches:
        for made in arrays(batch):
            if len(made):
                if waiting is not None:
                    yield marked(waiting, False)
                waiting = made
    for made in arrays(None):
        if len(made):
            if waiting is not None:
                yield marked(waiting, False)
            waiting = made
    if waiting is not None:
        yield marked(waiting, True)


def numbered(df: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds ``_part``, ``_edge`` and ``_place`` (from 0 in the partition's rows of the group); written to the shared folder."""
    ranged = by_ranges(df, group, *order)
    schema = T.StructType([*df.schema.fields, T.StructField("_place", T.LongType()), T.StructField("_ends", T.BooleanType()), T.StructField("_part", T.IntegerType()), T.StructField("_edge", T.IntegerType())])

    def number(batches):
        runs, held = Runs([group]), []

        def arrays(batch):
            """One batch behind, as the next one's first row says whether a run ends."""
            if batch is not None and not len(batch):
                return
            starts, places = runs.number(batch) if batch is not None else (np.ones(1, bool), None)
            if held:
                before, at, was = held.pop()
                ends = np.append(was[1:], starts[0])
                yield before.append_column("_place", pa.array(at)).append_column("_ends", pa.array(ends))
            if batch is not None:
                held.append((batch, places, starts))

        return with_edges(batches, arrays)

    return settle(ranged.mapInArrow(number, schema))


def carried(edges: DataFrame, group: str, *sums: str) -> DataFrame:
    """One row for the first and the last group of each partition: ``_before`` rows in earlier partitions, ``_more`` in later ones.

    ``edges`` are the rows with ``_edge`` > 0; ``sums`` are further running values of the partition's rows,
    kept as they are at its last row (0 at the first row of a group that ends before).
    """
    tail = F.col("_edge").bitwiseAND(TAIL) > 0
    zero = lambda c: F.when(tail, F.col(c)).otherwise(0).cast("long")
    each = edges.where("_edge > 0").select("_part", group, F.when(tail, F.col("_place") + 1).otherwise(0).alias("_n"), *[zero(c).alias(c) for c in sums])
    each = each.groupBy("_part", group).agg(F.max("_n").alias("_n"), *[F.max_by(c, "_n").alias(c) for c in sums])
    order = W.partitionBy(group).orderBy("_part")
    so_far = order.rowsBetween(W.unboundedPreceding, -1)
    return each.withColumns({"_before": F.coalesce(F.sum("_n").over(so_far), F.lit(0)), "_more": F.lead("_part").over(order).isNotNull()})


def joined(rows: DataFrame, carry: DataFrame, group: str, *columns: str) -> DataFrame:
    """``rows`` with ``columns`` of the carry of their partition and group, null elsewhere."""
    other = carry.select(F.col("_part").alias("_cpart"), F.col(group).alias("_cgroup"), *columns)
    return rows.join(other, (rows["_part"] == other["_cpart"]) & rows[group].eqNullSafe(other["_cgroup"]), "left").drop("_cpart", "_cgroup")
