"""Contiguous shards of nearly equal bytes, by global prefix sums from per-partition totals; DataFrame operations only.

Rows are dealt by ranges of the order and each partition is summed up. A prefix sum over those totals (one row a
partition) says where every partition lies in the whole, and so which shard it lies in. Only partitions that a cut
falls into, at most one fewer than there are shards, need running sums of their own rows; all others take
their shard and their slots from the totals and their row numbers.

A row goes to the shard in which its middle byte falls, so a shard is at most one row away from an equal part.

Defined cases: a null text has no bytes, size 1, and the checksum of the empty text; null ids come first; rows of equal ids follow each other
by a hash of their text, equal rows in any order, so that one id with a third of all rows spreads over partitions; a row
longer than a shard's part leaves shards empty; an empty table gives an empty result. Columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.words import free_name
from ledgerloom.plans.scratch import settle

#: Bits of a row's number in its partition, in what monotonically_increasing_id gives.
_ROW_BITS = 33


def text_size(text: str) -> Column:
    """UTF-8 bytes of the text plus one."""
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1).cast("long")


def assign(rows: DataFrame, size: Column, order: list[Column], n_shards: int = 8, out: tuple[str, str] = ("shard", "slot")) -> DataFrame:
    """All columns of ``rows``, with the shard (int) and the place in it (long, gapless from 0) under the names of ``out``.

    ``size`` is a positive whole number. The rows are written once to the shared folder, in order.
    """
    names, taken = list(rows.columns), list(rows.columns)

    def own(wish: str) -> str:
        taken.append(free_name(taken, wish))
        return taken[-1]

    weight, at, part, row, last, shard, number = (own(c) for c in ("_size", "_at", "_part", "_row", "_nth", "_shard", "_number"))
    keys = [own(f"_key{k}") for k in range(len(order))]
    ready = rows.withColumns({weight: size.cast("long"), **dict(zip(keys, order, strict=True)), last: F.monotonically_increasing_id()})
    dealt = ready.repartitionByRange(*[F.col(k) for k in (*keys, last)]).sortWithinPartitions(*keys, last)
    dealt = settle(dealt.drop(*keys, last).withColumn(at, F.monotonically_increasing_id()))
    dealt = dealt.withColumns({part: F.shiftright(at, _ROW_BITS).cast("int"), row: F.col(at).bitwiseAND((1 << _ROW_BITS) - 1)})

    p, held, bytes_before, rows_before, total, low, high = (own(c) for c in ("_p", "_bytes", "_bytes_before", "_rows_before", "_total", "_low", "_high"))
    # Of a byte, counted in halves from 0, its shard; whole numbers below 2^63 up to 5 * 10^17 bytes and 8 shards.
    shard_of = lambda halves: F.least(F.call_function("div", halves * n_shards, 2 * F.col(total)), F.lit(n_shards - 1)).cast("int")
    earlier, whole = W.orderBy(p).rowsBetween(W.unboundedPreceding, -1), W.partitionBy(F.lit(1))  # over one row a partition
    sums = dealt.groupBy(F.col(part).alias(p)).agg(F.sum(weight).alias(held), F.count(F.lit(1)).alias("_rows"))
    sums = sums.select(p, held, F.coalesce(F.sum(held).over(earlier), F.lit(0)).alias(bytes_before), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(rows_before), F.sum(held).over(whole).alias(total))
    sums = settle(sums.withColumns({low: shard_of(2 * F.col(bytes_before)), high: shard_of(2 * (F.col(bytes_before) + F.col(held)) - 1)}))

    placed = dealt.join(sums, F.col(part) == F.col(p)).withColumn(number, F.col(rows_before) + F.col(row))
    through = F.sum(weight).over(W.partitionBy(part).orderBy(row).rowsBetween(W.unboundedPreceding, 0))
    inside = placed.where(F.col(low) == F.col(high)).withColumn(shard, F.col(low))
    cut = placed.where(F.col(low) < F.col(high)).withColumn(shard, shard_of(2 * (F.col(bytes_before) + through) - F.col(weight)))
    both = inside.unionByName(cut).select(*[F.col(f"`{c}`") for c in names], shard, number)
    firsts = both.groupBy(F.col(shard).alias(p)).agg(F.min(number).alias(held))  # n_shards rows at most
    slotted = both.join(F.broadcast(firsts), F.col(shard) == F.col(p))
    return slotted.select(*[F.col(f"`{c}`") for c in names], F.col(shard).alias(out[0]), (F.col(number) - F.col(held)).alias(out[1]))


def shards(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (free names like these where the columns exist), by the bytes of the text and in the order of the id."""
    names = list(docs.columns)
    shard = free_name(names, "shard")
    return assign(docs, text_size(text_col), [F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`"))], n_shards, (shard, free_name([*names, shard], "slot")))


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The shards as Parquet folders ``shard=k``; each file holds rows of one shard in the order of their slots."""
    placed = shards(docs, n_shards, id_col, text_col)
    shard, slot = placed.columns[-2:]
    placed.repartitionByRange(F.col(shard), F.col(slot)).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
