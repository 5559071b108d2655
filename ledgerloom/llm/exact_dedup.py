"""Exact deduplication: a two-pass Bloom filter finds the rows that may be repeated; only those shuffle.

Pass 1 puts a 64-bit hash of every text into a counting Bloom filter of bounded size. Pass 2 probes it:
a text whose cells were met once is alone and passes straight through; the others are grouped by
SHA-256, which decides exactly. A false hit costs one row's shuffle, never a wrong result.

The filter has two hashed cells a text and at most ``MAX_FILTER_BYTES`` bytes, four cells a byte; of n distinct texts that occur once, a
share of about ``(1 - exp(-2 n / cells)) ** 2`` shuffles with the repeated ones.

Defined cases: a null text counts as empty and equals the empty text; of equal texts the row of the
largest ``doc_id`` stays (a null id is the smallest); of rows equal in text and id exactly one stays, that of the greatest
hash over all columns as JSON. An empty table gives an empty result. Very long texts are hashed whole. Columns beyond the id
and the text pass through, whatever their names and types.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import bloom
from ledgerloom.llm.words import free_name
from ledgerloom.plans.scratch import settle

MAX_FILTER_BYTES = 32 << 20


def _text(text: str):
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def _filter(docs: DataFrame, text: str, max_bytes: int):
    spark = docs.sparkSession
    keys = docs.select(F.xxhash64(_text(text)).alias("key"))
    filled = bloom.build(keys, docs.count(), max_bytes)
    return spark.sparkContext.broadcast(filled)


def _flag(df: DataFrame, filled, key_col: str = "_dd_key", out: str = "_dd_again") -> DataFrame:
    """Adds the column ``out`` by probing ``key_col``; nothing but the key goes through Python."""
    from pyspark.sql.pandas.functions import arrow_udf

    @arrow_udf("boolean")
    def again(key: pa.Array) -> pa.Array:
        return pa.array(bloom.repeated(np.asarray(key.to_numpy(zero_copy_only=False)), filled.value))

    return df.withColumn(out, again(key_col))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    filled = _filter(docs, text_col, max_filter_bytes)
    rows = docs.select(F.col(id_col).alias("_dd_id"), F.sha2(_text(text_col), 256).alias("_dd_sha"), F.xxhash64(_text(text_col)).alias("_dd_key"))
    rows = settle(_flag(rows, filled).select("_dd_id", "_dd_sha", "_dd_again"))
    filled.unpersist()
    alone = rows.where(~F.col("_dd_again")).select(F.col("_dd_id").alias(id_col), F.col("_dd_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("_dd_sha").alias("text_sha256"))
    again = rows.where("_dd_again").groupBy("_dd_sha", "_dd_id").agg(F.count(F.lit(1)).alias("_dd_n"))
    groups = settle(again.groupBy("_dd_sha").agg(F.max("_dd_id").alias("keep_id"), F.sum("_dd_n").alias("group_size")))
    members = again.join(groups, "_dd_sha").withColumn("_dd_copy", F.explode(F.sequence(F.lit(1), F.col("_dd_n"))))
    kept = F.col("_dd_id").eqNullSafe(F.col("keep_id")) & (F.col("_dd_copy") == 1)
    return alone.unionByName(members.select(F.col("_dd_id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.col("_dd_sha").alias("text_sha256")))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """The rows that stay, with all their columns. A row alone with its text never shuffles.

    The others meet in an aggregate by SHA-256 whose map-side half already keeps one row a text.
    """
    filled = _filter(docs, text_col, max_filter_bytes)
    key, flag, sha, row = (free_name(docs.columns, c) for c in ("_dd_key", "_dd_again", "_dd_sha", "_dd_row"))
    rows = _flag(docs.withColumn(key, F.xxhash64(_text(text_col))), filled, key, flag)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rank = F.struct(F.col(f"`{id_col}`"), F.xxhash64(F.to_json(whole)))
    best = rows.where(flag).groupBy(F.sha2(_text(text_col), 256).alias(sha)).agg(F.max_by(whole, rank).alias(row))
    return rows.where(~F.col(flag)).select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(best.select(f"{row}.*"))
