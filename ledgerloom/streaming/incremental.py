"""New source files as a stream, merged into a registry batch by batch, or resolved against what is stored first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.incremental import Resolution
from ledgerloom.plans.scratch import settle
from ledgerloom.sources.registry import Registry


def newest_by_key(batch: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row per key, as merging the rows one after another would leave it: of each column the last value that is not null.

    Rows follow each other by ``order``; equal ones by their content, so the result does not depend on partitions.
    """
    names = [c for c in batch.columns if c not in (key, order)]
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns]))
    rank = F.struct(*([F.col(f"`{order}`")] if order else []), text)
    last = lambda c: F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), rank)).alias(c)
    found = batch.groupBy(F.col(f"`{key}`").alias(key)).agg(*[last(c) for c in names], *([F.max(f"`{order}`").alias(order)] if order and order != key else []))
    return found.select(*[F.col(f"`{c}`") for c in batch.columns])


def upsert_stream(spark: SparkSession, path: str, schema: T.StructType, registry: Registry, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, order: str | None = None, files_per_batch: int = 1000, format: str = "parquet") -> None:
    """Merge all files that are there and not yet merged, then stop.

    Rows of one key follow each other by ``order``, by default by their files' times, so a later load wins and its
    nulls keep what earlier ones said. A batch that runs again after a failure merges the same rows, which changes nothing.
    """
    mark = order or "_file_time"

    def apply(batch: DataFrame, _: int) -> None:
        rows = transform(batch) if transform else batch
        if mark not in rows.columns:  # a transformation that leaves the files' times out
            rows = rows.withColumn(mark, F.lit(None).cast("timestamp"))
        if not rows.isEmpty():
            newest = newest_by_key(rows, registry.key, mark)
            registry.upsert(newest if order else newest.drop(mark))

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(format).load(path)
    stream = stream if order else stream.select("*", F.col("_metadata.file_modification_time").alias(mark))
    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def resolve_stream(spark: SparkSession, paths: tuple[str, str], schemas: tuple[T.StructType, T.StructType], resolution: Resolution, checkpoint: str, keys: tuple[str, str], registry: Registry | None = None, files_per_batch: int = 1000, format: str = "parquet") -> None:
    """Resolve all files of both sources that are there and not yet resolved, then stop; entities that changed go to the registry.

    A micro-batch is a load: its new files of either source are matched with each other and with all that is stored.
    ``keys`` name a row of a source; of rows of one key in one batch the last stays (by their files' times), in a
    later batch the newer row replaces the stored one. A batch that runs again writes the same load again.
    """

    def source(k: int) -> DataFrame:
        rows = spark.readStream.schema(schemas[k]).option("maxFilesPerTrigger", files_per_batch).format(format).load(paths[k])
        return rows.select(F.lit(k).alias("_side"), F.col("_metadata.file_modification_time").alias("_file_time"), F.struct(*[F.col(f"`{c}`") for c in schemas[k].names]).alias(f"_row{k}"))

    def apply(batch: DataFrame, number: int) -> None:
        batch = settle(batch)

        def own(k: int) -> DataFrame:
            rows = batch.where(F.col("_side") == k).select(f"_row{k}", "_file_time")
            last = rows.groupBy(F.col(f"_row{k}")[keys[k]].alias("_key")).agg(F.max_by(f"_row{k}", F.struct("_file_time", F.to_json(f"_row{k}"))).alias("_last"))
            return last.select("_last.*")

        delta = resolution.load(number, own(0), own(1), (F.col(keys[0]), F.col(keys[1])))
        if registry is not None:
            registry.replace(delta.entities, delta.retired)

    both = source(0).unionByName(source(1), allowMissingColumns=True)
    both.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
