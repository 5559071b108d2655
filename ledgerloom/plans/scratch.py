"""Tables written to the folder that the cluster shares, to cut lineage.

A written table survives the loss of an executor; a locally checkpointed one does not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only where that is unset (tests), one of our own."""
    sc = spark.sparkContext
    set_dir = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not set_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        set_dir = tempfile.mkdtemp(prefix="ledgerloom-")
        sc.setCheckpointDir(set_dir)
    return set_dir.rstrip("/")


_MADE: list[str] = []


def sweep(spark: SparkSession) -> int:
    """Deletes the tables that ``settle`` has written so far in this process; call it once results are written or collected."""
    jvm, gone = spark.sparkContext._jvm, 0
    while _MADE:
        path = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        gone += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return gone


def settle(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses neither recompute nor recurse."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ledgerloom/{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    _MADE.append(path)
    return spark.read.schema(df.schema).parquet(path)
