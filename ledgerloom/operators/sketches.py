"""Statistics of columns that loads keep and merge: counts and moments exact, distinct values and quantiles as sketches.

A load is read once, when it comes, and leaves one row a column: its counts, mean and squared deviations, a HyperLogLog sketch of its
values and a KLL sketch of their ranks. The statistics of all loads are a merge of these rows; no earlier load is read again.

Errors: with ``LG_CONFIG`` 12, distinct counts have a standard error of 1.6 %; with the KLL size of 200, ranks are off by 1.3 % at most in 99 of 100 sketches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LG_CONFIG = 12
QUANTILES = (0.25, 0.5, 0.75)


def sketched(df: DataFrame, columns: list[str], load: int) -> DataFrame:
    """(load, column, n, nulls, mean, deviations, low, high, values, ranks): a row a column, from one pass over the load.

    NaN counts as null. ``deviations`` is the sum of squared distances from the mean.
    """
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for k, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        x = F.when(~F.isnan(x), x)
        of = {"n": F.count(x), "mean": F.avg(x), "deviations": F.var_pop(x) * F.count(x), "low": F.min(x), "high": F.max(x), "values": F.hll_sketch_agg(x.cast("string"), LG_CONFIG), "ranks": F.kll_sketch_agg_double(x)}
        aggregates += [f.alias(f"{name}{k}") for name, f in of.items()]
    one = df.agg(*aggregates)
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{k}").alias("n"), (F.col("_rows") - F.col(f"n{k}")).alias("nulls"), *[F.col(f"{name}{k}").alias(name) for name in ("mean", "deviations", "low", "high", "values", "ranks")]) for k, c in enumerate(columns)])
    return one.select(F.lit(load).alias("load"), F.explode(each).alias("s")).select("load", "s.*")


def merged(sketches: DataFrame) -> DataFrame:
    """One row a column over all loads, again (column, n, nulls, mean, deviations, low, high, values, ranks)."""
    whole = W.partitionBy("column")
    mean = F.sum(F.col("mean") * F.col("n")).over(whole) / F.nullif(F.sum("n").over(whole), F.lit(0))
    shifted = sketches.withColumn("_mean", mean).withColumn("_off", F.col("deviations") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), 2))
    return shifted.groupBy("column").agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.max("_mean").alias("mean"), F.sum("_off").alias("deviations"), F.min("low").alias("low"), F.max("high").alias("high"), F.hll_union_agg("values").alias("values"), F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("ranks"))).alias("ranks"))


def statistics(sketches: DataFrame) -> DataFrame:
    """(column, n, nulls, mean, stddev, low, high, distinct_values, duplicates, q25, q50, q75) of ``merged`` rows."""
    quantile = lambda q: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(q)))
    distinct = F.hll_sketch_estimate("values")
    return sketches.select(
        "column", "n", "nulls", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("deviations") / (F.col("n") - 1))).alias("stddev"), "low", "high",
        distinct.alias("distinct_values"), F.greatest(F.lit(0), F.col("n") - distinct).alias("duplicates"), *[quantile(q).alias(f"q{round(100 * q)}") for q in QUANTILES],
    )
