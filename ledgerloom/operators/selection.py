"""Chi-square selection of numeric features: quantile bins, one pass of contingency counts, p-values from them.

Raw numbers are no categories: a test on them sees as many categories as values, and Spark's own selector refuses more than 10,000. Here each
feature is cut at its quantiles first, so a table has at most (bins + 1) x labels cells a feature, whatever the number of rows.
"""

from __future__ import annotations

import json
import math

from pyspark.ml import Estimator
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def quantile_edges(df: DataFrame, values: Column, bins: int, accuracy: int = 10_000) -> list[list[float]]:
    """Of each place of an array column the inner quantiles, distinct and ascending; from one pass of mergeable summaries.

    ``accuracy`` is that of ``percentile_approx``: ranks are off by at most rows / accuracy. NaN and null count for nothing.
    """
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    long = df.select(F.posexplode(values).alias("feature", "x"))
    found = long.groupBy("feature").agg(F.max("x").alias("top"), F.percentile_approx(F.when(~F.isnan("x"), F.col("x")), shares, accuracy).alias("cuts")).collect()  # a row a feature
    edges: list[list[float]] = [[] for _ in range(1 + max((r["feature"] for r in found), default=-1))]
    for r in found:
        edges[r["feature"]] = sorted(set(r["cuts"] or ()))
    return edges


def contingency(df: DataFrame, values: Column, label: Column, edges: list[list[float]]) -> DataFrame:
    """(feature, bin, label, n): a value's bin is the number of edges below it, -1 for NaN and null. Rows without a label are left out."""
    cuts = F.from_json(F.lit(json.dumps(edges)), "array<array<double>>")
    bins = F.transform(values, lambda x, k: F.when(x.isNull() | F.isnan(x), -1).otherwise(F.size(F.filter(F.get(cuts, k), lambda e: e < x))))
    long = df.where(label.isNotNull()).select(label.alias("label"), F.posexplode(bins).alias("feature", "bin"))
    return long.groupBy("feature", "bin", "label").agg(F.count(F.lit(1)).alias("n"))


def chi_square(table: DataFrame) -> DataFrame:
    """(feature, statistic, degrees) of each feature's contingency table; one bin or one label gives 0 and 0."""
    of = lambda *keys: F.sum("n").over(W.partitionBy("feature", *keys)).cast("double")
    cells = table.withColumns({"_row": of("bin"), "_col": of("label"), "_all": of()})
    sums = cells.groupBy("feature").agg(F.max("_all").alias("_all"), F.sum(F.col("n") * F.col("n") / (F.col("_row") * F.col("_col"))).alias("_sum"), F.count_distinct("bin").alias("_bins"), F.count_distinct("label").alias("_labels"))
    degrees = (F.col("_bins") - 1) * (F.col("_labels") - 1)
    return sums.select("feature", F.when(degrees == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.col("_all") * (F.col("_sum") - 1))).alias("statistic"), degrees.alias("degrees"))


def p_value(statistic: float, degrees: int) -> float:
    """The share of the chi-square distribution above ``statistic``: the upper incomplete gamma function, as a series or a continued fraction."""
    a, x = degrees / 2, statistic / 2
    if degrees == 0 or x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - scale * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for k in range(1, 10_000):
        b += 2
        d = 1 / ((k * (a - k) * d + b) or tiny)
        c = (b + k * (a - k) / c) or tiny
        h *= (step := c * d)
        if abs(step - 1) < 1e-15:
            break
    return scale * h


class BinnedChiSquareSelector(Estimator, HasFeaturesCol, HasLabelCol, HasOutputCol):
    """Keeps the ``most`` features of the least p-value, then the greatest statistic, then the first place; fits to a ``VectorSlicer``."""

    most = Param(Params._dummy(), "most", "features kept", TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "quantile bins of a feature", TypeConverters.toInt)

    def __init__(self, featuresCol: str = "features", labelCol: str = "label", outputCol: str = "selected", most: int = 20, bins: int = 10):  # noqa: N803
        super().__init__()
        self._set(featuresCol=featuresCol, labelCol=labelCol, outputCol=outputCol, most=most, bins=bins)

    def tested(self, df: DataFrame) -> list[tuple[int, float, int, float]]:
        """(place, statistic, degrees, p-value) of each feature."""
        values, label = vector_to_array(F.col(self.getFeaturesCol())), F.col(self.getLabelCol())
        edges = quantile_edges(df, values, self.getOrDefault("bins"))
        rows = chi_square(contingency(df, values, label, edges)).collect()  # a row a feature
        return sorted((r["feature"], r["statistic"], r["degrees"], p_value(r["statistic"], r["degrees"])) for r in rows)

    def _fit(self, df: DataFrame) -> VectorSlicer:
        best = sorted(self.tested(df), key=lambda t: (t[3], -t[1], t[0]))[: self.getOrDefault("most")]
        return VectorSlicer(inputCol=self.getFeaturesCol(), outputCol=self.getOutputCol(), indices=sorted(t[0] for t in best))
