"""Curves and importances of a classifier's scores, each from one pass over the predictions."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def score_histogram(predictions: DataFrame, score: Column, target: Column, bins: int = 100) -> DataFrame:
    """(bin, positives, negatives, score_sum) of scores from 0 to 1: all that the curves need, ``bins`` rows at most."""
    rows = predictions.select(score.cast("double").alias("_s"), target.cast("double").alias("_t")).where("_s is not null and _t is not null and not isnan(_s)")
    place = F.least(F.floor(F.col("_s") * bins), F.lit(bins - 1)).cast("int")
    return rows.groupBy(place.alias("bin")).agg(F.count_if(F.col("_t") > 0.5).alias("positives"), F.count_if(F.col("_t") <= 0.5).alias("negatives"), F.sum("_s").alias("score_sum"))


def curves(histogram: DataFrame) -> DataFrame:
    """(bin, true_positive_rate, false_positive_rate, precision) of calling everything from that bin upwards positive."""
    above, whole = W.partitionBy(F.lit(1)).orderBy(F.desc("bin")), W.partitionBy(F.lit(1))  # over ``bins`` rows
    p, n = F.sum("positives").over(above), F.sum("negatives").over(above)
    all_p, all_n = F.sum("positives").over(whole), F.sum("negatives").over(whole)
    return histogram.select("bin", F.try_divide(p, all_p).alias("true_positive_rate"), F.try_divide(n, all_n).alias("false_positive_rate"), F.try_divide(p, p + n).alias("precision"))


def areas(curve: DataFrame) -> DataFrame:
    """(auc_roc, auc_pr) of ``curves`` by trapezoids; precision-recall starts at recall 0 with the first precision."""
    order = W.partitionBy(F.lit(1)).orderBy(F.desc("bin"))
    before = lambda c, first: F.coalesce(F.lag(c).over(order), first)
    zero = F.lit(0.0)
    steps = curve.select(
        ((F.col("false_positive_rate") - before("false_positive_rate", zero)) * (F.col("true_positive_rate") + before("true_positive_rate", zero)) / 2).alias("roc"),
        ((F.col("true_positive_rate") - before("true_positive_rate", zero)) * (F.col("precision") + before("precision", F.col("precision"))) / 2).alias("pr"),
    )
    return steps.agg(F.sum("roc").alias("auc_roc"), F.sum("pr").alias("auc_pr"))


def calibration(histogram: DataFrame, groups: int = 10, bins: int = 100) -> DataFrame:
    """(group, n, mean_score, positive_rate): what was said against what was, by ``groups`` equal ranges of the score."""
    by = histogram.groupBy(F.floor(F.col("bin") * groups / F.lit(bins)).cast("int").alias("group")).agg(*[F.sum(c).alias(c) for c in ("positives", "negatives", "score_sum")])
    n = F.col("positives") + F.col("negatives")
    return by.select("group", n.alias("n"), (F.col("score_sum") / n).alias("mean_score"), (F.col("positives") / n).alias("positive_rate"))


def permutation_importance(classifier: Transformer, rows: DataFrame, key: str, target: str = "target", vector: str = "features", buckets: int = 32) -> DataFrame:
    """(feature, importance): how much accuracy falls when a feature's values are dealt to other rows.

    One pass: each row stands once as it is and once a feature with that value of another row, the next one by a hash of the key
    within its bucket (the last one gets the first one's), and the classifier judges all of them at once.
    """
    kept = rows.select(F.col(key).alias("_key"), F.col(target).cast("double").alias("_target"), vector_to_array(F.col(vector)).alias("_values"))
    dealt = kept.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)))
    order = W.partitionBy("_bucket").orderBy(F.xxhash64("_key", F.lit(1)), "_key")
    other = F.coalesce(F.lead("_values").over(order), F.first("_values").over(order))
    variants = dealt.withColumn("_other", other).withColumn("_variant", F.explode(F.sequence(F.lit(0), F.size("_values"))))
    mixed = F.transform("_values", lambda x, k: F.when(k + 1 == F.col("_variant"), F.get("_other", k)).otherwise(x))
    judged = classifier.transform(variants.select("_variant", "_target", array_to_vector(mixed).alias(vector)))
    right = judged.groupBy("_variant").agg(F.avg((F.col("prediction") == F.col("_target")).cast("double")).alias("accuracy"))
    base = F.max(F.when(F.col("_variant") == 0, F.col("accuracy"))).over(W.partitionBy(F.lit(1)))  # a row a feature
    return right.withColumn("importance", base - F.col("accuracy")).where("_variant > 0").select((F.col("_variant") - 1).alias("feature"), "importance")
