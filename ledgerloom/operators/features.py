"""Training rows and features: target, derived expressions, audits, splits, and unfitted ML stages."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.ml.feature import Imputer, MinMaxScaler, OneHotEncoder, RobustScaler, StandardScaler, StringIndexer, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.selection import BinnedChiSquareSelector

log = logging.getLogger(__name__)

#: Derived features by name, in order; later ones may use earlier ones. Names and expressions.
DERIVED = {
    "num_top_suppliers": "coalesce(size(top_suppliers), 0)",
    "num_main_customers": "coalesce(size(main_customers), 0)",
    "num_activity_places": "coalesce(size(activity_places), 0)",
    "revenue_per_supplier": "case when revenue is null then null when coalesce(size(top_suppliers), 0) = 0 then null else revenue / size(top_suppliers) end",
    "profit_margin": "case when revenue is null or revenue = 0 then null else profit / revenue end",
    "supplier_customer_ratio": "case when coalesce(size(main_customers), 0) = 0 then null else cast(coalesce(size(top_suppliers), 0) as double) / size(main_customers) end",
}


@dataclass(frozen=True)
class FeatureConfig:
    """``legacy_assembly`` assembles raw columns only, without scaled and encoded ones; ``median_error`` is the relative error of medians."""

    numeric: tuple[str, ...] = ("revenue",)
    categorical: tuple[str, ...] = ("country", "industry_sector")
    derived: tuple[tuple[str, str], ...] = tuple(DERIVED.items())
    target: str = "target"
    target_source: str = "profit"
    threshold: float = 1_000_000.0
    scaler: str = "standard"
    encoding: str = "one_hot"
    selection: str | None = None
    select: int = 20
    bins: int = 10
    legacy_assembly: bool = False
    median_error: float = 0.001


def create_target(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """1.0 above the threshold, else 0.0 (null too); only where there is no target yet."""
    if cfg.target in df.columns:
        return df
    return df.withColumn(cfg.target, F.when(F.col(cfg.target_source) > cfg.threshold, 1.0).otherwise(0.0))


def derive(df: DataFrame, derived=tuple(DERIVED.items())) -> DataFrame:
    for name, text in derived:
        df = df.withColumn(name, F.expr(text))
    return df


def valid_records(df: DataFrame, required=("revenue", "profit")) -> DataFrame:
    return df.dropna(subset=list(required))


def null_audit(df: DataFrame, columns) -> DataFrame:
    """(feature, nulls, ratio), from one pass."""
    own = [c for c in columns if c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in own])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("nulls")) for c in own]))
    return one.select("n", rows.alias("x")).select("x.feature", "x.nulls", (F.col("x.nulls") / F.nullif(F.col("n"), F.lit(0))).alias("ratio"))


def class_balance(df: DataFrame, target: str = "target") -> DataFrame:
    """(label, n, ratio)."""
    counts = df.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("ratio", F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))))


def feature_stats(df: DataFrame, columns) -> DataFrame:
    """(feature, mean, stddev, min, max), from one pass."""
    own = [c for c in columns if c in df.columns]
    one = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in own for n, f in (("mean", F.mean), ("stddev", F.stddev_samp), ("min", F.min), ("max", F.max))])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{n}_{c}").alias(n) for n in ("mean", "stddev", "min", "max")]) for c in own]))
    return one.select(rows.alias("x")).select("x.*")


def split(df: DataFrame, key: str, parts=(0.7, 0.1, 0.2), seed: int = 42, target: str | None = "target") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test by a hash of the key (and class), the same under any partitioning.

    Stratified by ``target`` (0.0 and 1.0; other labels vanish), or plain with None. Each class is dealt
    by its own hash.
    """
    mark = [F.col(key), F.lit(seed)] + ([F.col(target)] if target else [])
    rows = df.where(F.col(target).isin(0.0, 1.0)) if target else df
    u = F.conv(F.substring(F.md5(F.concat_ws("|", *[m.cast("string") for m in mark])), 1, 8), 16, 10).cast("double") / 2**32
    a, b = parts[0], parts[0] + parts[1]
    return rows.where(u < a), rows.where((u >= a) & (u < b)), rows.where(u >= b)


def bottom_k(df: DataFrame, key: str, k: int = 100) -> DataFrame:
    """A random sample of k rows that is the same under any partitioning: those with the least MD5 of the key.

    The k least of a union are among the k least of its parts, so each partition keeps k rows and only these
    are merged; samples of loads merge in the same way.
    """
    return df.orderBy(F.md5(F.col(f"`{key}`").cast("string").cast("binary")), F.col(f"`{key}`")).limit(k)


def prepare(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Target, derived features, and 'unknown' for missing categories; ids and other columns stay."""
    df = derive(create_target(df, cfg), cfg.derived)
    return df.fillna("unknown", subset=[c for c in cfg.categorical if c in df.columns])


def stages(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> list:
    """Unfitted stages from prepared columns to ``features``; medians and scales come from what they are fitted on.

    ``df`` are the training rows; a number that is null in all of them has no median and is left out.
    """
    numbers = list(dict.fromkeys(c for c in (*cfg.numeric, *(n for n, _ in cfg.derived)) if c in df.columns))
    if numbers:
        known = df.agg(*[F.count(c).alias(c) for c in numbers]).first()
        numbers = [c for c in numbers if known[c]]
    kinds = [c for c in cfg.categorical if c in df.columns]
    out, parts = [], []
    if numbers:
        out.append(Imputer(strategy="median", relativeError=cfg.median_error, inputCols=numbers, outputCols=[f"{c}_filled" for c in numbers]))
        parts += [f"{c}_filled" for c in numbers]
    scalers = {"standard": StandardScaler(withMean=True, withStd=True), "minmax": MinMaxScaler(), "robust": RobustScaler()}
    if numbers and cfg.scaler in scalers and not cfg.legacy_assembly:
        out.append(VectorAssembler(inputCols=parts, outputCol="numeric_features", handleInvalid="keep"))
        out.append(scalers[cfg.scaler].setInputCol("numeric_features").setOutputCol("scaled_features"))
        parts = ["scaled_features"]
    for c in kinds:
        out.append(StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep"))
    if kinds and cfg.encoding == "one_hot" and not cfg.legacy_assembly:
        out.append(OneHotEncoder(inputCols=[f"{c}_index" for c in kinds], outputCols=[f"{c}_encoded" for c in kinds]))
        parts += [f"{c}_encoded" for c in kinds]
    elif kinds and not cfg.legacy_assembly:
        parts += [f"{c}_index" for c in kinds]
    chosen = cfg.selection is not None
    if cfg.selection not in (None, "chi_square", "correlation"):
        raise ValueError(f"unknown feature selection {cfg.selection!r}")
    out.append(VectorAssembler(inputCols=parts, outputCol="all_features" if chosen else "features", handleInvalid="keep"))
    if chosen:
        if cfg.selection == "chi_square":
            out.append(BinnedChiSquareSelector("all_features", cfg.target, "features", cfg.select, cfg.bins))
        else:
            by = UnivariateFeatureSelector(featuresCol="all_features", labelCol=cfg.target, outputCol="features", selectionMode="numTopFeatures")
            out.append(by.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(cfg.select))
    return out


def correlations(df: DataFrame, vector: str = "features"):
    """Pearson matrix of an assembled vector."""
    return Correlation.corr(df, vector).first()[0].toArray()


def validate_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), most_nulls: float = 0.5, least_class: float = 0.05) -> bool:
    """Whether the target is there with both classes. Many nulls in a feature, or a class rarer than ``least_class``, are logged."""
    if cfg.target not in df.columns:
        return False
    numbers = [c for c in (*cfg.numeric, *(n for n, _ in cfg.derived), *cfg.categorical) if c in df.columns]
    for r in null_audit(df, numbers).collect() if numbers else ():
        if (r["ratio"] or 0) > most_nulls:
            log.warning("%s is null in %.0f %% of the rows", r["feature"], 100 * r["ratio"])
    shares = {r["label"]: r["ratio"] for r in class_balance(df, cfg.target).collect() if r["label"] is not None}
    if shares and min(shares.values()) < least_class:
        log.warning("classes are far from even: %s", shares)
    return len(shares) > 1
