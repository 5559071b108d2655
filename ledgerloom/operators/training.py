"""Classifiers over a feature pipeline: training, tuning of the whole pipeline, evaluation, gates."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALGORITHMS = {"logistic_regression": LogisticRegression, "random_forest": RandomForestClassifier, "gbt": GBTClassifier}
#: Gate names to metric names.
GATES = {"auc_roc": "areaUnderROC", "auc_pr": "areaUnderPR", "accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1", "f1_score": "f1"}


@dataclass(frozen=True)
class TrainConfig:
    algorithm: str = "logistic_regression"
    params: dict = field(default_factory=dict)
    grid: dict = field(default_factory=dict)
    folds: int = 5
    seed: int = 42
    target: str = "target"
    gates: dict = field(default_factory=dict)
    parallelism: int = 2


def estimator(cfg: TrainConfig):
    if cfg.algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {cfg.algorithm!r}")
    seed = {} if cfg.algorithm == "logistic_regression" else {"seed": cfg.seed}
    return ALGORITHMS[cfg.algorithm](featuresCol="features", labelCol=cfg.target, **seed, **cfg.params)


def on_validation(pipeline: Pipeline, maps: list[dict], rows: DataFrame, validation: DataFrame, judge, parallelism: int) -> list[float]:
    """The metric of each parameter map on the given validation rows; ``parallelism`` fits run at a time."""
    rows, validation = rows.persist(), validation.persist()
    try:
        fits = pipeline.fitMultiple(rows, maps)

        def one(_) -> tuple[int, float]:
            k, model = next(fits)
            return k, judge.evaluate(model.transform(validation))

        with ThreadPool(max(1, parallelism)) as pool:
            found = dict(pool.map(inheritable_thread_target(rows.sparkSession)(one), range(len(maps))))
    finally:
        rows.unpersist()
        validation.unpersist()
    return [found[k] for k in range(len(maps))]


def dealt_folds(rows: DataFrame, folds: int, seed: int) -> DataFrame:
    """``rows`` with ``_fold`` by a hash of all columns, the same under any partitioning."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    return rows.withColumn("_fold", F.pmod(F.xxhash64(text, F.lit(seed)), F.lit(folds)).cast("int"))


def train(stages: list, rows: DataFrame, cfg: TrainConfig = TrainConfig(), validation: DataFrame | None = None) -> tuple[PipelineModel, dict]:
    """Fit stages and classifier as one pipeline; with a grid, tune all of it. Returns model and summary.

    With ``validation``, each point of the grid is fitted on ``rows`` and judged on those rows; without, by cross-validation over
    folds dealt by a hash. The best (the first of equal ones) is then fitted on all of ``rows``.
    """
    began, model, tuning = time.monotonic(), estimator(cfg), []
    pipeline = Pipeline(stages=[*stages, model])
    if cfg.grid:
        grid = ParamGridBuilder()
        for name, values in cfg.grid.items():
            grid = grid.addGrid(getattr(model, name), values)
        judge, maps = BinaryClassificationEvaluator(labelCol=cfg.target), grid.build()
        if validation is not None:
            metrics = on_validation(pipeline, maps, rows, validation, judge, cfg.parallelism)
        else:
            tuner = CrossValidator(estimator=pipeline, estimatorParamMaps=maps, evaluator=judge, numFolds=cfg.folds, foldCol="_fold", parallelism=cfg.parallelism)
            metrics = tuner.fit(dealt_folds(rows, cfg.folds, cfg.seed)).avgMetrics
        tuning = [({p.name: v for p, v in m.items()}, x) for m, x in zip(maps, metrics, strict=True)]
        fitted = pipeline.fit(rows, maps[max(range(len(maps)), key=lambda k: (metrics[k], -k))])
    else:
        fitted = pipeline.fit(rows)
    best = max(tuning, key=lambda t: t[1])[0] if tuning else {}
    return fitted, {"algorithm": cfg.algorithm, "params": dict(cfg.params) | best, "tuning": tuning, "train_rows": rows.count(), "seconds": time.monotonic() - began}


def confusion_matrix(predictions: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """tp, tn, fp, fn in one pass."""
    is_, said = F.col(target).cast("double"), F.col(prediction).cast("double")
    return predictions.agg(*[F.count_if((said == p) & (is_ == t)).alias(n) for n, p, t in (("tp", 1.0, 1.0), ("tn", 0.0, 0.0), ("fp", 1.0, 0.0), ("fn", 0.0, 1.0))])


def weighted_metrics(predictions: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """accuracy, and class-weighted precision, recall and f1, from the confusion counts."""
    c = confusion_matrix(predictions, target, prediction)
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, tn, fp, fn = (F.col(k).cast("double") for k in ("tp", "tn", "fp", "fn"))
    n = tp + tn + fp + fn
    p1, p0, r1, r0 = ratio(tp, tp + fp), ratio(tn, tn + fn), ratio(tp, tp + fn), ratio(tn, tn + fp)
    f1, f0 = ratio(2 * p1 * r1, p1 + r1), ratio(2 * p0 * r0, p0 + r0)
    weigh = lambda a, b: ratio(a * (tp + fn) + b * (tn + fp), n)
    return c.select(ratio(tp + tn, n).alias("accuracy"), weigh(p1, p0).alias("precision"), weigh(r1, r0).alias("recall"), weigh(f1, f0).alias("f1"))


def evaluate(model: PipelineModel, rows: DataFrame, target: str = "target") -> dict:
    """Six metrics and the confusion counts; predictions are kept meanwhile."""
    predictions = model.transform(rows).select(target, "rawPrediction", "prediction").persist()
    try:
        binary = BinaryClassificationEvaluator(labelCol=target)
        out = {m: binary.setMetricName(m).evaluate(predictions) for m in ("areaUnderROC", "areaUnderPR")}
        many = MulticlassClassificationEvaluator(labelCol=target)
        out |= {m: many.setMetricName(m).evaluate(predictions) for m in ("accuracy", "weightedPrecision", "weightedRecall", "f1")}
        return out | {"confusion": confusion_matrix(predictions, target).first().asDict()}
    finally:
        predictions.unpersist()


def check_gates(metrics: dict, gates: dict) -> tuple[bool, list[str]]:
    """``min_<name>`` against the metric of that name; an unknown gate raises."""
    failures = []
    for gate, least in gates.items():
        metric = GATES[gate.removeprefix("min_")]
        if metrics[metric] < float(least):
            failures.append(f"{metric} {metrics[metric]:.4f} is below {float(least):.4f}")
    return not failures, failures


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def feature_importance(model: PipelineModel, names: list[str] | None = None) -> list[tuple[str, float]]:
    """(feature, weight) of a fitted pipeline's classifier, greatest first."""
    last = model.stages[-1]
    own = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    return sorted(((names[k] if names else f"f{k}", float(v)) for k, v in enumerate(own)), key=lambda x: -x[1])


def save_model(model: PipelineModel, path: str, summary: dict, sample: DataFrame | None = None) -> None:
    """The model, and beside it its summary as one JSON row and a sample of the rows it was fitted on."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(path)
    SparkSession.getActiveSession().createDataFrame([(json.dumps(summary, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}_summary")
    if sample is not None:
        sample.coalesce(1).write.mode("overwrite").parquet(f"{path}_sample")
