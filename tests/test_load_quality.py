"""Quality within the load, rejects, resumed runs, sketches; selection, tuning, curves and importances."""

import math
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import evaluation, features, quality, resolve, selection, sketches, training
from ledgerloom.operators.quality import Rule
from ledgerloom.plans.pipeline import IngestionConfig, IngestionPipeline
from ledgerloom.plans.stages import Stages
from ledgerloom.sources import loader
from ledgerloom.sources.loader import FINANCIALS, SourceConfig
from ledgerloom.sources.registry import Registry

RULES = [Rule("a", "not_null"), Rule("a", "unique"), Rule("b", "range", low=0, high=5), Rule("b", "unique", approx=True), Rule("c", "positive"), Rule("a", "pattern", "^x")]


def test_rules_counted_while_the_rows_are_written(spark, tmp_path):
    df = quality.apart(spark).createDataFrame([("x1", 1.0), ("x1", 9.0), (None, None), ("y", -1.0)], "a string, b double")
    counted, seen, left = quality.observed(df, RULES, "t1")
    counted.write.parquet(f"{tmp_path}/t")
    written = spark.read.parquet(f"{tmp_path}/t")
    found = quality.observed_report(seen, RULES, df.columns, written)
    assert found == [r.asDict() for r in quality.report(df, RULES).collect()] and [r.kind for r in left] == ["unique"]
    assert quality.judged(found, 0.5) and not quality.judged(found, 0.1) and not quality.judged([])
    with pytest.raises(ValueError, match="no rows"):
        quality.judged([{"rows": 0, "errors": 0}])


def test_rejects_are_parted_from_rows_in_one_pass(spark):
    want = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("d", T.DateType()), T.StructField("s", T.StringType()), T.StructField("j", T.StructType([T.StructField("k", T.IntegerType())])), T.StructField("new", T.DoubleType())])
    rows = [("1", "2024-01-01", "t", '{"k": 1}'), ("x", "2024-01-01", "t", None), (" ", None, None, '{"k": '), ("2.5", "soon", "", "{}"), (None, "", "", "")]
    kept, rejects = loader.split_rejects(spark.createDataFrame(rows, "n string, d string, s string, j string"), want)
    assert kept.columns == want.names and [(r["n"], r["j"]["k"] if r["j"] else None) for r in kept.orderBy("n").collect()] == [(None, None), (1, 1)]
    got = sorted((r["column"], r["reason"], r["value"]) for r in rejects.collect())
    assert got == [("d", "not a date", "soon"), ("j", "not a struct<k:int>", '{"k": '), ("n", "not a int", "2.5"), ("n", "not a int", "x")]
    none_kept, none_rejected = loader.split_rejects(spark.createDataFrame([], "n string"), want)
    assert none_kept.isEmpty() and none_rejected.isEmpty()


def test_broken_lines_and_values_of_a_source_go_to_its_quarantine(spark, tmp_path):
    (tmp_path / "s.csv").write_text("corporate_name_S2,revenue,fiscal_year\nAcme,12.5,2023\nBad,much,2023\nShort,1.0\nLong,1,2,3,4\nNone,,\n")
    cfg = SourceConfig(f"{tmp_path}/s.csv", name="two", quarantine=f"{tmp_path}/q")
    got = loader.load_source(spark, cfg, FINANCIALS)
    assert {r["corporate_name_S2"] for r in got.collect()} == {"Acme", "None"} and "_source_system" in got.columns
    rejects = {(r["column"], r["reason"], r["value"]) for r in spark.read.parquet(f"{tmp_path}/q").collect()}
    assert rejects == {("revenue", "not a double", "much"), (None, "corrupt record", "Short,1.0"), (None, "corrupt record", "Long,1,2,3,4")}
    (tmp_path / "s.json").write_text('{"corporate_name_S2": "A", "revenue": "7"}\n{"corporate_name_S2": \n')
    got = loader.load_source(spark, SourceConfig(f"{tmp_path}/s.json", format="json", quarantine=f"{tmp_path}/q2"), FINANCIALS)
    assert [r["revenue"] for r in got.collect()] == [7.0] and spark.read.parquet(f"{tmp_path}/q2").first()["reason"] == "corrupt record"


def test_stages_are_found_again_by_what_they_depend_on(spark, tmp_path):
    (tmp_path / "in.csv").write_text("1\n")
    built = []

    def run(settings=0, name="in.csv"):
        s = Stages(spark, f"file://{tmp_path}/stages")
        s.run("a", lambda: built.append("a") or spark.range(3), settings=(settings, s.files(f"file://{tmp_path}/{name}")))
        return s, s.run("b", lambda: built.append("b") or s.spark.read.parquet(s.path("a")).selectExpr("id * 2 as x"), ["a"]).agg(F.sum("x")).first()[0]

    first, total = run()
    again, same = run()
    assert total == same == 6 and built == ["a", "b"] and again.reused == ["a", "b"] and first.computed == ["a", "b"]
    run(settings=1)
    assert built == ["a", "b"] * 2
    (tmp_path / "in.csv").write_text("1\n2\n")
    last, _ = run()
    assert built == ["a", "b"] * 3
    fs, p = last._status(f"{last.path('b')}/_SUCCESS")
    fs.delete(p, False)  # a writer that did not finish
    unfinished, _ = run()
    assert unfinished.reused == ["a"] and unfinished.computed == ["b"] and unfinished.drop_others() == 4


def test_a_killed_run_goes_on_after_its_last_stage(spark, tmp_path, monkeypatch):
    (tmp_path / "s1.csv").write_text("corporate_name_S1,country,postal_code\n" + "".join(f"Company {k},USA,{k}\n" for k in range(8)))
    (tmp_path / "s2.csv").write_text("corporate_name_S2,revenue,country,postal_code\n" + "".join(f"Company {k},{k}.5,USA,{k}\n" for k in range(9)))
    cfg = IngestionConfig(SourceConfig(f"{tmp_path}/s1.csv", name="s1"), SourceConfig(f"{tmp_path}/s2.csv", name="s2"), [Rule("country", "not_null")], [Rule("revenue", "unique")], stage_dir=f"file://{tmp_path}/stages")
    reg = Registry(spark, f"{tmp_path}/db/companies")
    resolved, plain, upsert = [], resolve.resolve_entities, reg.upsert
    monkeypatch.setattr(resolve, "resolve_entities", lambda *a: resolved.append(1) or plain(*a))
    monkeypatch.setattr(reg, "upsert", lambda df: (_ for _ in ()).throw(OSError("the store is away")))
    broken = IngestionPipeline(spark, cfg, reg)
    assert broken.run(resume_from_checkpoint=True).stage == "upsert" and resolved == [1] and len(broken.stages.computed) == 5
    monkeypatch.setattr(reg, "upsert", upsert)
    going_on = IngestionPipeline(spark, cfg, reg)
    out = going_on.run(resume_from_checkpoint=True)
    assert out.success, out.error
    assert resolved == [1] and going_on.stages.computed == [] and len(going_on.stages.reused) == 5 and out.counts["row_count"] == 9
    (tmp_path / "s2.csv").write_text("corporate_name_S2,revenue,country,postal_code\nCompany 1,1.5,USA,1\n")
    changed = IngestionPipeline(spark, cfg, reg)
    assert changed.run(resume_from_checkpoint=True).success and sorted(changed.stages.computed) == ["entities", "source2", "source2_report"] and resolved == [1, 1]


def test_sketches_of_loads_merge_to_those_of_all_rows(spark):
    rng = random.Random(1)
    rows = [(k, float(rng.randrange(500)) if rng.random() > 0.1 else rng.choice([None, float("nan")]), rng.gauss(1e6, 1.0)) for k in range(6000)]
    df = spark.createDataFrame(rows, "k long, a double, b double")
    loads = [sketches.sketched(df.where(cut), ["a", "b", "nothing"], k) for k, cut in enumerate(("k < 100", "k between 100 and 4000", "k > 4000"))] if False else [sketches.sketched(df.where(cut).withColumn("nothing", F.lit(None).cast("double")), ["a", "b", "nothing"], k) for k, cut in enumerate(("k < 100", "k between 100 and 4000", "k > 4000"))]
    got = {r["column"]: r for r in sketches.statistics(sketches.merged(loads[0].unionByName(loads[1]).unionByName(loads[2]))).collect()}
    for c, i in (("a", 1), ("b", 2)):
        xs = sorted(r[i] for r in rows if r[i] is not None and not math.isnan(r[i]))
        mean = math.fsum(xs) / len(xs)
        assert got[c]["n"] == len(xs) and got[c]["nulls"] == 6000 - len(xs) and got[c]["low"] == xs[0] and got[c]["high"] == xs[-1]
        assert got[c]["mean"] == pytest.approx(mean, rel=1e-12) and got[c]["stddev"] == pytest.approx(math.sqrt(math.fsum((x - mean) ** 2 for x in xs) / (len(xs) - 1)), rel=1e-6)
        assert abs(got[c]["distinct_values"] - len(set(xs))) <= 0.06 * len(set(xs))
        for q in sketches.QUANTILES:
            at = got[c][f"q{round(100 * q)}"]
            assert sum(x < at for x in xs) / len(xs) - 0.02 <= q <= sum(x <= at for x in xs) / len(xs) + 0.02
    assert got["nothing"]["n"] == 0 and got["nothing"]["q50"] is None and got["nothing"]["distinct_values"] == 0


def test_samples_are_the_same_under_any_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    one = {r["k"] for r in features.bottom_k(df, "k", 50).collect()}
    assert one == {r["k"] for r in features.bottom_k(df.repartition(13), "k", 50).collect()} and len(one) == 50
    parts = features.bottom_k(df.where("k < 1000"), "k", 50).unionByName(features.bottom_k(df.where("k >= 1000"), "k", 50))
    assert {r["k"] for r in features.bottom_k(parts, "k", 50).collect()} == one


@pytest.mark.parametrize(("x", "degrees", "want"), [(3.841459, 1, 0.05), (18.307038, 10, 0.05), (2.5, 4, 0.644636), (0.0, 3, 1.0), (400.0, 2, math.exp(-200)), (7.0, 0, 1.0), (90.0, 100, 0.753)])
def test_p_values(x, degrees, want):
    assert selection.p_value(x, degrees) == pytest.approx(want, rel=2e-3)


def test_chi_square_of_many_values(spark):
    """More distinct values than a categorical test takes; the informative feature is kept and the statistic is that of the plain table."""
    rng = random.Random(5)
    rows = [(float(k), rng.random(), float("nan") if k % 10 == 0 else rng.random() + (k % 2), float(k % 2)) for k in range(20_000)]
    df = VectorAssembler(inputCols=["i", "noise", "signal"], outputCol="all", handleInvalid="keep").transform(spark.createDataFrame(rows, "i double, noise double, signal double, label double"))
    chosen = selection.BinnedChiSquareSelector("all", "label", "features", most=1, bins=8)
    tested = {t[0]: t for t in chosen.tested(df)}
    assert tested[2][3] < 1e-100 < 0.001 < tested[1][3] and tested[0][3] > 0.5
    model = chosen.fit(df)
    assert model.getIndices() == [2] and model.transform(df).first()["features"].size == 1
    edges = selection.quantile_edges(df, F.array("signal"), 8)[0]
    cells: dict = {}
    for _, _, x, label in rows:
        cell = (-1 if math.isnan(x) else sum(e < x for e in edges), label)
        cells[cell] = cells.get(cell, 0) + 1
    row = {b: sum(n for (c, _), n in cells.items() if c == b) for b, _ in cells}
    col = {b: sum(n for (_, c), n in cells.items() if c == b) for _, b in cells}
    want = sum((cells.get((b, c), 0) - row[b] * col[c] / 20_000) ** 2 / (row[b] * col[c] / 20_000) for b in row for c in col)
    assert tested[2][1] == pytest.approx(want, rel=1e-9) and tested[2][2] == len(row) - 1


def ml_frame(spark, n=300):
    rng = random.Random(9)
    rows = [(k, rng.random(), rng.random(), rng.random()) for k in range(n)]
    rows = [(k, a, b, c, float(a + 0.3 * b + 0.1 * rng.random() > 0.7)) for k, a, b, c in rows]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, target double")


def test_tuning_chooses_what_a_plain_loop_chooses(spark, tmp_path):
    df = ml_frame(spark)
    rows, held = df.where("k % 3 > 0"), df.where("k % 3 = 0")
    stages = [VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")]
    cfg = training.TrainConfig(params={"maxIter": 5}, grid={"regParam": [5.0, 0.0, 0.5], "elasticNetParam": [0.0, 1.0]}, parallelism=3, folds=3)
    model, summary = training.train(stages, rows, cfg, held)
    judge, want = BinaryClassificationEvaluator(labelCol="target"), []
    for params, metric in summary["tuning"]:
        plain = Pipeline(stages=[*stages, LogisticRegression(labelCol="target", maxIter=5, **params)]).fit(rows)
        want.append(judge.evaluate(plain.transform(held)))
        assert metric == pytest.approx(want[-1], abs=1e-9)
    best = summary["tuning"][max(range(len(want)), key=lambda k: (want[k], -k))][0]
    assert len(want) == 6 and {k: summary["params"][k] for k in best} == best and model.stages[-1].getRegParam() == best["regParam"]
    crossed = training.train(stages, rows, cfg)[1]
    assert len(crossed["tuning"]) == 6 and crossed["tuning"] == training.train(stages, rows.repartition(5), cfg)[1]["tuning"]
    training.save_model(model, f"{tmp_path}/m", summary, features.bottom_k(rows, "k", 10))
    assert PipelineModel.load(f"{tmp_path}/m").transform(held).count() == held.count() and spark.read.parquet(f"{tmp_path}/m_sample").count() == 10


def test_predictions_equal_the_plain_formula(spark):
    """What ``predict`` gives is the logistic function of the fitted weights, row by row."""
    df = ml_frame(spark)
    model, _ = training.train([VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")], df, training.TrainConfig(params={"maxIter": 20}))
    w, w0 = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    for r in training.predict(model, df).collect():
        p = 1 / (1 + math.exp(-(w[0] * r["a"] + w[1] * r["b"] + w[2] * r["c"] + w0)))
        assert r["probability"][1] == pytest.approx(p, abs=1e-9) and r["prediction"] == float(p > 0.5)


def test_curves_areas_and_importances(spark):
    df = ml_frame(spark, 600)
    model, _ = training.train([VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")], df, training.TrainConfig(params={"maxIter": 20}))
    judged = training.predict(model, df)
    from pyspark.ml.functions import vector_to_array

    histogram = evaluation.score_histogram(judged, vector_to_array("probability")[1], F.col("target"), 1000)
    areas = evaluation.areas(evaluation.curves(histogram)).first()
    exact = training.evaluate(model, df)
    assert areas["auc_roc"] == pytest.approx(exact["areaUnderROC"], abs=0.003) and areas["auc_pr"] == pytest.approx(exact["areaUnderPR"], abs=0.01)
    table = evaluation.calibration(evaluation.score_histogram(judged, vector_to_array("probability")[1], F.col("target"))).collect()
    assert sum(r["n"] for r in table) == 600 and all(0 <= r["mean_score"] - r["group"] / 10 <= 0.1 for r in table)
    got = {r["feature"]: r["importance"] for r in evaluation.permutation_importance(model.stages[-1], model.stages[0].transform(df), "k").collect()}
    assert got.keys() == {0, 1, 2} and got[0] > 0.2 > got[1] > abs(got[2]) - 0.02
    assert evaluation.areas(evaluation.curves(evaluation.score_histogram(judged.where("false"), F.lit(0.5), F.col("target")))).first()[0] is None
