"""The versioned table, loading, risk, features, training, runs, service and stream."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import features, resolve, risk, training
from ledgerloom.operators.quality import Rule
from ledgerloom.operators.tracking import Tracker
from ledgerloom.plans.metrics import Checkpoints, Metrics
from ledgerloom.plans.pipeline import IngestionConfig, IngestionPipeline, MLConfig, MLPipeline
from ledgerloom.plans.service import Service
from ledgerloom.sources import config, loader
from ledgerloom.sources.loader import FINANCIALS, SUPPLY_CHAIN, SourceConfig
from ledgerloom.sources.registry import REGISTRY, Conflict, Registry
from ledgerloom.streaming.incremental import upsert_stream

SMALL = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType()), T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())])


def table(spark, tmp_path, start=1_700_000_000.0):
    now = [start]

    def clock():
        now[0] += 60
        return now[0]

    return Registry(spark, f"{tmp_path}/db/t", SMALL, "k", "created_at", clock)


def rows(df):
    return {r["k"]: (r["a"], r["b"]) for r in df.collect()}


def test_registry_contract():
    assert len(REGISTRY) == 30 and [f.name for f in REGISTRY if not f.nullable] == ["corporate_id", "created_at", "updated_at"]


def test_merge_time_travel_and_statistics(spark, tmp_path):
    reg = table(spark, tmp_path)
    reg.create_if_missing()
    assert rows(reg.query()) == {} if reg.manifest()["snapshots"] else True
    a = reg.upsert(spark.createDataFrame([(1, "x", 1.0), (2, "y", None)], "k long, a string, b double"))
    born = {r["k"]: r["created_at"] for r in reg.at().collect()}
    b = reg.upsert(spark.createDataFrame([(2, None, 5.0), (3, "z", 3.0)], "k long, a string, b double"))
    assert rows(reg.at()) == {1: ("x", 1.0), 2: ("y", 5.0), 3: ("z", 3.0)}
    later = {r["k"]: (r["created_at"], r["updated_at"]) for r in reg.at().collect()}
    assert later[2][0] == born[2] and later[2][1] > born[2]
    assert rows(reg.time_travel(a)) == {1: ("x", 1.0), 2: ("y", None)}
    when = reg.manifest()["snapshots"][0]["committed_at"]
    assert rows(reg.time_travel(timestamp=when + 1)) == rows(reg.time_travel(timestamp=datetime.fromtimestamp(when + 1, timezone.utc))) == rows(reg.at(a))
    for wrong in ({}, {"snapshot_id": 5}, {"timestamp": 0.0}):
        with pytest.raises(ValueError):
            reg.time_travel(**wrong)
    s = reg.statistics()
    assert s["row_count"] == 3 and s["snapshot_count"] == 2 and s["latest_snapshot"] == b and s["file_count"] == reg.files().count()
    assert reg.tables() == ["t"] and reg.snapshots().count() == 2


def test_merge_twice_changes_nothing_and_duplicates_are_refused(spark, tmp_path):
    reg = table(spark, tmp_path)
    df = spark.createDataFrame([(1, "x", 1.0)], "k long, a string, b double")
    reg.upsert(df)
    once = rows(reg.at())
    reg.upsert(df)
    assert rows(reg.at()) == once
    with pytest.raises(ValueError):
        reg.upsert(df.union(df))


def test_update_compact_expire_query(spark, tmp_path):
    reg = table(spark, tmp_path)
    reg.append(spark.createDataFrame([(k, "x", float(k)) for k in range(9)], "k long, a string, b double"))
    reg.update_matched(spark.createDataFrame([(2, "new", None), (99, "no", None)], "k long, a string, b double"), ("a",))
    assert rows(reg.at())[2] == ("new", 2.0) and 99 not in rows(reg.at()) and rows(reg.at())[3] == ("x", 3.0)
    before = rows(reg.at())
    reg.compact()
    assert rows(reg.at()) == before
    assert [r["k"] for r in reg.query("b >= 3", 2).collect()] == [3, 4]
    assert reg.expire(0) == 2 and rows(reg.at()) == before and reg.statistics()["snapshot_count"] == 1


def test_a_lost_race_builds_on_the_winner(spark, tmp_path):
    reg, other = table(spark, tmp_path), table(spark, tmp_path, 1_700_500_000.0)
    reg.upsert(spark.createDataFrame([(1, "x", 1.0)], "k long, a string, b double"))
    raced = []

    def build(now):
        if not raced:
            raced.append(other.upsert(spark.createDataFrame([(2, "y", 2.0)], "k long, a string, b double")))
        return now

    reg.commit(build, "replace")
    assert rows(reg.at()) == {1: ("x", 1.0), 2: ("y", 2.0)}
    with pytest.raises(Conflict):
        reg.commit(lambda now: (other.compact(), now)[1], "replace", attempts=2)


def test_commits_touch_only_the_files_they_must(spark, tmp_path):
    reg = Registry(spark, f"{tmp_path}/db/t", SMALL, "k", None)
    part = lambda lo, hi: spark.range(lo, hi).selectExpr("id as k", "'x' as a", "cast(id as double) as b").coalesce(1)
    for k in range(4):
        reg.append(part(100 * k, 100 * k + 100))
    files = lambda: {r["path"] for r in reg.files().collect()}
    first = files()
    assert len(first) == 4 and reg.statistics()["row_count"] == 400
    reg.upsert(spark.createDataFrame([(205, "new", None), (900, "born", 1.0)], "k long, a string, b double"))
    assert len(first - files()) == 1 and rows(reg.at())[205] == ("new", 205.0) and rows(reg.at())[900] == ("born", 1.0)
    second = files()
    reg.update_matched(spark.createDataFrame([(7, "seen", 9.0), (901, "no", 1.0)], "k long, a string, b double"), ("a",))
    assert len(second - files()) == 1 and rows(reg.at())[7] == ("seen", 7.0) and 901 not in rows(reg.at())
    third, before = files(), rows(reg.at())
    reg.update_matched(spark.createDataFrame([(902, "no", 1.0)], "k long, a string, b double"), ("a",))
    assert files() == third and len(before) == 401 == reg.statistics()["row_count"]
    reg.compact(1 << 20)
    assert len(files()) == 1 and rows(reg.at()) == before
    reg.append(part(2000, 2010))
    kept = files()
    reg.compact(reg.statistics()["total_size_mb"] * 1e-3)  # nothing is that small
    assert files() == kept
    assert reg.expire(0) == 9 and rows(reg.at()).keys() == before.keys() | set(range(2000, 2010))
    assert rows(reg.time_travel(reg.manifest()["snapshots"][0]["snapshot_id"])) == rows(reg.at())


def test_compaction_of_a_table_parted_by_day(spark, tmp_path):
    reg = table(spark, tmp_path)
    for k in range(3):
        reg.append(spark.createDataFrame([(10 * k + j, "x", 1.0) for j in range(6)], "k long, a string, b double"))
    many, before = reg.statistics()["file_count"], rows(reg.at())
    reg.compact()
    assert many > 1 and reg.statistics()["file_count"] == 1 and rows(reg.at()) == before


def test_config_is_typed(tmp_path):
    (tmp_path / "c.yaml").write_text("a: ${X:-false}\nb: ${Y}\nc: ['${Z:-3}', '${W:-0.5}']\nd: plain\n")
    assert config.load_config(str(tmp_path / "c.yaml"), {"Y": "true"}) == {"a": False, "b": True, "c": [3, 0.5], "d": "plain"}
    assert config.interpolate("${U}", {}) == "" and config.flatten({"a": {"b": {"c": 1}}}) == {"a.b": "{'c': 1}"}
    assert config.session_conf({"spark": {"app_name": "x", "master": "local", "configs": {"spark.k": True}}}) == {"spark.k": "true", "spark.app.name": "x", "spark.master": "local"}


def test_loading_keeps_zeros_and_reconciles(spark, tmp_path):
    (tmp_path / "s.csv").write_text('corporate_name_S1,country,postal_code,top_suppliers,extra\nAcme,USA,00123,"[""a"",""b""]",1\n')
    got = loader.load_source(spark, SourceConfig(f"{tmp_path}/s.csv", name="one", min_records=1), SUPPLY_CHAIN)
    r = got.first()
    assert got.columns == [*SUPPLY_CHAIN.names, "_source_system", "_load_timestamp"]
    assert r["postal_code"] == "00123" and r["top_suppliers"] == ["a", "b"] and r["address"] is None and r["_source_system"] == "one"
    with pytest.raises(ValueError):
        loader.load_source(spark, SourceConfig(f"{tmp_path}/s.csv", min_records=2), SUPPLY_CHAIN)
    waits, calls = [], []
    with pytest.raises(OSError):
        loader.with_retry(lambda: calls.append(1) or (_ for _ in ()).throw(OSError()), sleep=waits.append)
    assert len(calls) == 3 and waits == [2.0, 4.0]
    typed = loader.reconcile(spark.createDataFrame([("x", "12.5", "no")], "corporate_name_S2 string, revenue string, fiscal_year string"), FINANCIALS).first()
    assert typed["revenue"] == 12.5 and typed["fiscal_year"] is None


def test_risk_replies_and_isolation(spark):
    good = '```json\n{"has_adverse_media": true, "summary": "s", "risk_score": 7, "keywords_found": ["fraud"]}\n```'
    df = spark.createDataFrame([(good,), ("nonsense",), ('{"risk_score": 1}',)], "t string")
    got = [r[0] for r in df.select(risk.parse_reply(F.col("t"))).collect()]
    assert got[0]["risk_score"] == 1.0 and got[0]["has_adverse_media"] and got[1]["risk_score"] == 0.0 and got[2] is None
    names = spark.createDataFrame([("1", "A", "great FRAUD and penalty"), ("2", "B", None)], "corporate_id string, corporate_name string, context string")
    found = {r["corporate_id"]: r for r in risk.analyse(names).collect()}
    assert found["1"]["keywords_found"] == ["fraud", "penalty"] and not found["2"]["has_adverse_media"]

    def broken(record):
        if record["corporate_id"] == "1":
            raise RuntimeError
        return {"has_adverse_media": True, "summary": "s", "risk_score": 0.4, "keywords_found": []}

    found = {r["corporate_id"]: r for r in risk.analyse(names, broken, risk.RiskConfig(attempts=2, first_wait=0.0)).collect()}
    assert found["1"]["has_adverse_media"] is None and found["1"]["adverse_media_last_checked"] is None
    assert found["2"]["risk_score"] == 0.4 and found["2"]["adverse_media_last_checked"] is not None
    assert risk.attach(names, risk.analyse(names)).columns.count("corporate_name") == 1


def test_rate_limit():
    now, slept = [0.0], []
    limit = risk.RateLimit(2, 60, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    for _ in range(5):
        limit.wait()
    assert slept == [60.0, 60.0]


def ml_rows(spark, n=100):
    data = [(f"C{k}", float(k * 1000) if k % 9 else None, 2_000_000.0 + k if k < n / 2 else float(k * 100), "USA" if k % 2 else None, "tech", ["a"] * (k % 4), ["b"] * (k % 3), ["c"]) for k in range(n)]
    return spark.createDataFrame(data, "corporate_id string, revenue double, profit double, country string, industry_sector string, top_suppliers array<string>, main_customers array<string>, activity_places array<string>")


def test_split_is_stable_and_complete(spark):
    df = features.create_target(ml_rows(spark, 1000), features.FeatureConfig())
    parts = features.split(df, "corporate_id")
    ids = [{r[0] for r in p.select("corporate_id").collect()} for p in parts]
    assert sum(map(len, ids)) == 1000 and abs(len(ids[0]) - 700) < 60
    again = features.split(df.repartition(7), "corporate_id")
    assert [{r[0] for r in p.select("corporate_id").collect()} for p in again] == ids


@pytest.mark.parametrize("selection", [None, "correlation", "chi_square"])
def test_training_with_nulls(spark, selection):
    cfg = features.FeatureConfig(selection=selection, select=3)
    ready = features.prepare(ml_rows(spark), cfg)
    assert features.validate_features(ready, cfg)
    model, summary = training.train(features.stages(ready, cfg), ready, training.TrainConfig(params={"maxIter": 5}))
    got = training.evaluate(model, ready)
    assert got["accuracy"] > 0 and "prediction" in training.predict(model, ready).columns and summary["train_rows"] == 100
    assert sum(got["confusion"].values()) == 100
    assert training.check_gates(got, {"min_auc_roc": 2})[1] and training.check_gates(got, {"min_accuracy": 0})[0]


def test_metrics_and_checkpoints(tmp_path):
    m = Metrics()
    with m.timer("total_x"), m.timer("part"):
        m.record_metric("rows", 3)
    out = m.export_metrics_to_dict()
    assert out["total_duration"] == out["durations"]["total_x"] and "ledgerloom_rows 3" in m.prometheus()
    c = Checkpoints(str(tmp_path / "c"))
    for k in range(4):
        c.save_checkpoint("load", {"k": k})
    c.save_checkpoint("other", {"k": 9})
    (tmp_path / "c" / "foreign.json").write_text("{}")
    assert c.load_latest_checkpoint("load") == {"k": 3} and c.load_latest_checkpoint("none") is None
    assert c.cleanup_old_checkpoints(1) == 3 and (tmp_path / "c" / "foreign.json").exists() and len(c.list_checkpoints()) == 2


def test_runs_end_to_end(spark, tmp_path):
    (tmp_path / "s1.csv").write_text("corporate_name_S1,address,country,postal_code,industry_sector\n" + "".join(f"Company Number{k},Street {k},USA,{10000 + k},tech\n" for k in range(30)))
    (tmp_path / "s2.csv").write_text("corporate_name_S2,revenue,profit,country,postal_code,industry_sector,fiscal_year\n" + "".join(f"Company Number{k},{k * 10}.5,{2000000 if k % 2 else 5},USA,{10000 + k},tech,2023\n" for k in range(40)))
    cfg = IngestionConfig(SourceConfig(f"{tmp_path}/s1.csv", name="s1"), SourceConfig(f"{tmp_path}/s2.csv", name="s2"), [Rule("country", "not_null")], [Rule("revenue", "positive")], matching=resolve.MatchConfig(threshold=0.699), checkpoint_dir=f"{tmp_path}/cp")
    reg = Registry(spark, f"{tmp_path}/db/companies")
    run = IngestionPipeline(spark, cfg, reg)
    first = run.run()
    assert first.success, first.error
    assert reg.at().columns == REGISTRY.names and first.counts["row_count"] == 40
    again = run.run(run_adverse_media=False)
    assert again.success and again.counts["row_count"] == 40 and reg.at().where("has_adverse_media is not null").count() == 40 and first.counts["adverse_entities"] == 0
    assert IngestionPipeline(spark, IngestionConfig(cfg.source1, cfg.source2, [Rule("address", "min_length", 99)]), reg).run().stage == "data_quality"
    ml = MLPipeline(spark, MLConfig(training=training.TrainConfig(params={"maxIter": 5}), split=(0.6, 0.1, 0.3), auto_promote=True, require_approval=False), reg, Tracker(f"{tmp_path}/track"))
    out = ml.run()
    assert out.success, out.error
    service = Service(spark, reg, ml, run)
    assert service.handle("GET", "/health", {})[0] == 200
    status, got = service.handle("POST", "/iceberg/query", {"filter_condition": "revenue > 100", "limit": 3})
    assert status == 200 and len(got["rows"]) == 3 and json.dumps(got)
    record = reg.at().where("revenue is not null").limit(2).collect()
    status, got = service.handle("POST", "/predict", {"records": [r.asDict() for r in record]})
    assert status == 200 and len(got["predictions"]) == 2
    assert service.handle("POST", "/iceberg/query", {"filter_condition": 3})[0] == service.handle("POST", "/iceberg/query", {"filter_condition": "no such"})[0] == 400 and service.handle("GET", "/x", {})[0] == 404
    assert service.stats()["row_count"] == 40


def test_tracker_versions(spark, tmp_path):
    t = Tracker(str(tmp_path))
    ready = features.prepare(ml_rows(spark, 40), features.FeatureConfig())
    model, _ = training.train(features.stages(ready), ready, training.TrainConfig(params={"maxIter": 2}))
    ids = []
    for accuracy, auto in ((0.9, True), (0.2, True)):
        ids.append(t.start_run())
        t.log_metrics({"accuracy": accuracy})
        t.log_model(model)
        t.register_model("m", {"accuracy": accuracy}, 0.5, auto, False)
        t.end_run()
    assert [v["stage"] for v in t._versions("m")] == ["Production", "Staging"]
    assert t.load_model("m") and t.load_model("m", version=2)
    with pytest.raises(ValueError):
        t.load_model("m", stage="Archived")
    assert t.compare_models(spark, ids).where("name = 'accuracy'").count() == 2


def test_later_files_win_and_their_nulls_keep(spark, tmp_path):
    import os

    reg = Registry(spark, f"{tmp_path}/db/s", SMALL, "k", None)
    kind = T.StructType(SMALL.fields[:3])
    loads = [[(1, "z", 1.0), (2, "b", 2.0)], [(1, "a", None), (3, None, 3.0)], [(2, None, 0.5)]]
    for k, own in enumerate(loads):
        spark.createDataFrame(own, kind).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        for f in os.listdir(f"{tmp_path}/in/{k}"):
            os.utime(f"{tmp_path}/in/{k}/{f}", (1_600_000_000 + 60 * k,) * 2)
    upsert_stream(spark, f"{tmp_path}/in/*", kind, reg, f"{tmp_path}/cp")
    assert rows(reg.at()) == {1: ("a", 1.0), 2: ("b", 0.5), 3: (None, 3.0)}


@pytest.mark.parametrize("scaler", ["minmax", "robust"])
@pytest.mark.parametrize("algorithm, params", [("random_forest", {"numTrees": 3}), ("gbt", {"maxIter": 2})])
def test_forests_and_scalers(spark, scaler, algorithm, params):
    cfg = features.FeatureConfig(scaler=scaler)
    ready = features.prepare(ml_rows(spark), cfg)
    model, _ = training.train(features.stages(ready, cfg), ready, training.TrainConfig(algorithm, params))
    got = training.evaluate(model, ready)
    assert 0.5 <= got["areaUnderROC"] <= 1 and 0 <= got["areaUnderPR"] <= 1
    assert sum(w for _, w in training.feature_importance(model)) == pytest.approx(1)
    assert training.check_gates(got, {"min_auc_roc": 0.4, "min_auc_pr": 0.0})[0]
    with pytest.raises(KeyError):
        training.check_gates(got, {"min_nothing": 0})


@pytest.mark.parametrize("validated", [False, True])
def test_tuning(spark, validated):
    ready = features.prepare(ml_rows(spark), features.FeatureConfig())
    cfg = training.TrainConfig(params={"maxIter": 2}, grid={"regParam": [0.0, 0.5]}, folds=2)
    model, _ = training.train(features.stages(ready), ready, cfg, ready if validated else None)
    assert training.evaluate(model, ready)["accuracy"] > 0


def test_validation_of_features(spark):
    ready = features.prepare(ml_rows(spark), features.FeatureConfig())
    assert features.validate_features(ready) and not features.validate_features(ready.drop("target")) and not features.validate_features(ready.where("target = 1"))


def test_stream_merges_new_files_once(spark, tmp_path):
    reg = Registry(spark, f"{tmp_path}/db/s", SMALL, "k", None)
    kind = T.StructType(SMALL.fields[:3])
    spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], kind).write.parquet(f"{tmp_path}/in/a")
    go = lambda: upsert_stream(spark, f"{tmp_path}/in/*", kind, reg, f"{tmp_path}/cp", order="b")
    go()
    assert rows(reg.at()) == {1: ("y", 2.0)}
    spark.createDataFrame([(2, "z", 3.0)], kind).write.parquet(f"{tmp_path}/in/b")
    go()
    go()
    assert rows(reg.at()) == {1: ("y", 2.0), 2: ("z", 3.0)} and reg.statistics()["snapshot_count"] == 2


def test_settled_tables_can_be_swept(spark, monkeypatch):
    from ledgerloom.plans import scratch

    monkeypatch.setattr(scratch, "_MADE", [])
    df = scratch.settle(spark.range(5))
    assert df.count() == 5 and scratch.sweep(spark) == 1 and scratch.sweep(spark) == 0


def test_a_failing_first_read_is_tried_again(spark, tmp_path, monkeypatch):
    (tmp_path / "s.csv").write_text("corporate_name_S1\nAcme\n")
    plain, calls = loader.enough_of, []

    def failing_once(df, least):
        calls.append(least)
        if len(calls) == 1:
            raise OSError("a lost file server")
        return plain(df, least)

    monkeypatch.setattr(loader, "enough_of", failing_once)
    got = loader.load_source(spark, SourceConfig(f"{tmp_path}/s.csv", min_records=1), SUPPLY_CHAIN)
    assert got.count() == 1 and calls == [1, 1]
