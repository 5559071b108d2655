"""Queries whose largest task, or whose shuffles, must not grow faster than the tables."""

import pytest
from pyspark.sql import functions as F

from ledgerloom import load_queries, queries
from ledgerloom.operators import features, training

SMALL = "/root/testdata/sf0.001"


def test_training_joins_its_tables_once(spark):
    got = queries.QUERIES["train_predict"](spark, SMALL)
    assert "lineitem" not in got._jdf.queryExecution().executedPlan().toString()
    cfg = features.FeatureConfig(categorical=("industry_sector",), threshold=500_000)
    rows = features.prepare(features.valid_records(queries._money(spark, SMALL)), cfg).persist()
    train_rows, _, test_rows = features.split(rows, "c_custkey")
    model, _ = training.train(features.stages(rows, cfg), train_rows, training.TrainConfig(params={"maxIter": 10}))
    want = training.predict(model, test_rows).select("c_custkey", "target", "prediction")
    told = sorted(map(tuple, got.collect()))
    assert told == sorted(map(tuple, want.collect())) and told
    rows.unpersist()


def test_parts_of_a_source_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """A folder that is written by one task has one file."""
    spark.read.parquet(f"{SMALL}/documents.parquet").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    seen = {}

    class Stop(Exception):
        pass

    def caught(spark, paths, schemas, *_, files_per_batch, **__):
        seen.update(paths=paths, most=files_per_batch, schemas=schemas)
        raise Stop

    monkeypatch.setattr(load_queries, "resolve_stream", caught)
    with pytest.raises(Stop):
        queries.QUERIES["incremental_resolution"](spark, str(tmp_path))
    both = [spark.read.schema(s).parquet(p) for s, p in zip(seen["schemas"], seen["paths"], strict=True)]
    assert seen["most"] > 1 and all(len(df.inputFiles()) > 3 for df in both)
    ids = both[0].select("doc_id").union(both[1].select("doc_id")).agg(F.count_distinct("doc_id")).first()[0]
    assert ids == spark.read.parquet(f"{tmp_path}/documents.parquet").count()
