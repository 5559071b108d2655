"""Command line: ``data``, ``ml`` and ``run-all`` from one YAML file; the exit code tells success."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from ledgerloom.operators.features import FeatureConfig
from ledgerloom.operators.quality import Rule
from ledgerloom.operators.resolve import MatchConfig
from ledgerloom.operators.tracking import Tracker
from ledgerloom.operators.training import TrainConfig
from ledgerloom.plans.pipeline import IngestionConfig, IngestionPipeline, MLConfig, MLPipeline
from ledgerloom.sources.config import create_spark_session, load_config, setup_logging
from ledgerloom.sources.loader import SourceConfig
from ledgerloom.sources.registry import Registry


def ingestion_config(config: dict) -> IngestionConfig:
    own, rules = config["sources"], config.get("data_quality", {})
    return IngestionConfig(
        SourceConfig(name="source1", **own["source1"]), SourceConfig(name="source2", **own["source2"]),
        Rule.parse(rules.get("source1", {})), Rule.parse(rules.get("source2", {})), float(rules.get("error_threshold", 0.05)),
        MatchConfig(**config.get("matching", {})), checkpoint_dir=config.get("checkpoint_dir"),
    )


def ml_config(config: dict) -> MLConfig:
    own = config.get("ml", {})
    picked = {k: tuple(v) if isinstance(v, list) else tuple(v.items()) if isinstance(v, dict) else v for k, v in own.get("features", {}).items()}
    return MLConfig(FeatureConfig(**picked), TrainConfig(**own.get("training", {})), model_name=own.get("model_name", "registry_classifier"), checkpoint_dir=config.get("checkpoint_dir"))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerloom")
    parser.add_argument("run", choices=("data", "ml", "run-all"))
    parser.add_argument("--config", required=True)
    parser.add_argument("--skip-adverse-media", action="store_true")
    parser.add_argument("--optimize", action="store_true")
    parser.add_argument("--query", help="print registry rows under this predicate, and do nothing else")
    parser.add_argument("--train-only", action="store_true")
    parser.add_argument("--skip-validation", action="store_true")
    parser.add_argument("--resume", action="store_true")
    args = parser.parse_args(argv)
    config = load_config(args.config)
    log, spark = setup_logging(config), create_spark_session(config)
    registry = Registry(spark, config["registry"]["path"])
    if args.query:
        registry.query(args.query, 100).show(truncate=False)
        return 0
    results = []
    if args.run in ("data", "run-all"):
        results.append(IngestionPipeline(spark, ingestion_config(config), registry).run(not args.skip_adverse_media, args.optimize))
    if args.run in ("ml", "run-all") and all(r.success for r in results):
        tracker = Tracker(config.get("tracking", {}).get("path", "tracking"))
        results.append(MLPipeline(spark, ml_config(config), registry, tracker).run(None, args.train_only, args.skip_validation, args.resume))
    for r in results:
        log.info(json.dumps(asdict(r), default=str))
    return 0 if all(r.success for r in results) else 1


if __name__ == "__main__":
    sys.exit(main())
