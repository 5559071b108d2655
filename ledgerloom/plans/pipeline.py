"""The two runs: ingestion (load, check, resolve, enrich, merge) and training (split, features, fit, gate, register)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import features, resolve, risk, training
from ledgerloom.operators.quality import Rule, apart, judged, observed, observed_report
from ledgerloom.operators.tracking import Tracker
from ledgerloom.plans.metrics import Checkpoints, Metrics
from ledgerloom.plans.scratch import settle, shared_dir
from ledgerloom.plans.stages import Stages
from ledgerloom.sources.loader import FINANCIALS, SUPPLY_CHAIN, SourceConfig, load_source
from ledgerloom.sources.registry import Registry


@dataclass
class Result:
    success: bool
    stage: str
    error: str | None = None
    counts: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)


@dataclass
class IngestionConfig:
    source1: SourceConfig
    source2: SourceConfig
    rules1: list[Rule] = field(default_factory=list)
    rules2: list[Rule] = field(default_factory=list)
    error_threshold: float = 0.05
    matching: resolve.MatchConfig = field(default_factory=resolve.MatchConfig)
    risk: risk.RiskConfig = field(default_factory=risk.RiskConfig)
    adverse_media_limit: int | None = None  # None: every entity that has no finding yet
    checkpoint_dir: str | None = None
    stage_dir: str | None = None  # where stages keep their tables for a resumed run; by default in the shared folder


_REPORT = "field string, kind string, rows long, errors long"


class IngestionPipeline:
    def __init__(self, spark: SparkSession, cfg: IngestionConfig, registry: Registry, scorer: risk.Scorer = risk.keyword_scorer, context: Callable[[DataFrame], DataFrame] | None = None):
        """``context`` adds a text column ``context`` for the scorer to entities; by default the prompt."""
        self.spark, self.cfg, self.registry, self.scorer, self.context = spark, cfg, registry, scorer, context
        self.metrics = Metrics()
        self.checkpoints = Checkpoints(cfg.checkpoint_dir or "", enabled=cfg.checkpoint_dir is not None)
        self.stages: Stages | None = None

    def _loaded(self, name: str, source: SourceConfig, want, rules: list[Rule]) -> tuple[DataFrame, list[dict]]:
        """A source's table and its report: the rules are counted while the table is written."""
        seen: list = []
        session = apart(self.spark)

        def build() -> DataFrame:
            df, observation, _ = observed(load_source(session, source, want), rules, f"{name}-quality") if rules else (load_source(session, source, want), None, [])
            seen.append(observation)
            return df

        files = self.stages.files(source.path)
        table = self.stages.run(name, build, settings=(source, files))
        if not rules:
            return table, []

        def report() -> DataFrame:
            # A table of an earlier run is counted as it is: its rules may be others than these.
            observation = seen[0] if seen else None
            if observation is None:
                counted, observation, _ = observed(session.read.parquet(self.stages.path(name)), rules, f"{name}-again")
                counted.write.format("noop").mode("overwrite").save()
            return self.spark.createDataFrame(observed_report(observation, rules, table.columns, table), _REPORT)

        return table, [r.asDict() for r in self.stages.run(f"{name}_report", report, [name], (rules,)).collect()]

    def _enriched(self, entities: DataFrame, run: bool) -> DataFrame:
        if not run:
            return risk.without_findings(entities)
        asked_for = entities
        if self.registry.exists() and self.registry.manifest()["snapshots"]:
            known = self.registry.at().where("adverse_media_last_checked is not null").select("corporate_id")
            asked_for = entities.join(known, "corporate_id", "left_anti")
        if self.cfg.adverse_media_limit is not None:
            asked_for = asked_for.orderBy("corporate_id").limit(self.cfg.adverse_media_limit)
        named = asked_for.selectExpr("corporate_id", "coalesce(corporate_name_S1, corporate_name_S2) as corporate_name", "country", "industry_sector")
        # The prompt lists the keywords, so the keyword scorer reads what is known of the entity instead.
        known_text = F.concat_ws(" ", "corporate_name", "country", "industry_sector")
        prompt = risk.prompt(named["corporate_name"], named["country"], named["industry_sector"], self.cfg.risk.keywords)
        asked = self.context(named) if self.context else named.withColumn("context", known_text if self.scorer is risk.keyword_scorer else prompt)
        return risk.attach(entities, settle(risk.analyse(asked, self.scorer, self.cfg.risk)))

    def run(self, run_adverse_media: bool = True, optimize_table: bool = False, resume_from_checkpoint: bool = False) -> Result:
        """One ingestion. With ``resume_from_checkpoint``, stages whose inputs and settings are those of an earlier run read its tables."""
        cfg, stage, counts = self.cfg, "start", {}
        self.stages = Stages(self.spark, cfg.stage_dir or f"{shared_dir(self.spark)}/ledgerloom/stages", resume_from_checkpoint)
        self.metrics.start_timer("total_data_pipeline")
        try:
            stage = "load"
            with self.metrics.timer("data_loading"):
                self.registry.create_if_missing()
                s1, found1 = self._loaded("source1", cfg.source1, SUPPLY_CHAIN, cfg.rules1)
                s2, found2 = self._loaded("source2", cfg.source2, FINANCIALS, cfg.rules2)
            stage = "data_quality"
            with self.metrics.timer("data_quality"):
                for found, rules, name in ((found1, cfg.rules1, "source1"), (found2, cfg.rules2, "source2")):
                    if rules:
                        counts[f"{name}_errors"] = sum(r["errors"] for r in found)
                        if not judged(found, cfg.error_threshold):
                            return Result(False, stage, f"{name} failed its data-quality rules", counts, self.metrics.export_metrics_to_dict())
            self.checkpoints.save_checkpoint(stage, counts)
            stage = "entity_resolution"
            with self.metrics.timer("entity_resolution"):
                entities = self.stages.run("entities", lambda: resolve.resolve_entities(s1, s2, cfg.matching), ["source1", "source2"], cfg.matching)
                counts["entities"] = entities.count()
            self.checkpoints.save_checkpoint(stage, counts)
            stage = "adverse_media"
            with self.metrics.timer("adverse_media"):
                # What was asked for depends on the registry's findings, so a run that got no further than this asks again.
                enriched = self._enriched(entities, run_adverse_media)
                if run_adverse_media:
                    enriched = settle(enriched)
                    counts["adverse_entities"] = risk.adverse(enriched).count()
            stage = "upsert"
            with self.metrics.timer("registry_upsert"):
                counts["snapshot_id"] = self.registry.upsert(enriched)
                if optimize_table:
                    self.registry.compact()
            counts |= {k: v for k, v in self.registry.statistics().items() if k in ("row_count", "file_count")}
            self.checkpoints.save_checkpoint(stage, counts)
            return Result(True, "done", None, counts, self.metrics.export_metrics_to_dict())
        except Exception as e:
            return Result(False, stage, f"{type(e).__name__}: {e}"[:2000], counts, self.metrics.export_metrics_to_dict())
        finally:
            self.metrics.stop_timer("total_data_pipeline")

    def query_registry(self, filter_condition: str | None = None, limit: int = 100) -> DataFrame:
        return self.registry.query(filter_condition, limit)


@dataclass
class MLConfig:
    features: features.FeatureConfig = field(default_factory=features.FeatureConfig)
    training: training.TrainConfig = field(default_factory=training.TrainConfig)
    key: str = "corporate_id"
    split: tuple[float, float, float] = (0.7, 0.1, 0.2)
    stratify: bool = True
    min_records: int = 1
    model_name: str = "registry_classifier"
    auto_promote: bool = False
    require_approval: bool = True
    checkpoint_dir: str | None = None
    model_dir: str | None = None  # a folder that the cluster shares: the model, its summary and a sample of its rows


class MLPipeline:
    def __init__(self, spark: SparkSession, cfg: MLConfig, registry: Registry | None, tracker: Tracker):
        self.spark, self.cfg, self.registry, self.tracker = spark, cfg, registry, tracker
        self.metrics = Metrics()
        self.checkpoints = Checkpoints(cfg.checkpoint_dir or "", enabled=cfg.checkpoint_dir is not None)

    def run(self, rows: DataFrame | None = None, train_only: bool = False, skip_validation: bool = False, resume_from_checkpoint: bool = False) -> Result:
        cfg, stage, counts = self.cfg, "start", {}
        if resume_from_checkpoint and (done := self.checkpoints.load_latest_checkpoint("registered")):
            return Result(True, "resumed", None, done)
        self.metrics.start_timer("total_ml_pipeline")
        self.tracker.start_run(cfg.model_name)
        status = "FAILED"
        try:
            self.tracker.log_config({"features": vars(cfg.features), "training": vars(cfg.training)})
            stage = "load"
            data = rows if rows is not None else self.registry.at()
            if data.limit(cfg.min_records + 1).count() < cfg.min_records:
                raise ValueError(f"fewer than {cfg.min_records} records")
            stage = "features"
            ready = settle(features.prepare(features.valid_records(data), cfg.features))
            parts = features.split(ready, cfg.key, cfg.split, cfg.training.seed, cfg.features.target if cfg.stratify else None)
            counts |= {n: p.count() for n, p in zip(("train", "validation", "test"), parts, strict=True)}
            self.tracker.log_dataset_info(parts[0], "train", cfg.features.target)
            stage = "train"
            with self.metrics.timer("model_training"):
                model, summary = training.train(features.stages(parts[0], cfg.features), parts[0], cfg.training, parts[1] if counts["validation"] else None)
            self.tracker.log_metrics({"train_rows": summary["train_rows"], "seconds": summary["seconds"]})
            metrics: dict = {}
            if not train_only and counts["test"]:
                stage = "evaluate"
                metrics = training.evaluate(model, parts[2], cfg.features.target)
                self.tracker.log_metrics(metrics, "test_")
                self.tracker.log_confusion_matrix(metrics["confusion"])
                passed, failures = (True, []) if skip_validation else training.check_gates(metrics, cfg.training.gates)
                counts["gates"] = failures or "passed"
                if not passed:
                    return Result(False, "gates", "; ".join(failures), counts, metrics)
            stage = "register"
            if cfg.model_dir is not None:
                training.save_model(model, f"{cfg.model_dir.rstrip('/')}/{cfg.model_name}", summary, features.bottom_k(parts[0], cfg.key))
            self.tracker.log_feature_importance(training.feature_importance(model))
            self.tracker.log_model(model)
            counts["version"] = self.tracker.register_model(cfg.model_name, {k: v for k, v in metrics.items() if k != "confusion"}, cfg.training.gates.get("min_accuracy", 0.0), cfg.auto_promote, cfg.require_approval)["version"]
            self.checkpoints.save_checkpoint("registered", counts)
            status = "FINISHED"
            return Result(True, "done", None, counts, metrics)
        except Exception as e:
            return Result(False, stage, f"{type(e).__name__}: {e}"[:2000], counts)
        finally:
            self.metrics.stop_timer("total_ml_pipeline")
            self.tracker.end_run(status)

    def load_production_model(self):
        return self.tracker.load_model(self.cfg.model_name)

    def predict(self, rows: DataFrame, version: int | None = None, stage: str | None = None) -> DataFrame:
        """Raw records go through the same preparation as training rows."""
        model = self.tracker.load_model(self.cfg.model_name, version, stage)
        return training.predict(model, features.prepare(rows, self.cfg.features))

    def get_pipeline_metrics(self) -> dict:
        return self.metrics.export_metrics_to_dict()
