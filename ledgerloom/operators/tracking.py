"""Runs and model versions as files: JSON per run and per model, in a folder."""

from __future__ import annotations

import json
import time
import uuid
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.config import flatten


class Tracker:
    """One folder: ``runs/<id>.json``, ``models/<name>.json``, ``artifacts/<run>/...``."""

    def __init__(self, root: str):
        self.root = Path(root)
        for d in ("runs", "models", "artifacts"):
            (self.root / d).mkdir(parents=True, exist_ok=True)
        self.run: dict | None = None

    def _save(self) -> None:
        (self.root / "runs" / f"{self.run['run_id']}.json").write_text(json.dumps(self.run))

    def start_run(self, name: str = "run") -> str:
        self.run = {"run_id": uuid.uuid4().hex, "name": name, "status": "RUNNING", "started": time.time(), "params": {}, "metrics": {}, "artifacts": []}
        self._save()
        return self.run["run_id"]

    def log_config(self, config: dict) -> None:
        self.run["params"] |= flatten(config)
        self._save()

    def log_metrics(self, metrics: dict, prefix: str = "") -> None:
        self.run["metrics"] |= {f"{prefix}{k}": float(v) for k, v in metrics.items() if isinstance(v, int | float)}
        self._save()

    def log_table(self, name: str, rows: list) -> None:
        folder = self.root / "artifacts" / self.run["run_id"]
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.json").write_text(json.dumps(rows))
        self.run["artifacts"].append(name)
        self._save()

    def log_dataset_info(self, df: DataFrame, name: str, target: str | None = None) -> dict:
        counts = {str(r[0]): r[1] for r in df.groupBy(target).agg(F.count(F.lit(1))).collect()} if target else {}
        info = {"rows": sum(counts.values()) if target else df.count(), "columns": len(df.columns), "classes": counts}
        self.log_table(f"dataset_{name}", [info])
        return info

    def log_feature_importance(self, importance: list) -> None:
        self.log_table("feature_importance", importance)

    def log_confusion_matrix(self, confusion: dict) -> None:
        self.log_table("confusion_matrix", [confusion])

    def log_model(self, model: PipelineModel) -> str:
        path = str(self.root / "artifacts" / self.run["run_id"] / "model")
        model.write().overwrite().save(path)
        self.run["model"] = path
        self._save()
        return path

    def end_run(self, status: str = "FINISHED") -> None:
        if self.run:
            self.run |= {"status": status, "ended": time.time()}
            self._save()
            self.run = None

    def _versions(self, name: str) -> list[dict]:
        f = self.root / "models" / f"{name}.json"
        return json.loads(f.read_text()) if f.exists() else []

    def register_model(self, name: str, metrics: dict, min_accuracy: float = 0.0, auto_promote: bool = False, require_approval: bool = True) -> dict:
        """A new version in Staging; in Production at once only where that is asked, allowed and earned."""
        versions = self._versions(name)
        entry = {"version": len(versions) + 1, "path": self.run["model"], "run_id": self.run["run_id"], "metrics": metrics, "stage": "Staging"}
        versions.append(entry)
        (self.root / "models" / f"{name}.json").write_text(json.dumps(versions))
        if auto_promote and not require_approval and metrics.get("accuracy", 0.0) >= min_accuracy:
            self.promote(name, entry["version"])
            entry = self._versions(name)[-1]
        return entry

    def promote(self, name: str, version: int, stage: str = "Production") -> None:
        versions = self._versions(name)
        for v in versions:
            if v["version"] == version:
                v["stage"] = stage
            elif v["stage"] == stage:
                v["stage"] = "Archived"
        (self.root / "models" / f"{name}.json").write_text(json.dumps(versions))

    def load_model(self, name: str, version: int | None = None, stage: str | None = None) -> PipelineModel:
        """The version asked for; else the newest of the stage, by default Production."""
        own = [v for v in self._versions(name) if (v["version"] == version if version is not None else v["stage"] == (stage or "Production"))]
        if not own:
            raise ValueError(f"no model {name} with version {version} or stage {stage or 'Production'}")
        return PipelineModel.load(own[-1]["path"])

    def compare_models(self, spark: SparkSession, run_ids: list[str]) -> DataFrame:
        """(run_id, kind, name, value) of the runs' metrics and parameters."""
        rows = []
        for i in run_ids:
            run = json.loads((self.root / "runs" / f"{i}.json").read_text())
            rows += [(i, kind, k, str(v)) for kind in ("metrics", "params") for k, v in run[kind].items()]
        return spark.createDataFrame(rows, "run_id string, kind string, name string, value string")
