"""Timers, metrics and stage checkpoints of a run, as plain JSON and Prometheus text."""

from __future__ import annotations

import json
import time
from contextlib import contextmanager
from pathlib import Path


class Metrics:
    """Wall-clock timers by name (a context manager, or start and stop) and recorded values."""

    def __init__(self):
        self.durations: dict[str, float] = {}
        self.values: dict[str, object] = {}
        self._open: dict[str, float] = {}

    def start_timer(self, name: str) -> None:
        self._open[name] = time.monotonic()

    def stop_timer(self, name: str) -> float:
        self.durations[name] = time.monotonic() - self._open.pop(name)
        return self.durations[name]

    @contextmanager
    def timer(self, name: str):
        self.start_timer(name)
        try:
            yield
        finally:
            self.stop_timer(name)

    def record_metric(self, name: str, value) -> None:
        self.values[name] = value

    def export_metrics_to_dict(self) -> dict:
        """Total duration is that of the outermost timers named ``total_*``, else the sum."""
        totals = [v for k, v in self.durations.items() if k.startswith("total_")]
        return {"durations": dict(self.durations), "metrics": dict(self.values), "total_duration": max(totals) if totals else sum(self.durations.values())}

    def save_metrics_to_file(self, path: str) -> None:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(json.dumps(self.export_metrics_to_dict(), default=str))

    def prometheus(self) -> str:
        lines = [f'ledgerloom_duration_seconds{{stage="{k}"}} {v}' for k, v in sorted(self.durations.items())]
        return "\n".join([*lines, *[f"ledgerloom_{k} {v}" for k, v in sorted(self.values.items()) if isinstance(v, int | float)]]) + "\n"


class Checkpoints:
    """JSON per stage and moment; the newest one resumes a run."""

    def __init__(self, folder: str, enabled: bool = True):
        self.folder, self.enabled = Path(folder), enabled

    def save_checkpoint(self, stage: str, data: dict) -> None:
        if self.enabled:
            self.folder.mkdir(parents=True, exist_ok=True)
            (self.folder / f"{stage}__{time.time_ns():020d}.json").write_text(json.dumps({"stage": stage, "at": time.time(), "data": data}, default=str))

    def list_checkpoints(self, stage: str | None = None) -> list[str]:
        """Newest first."""
        return sorted((str(p) for p in self.folder.glob(f"{stage or '*'}__*.json")), key=lambda p: p.rsplit("__", 1)[1], reverse=True)

    def load_latest_checkpoint(self, stage: str) -> dict | None:
        found = self.list_checkpoints(stage)
        return json.loads(Path(found[0]).read_text())["data"] if found else None

    def cleanup_old_checkpoints(self, keep_last_n: int = 5) -> int:
        """Keep the newest of each stage; other files in the folder are left alone."""
        gone = 0
        for stage in {Path(p).name.rsplit("__", 1)[0] for p in self.list_checkpoints()}:
            for p in self.list_checkpoints(stage)[keep_last_n:]:
                Path(p).unlink()
                gone += 1
        return gone
