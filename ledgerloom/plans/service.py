"""The seven service calls as plain functions, and a small HTTP front that maps paths to them."""

from __future__ import annotations

import json
from dataclasses import asdict
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.functions.text import rows_as_json, sanitize
from ledgerloom.plans.pipeline import IngestionPipeline, MLPipeline
from ledgerloom.sources.registry import Registry

def as_records(df: DataFrame, limit: int | None = None) -> list[dict]:
    """All rows, or ``limit`` of them, as dicts, read one partition at a time; NaN as null, null fields left out."""
    clean = sanitize(df if limit is None else df.limit(limit))
    return [json.loads(r[0]) for r in clean.select(rows_as_json(clean)).toLocalIterator()]


class Service:
    def __init__(self, spark: SparkSession, registry: Registry, ml: MLPipeline | None = None, ingestion: IngestionPipeline | None = None, record_schema: T.StructType | None = None):
        self.spark, self.registry, self.ml, self.ingestion, self.record_schema = spark, registry, ml, ingestion, record_schema

    def health(self) -> dict:
        return {"status": "ok"}

    def query(self, filter_condition: str | None = None, limit: int = 100) -> list[dict]:
        if not isinstance(filter_condition, str | None) or not isinstance(limit, int):
            raise ValueError("filter_condition is a text and limit a number")
        return as_records(self.registry.query(filter_condition, limit), limit)

    def stats(self) -> dict:
        return self.registry.statistics()

    def time_travel(self, snapshot_id: int | None = None, timestamp: float | None = None, limit: int | None = None) -> list[dict]:
        return as_records(self.registry.time_travel(snapshot_id, timestamp), limit)

    def predict(self, records: list[dict], stage: str | None = None) -> list[float]:
        schema = self.record_schema or self.registry.schema
        order = T.StructType([*schema, T.StructField("_n", T.LongType())])
        rows = self.spark.createDataFrame([(*[r.get(f.name) for f in schema], k) for k, r in enumerate(records)], T.StructType([T.StructField(f.name, f.dataType, True) for f in order]))
        got = self.ml.predict(rows, stage=stage).select("_n", "prediction").collect()
        return [r["prediction"] for r in sorted(got, key=lambda r: r["_n"])]

    def run_data_pipeline(self, run_adverse_media: bool = True, optimize_table: bool = False) -> dict:
        return asdict(self.ingestion.run(run_adverse_media, optimize_table))

    def run_ml_pipeline(self, train_only: bool = False, skip_validation: bool = False) -> dict:
        return asdict(self.ml.run(train_only=train_only, skip_validation=skip_validation))

    def routes(self) -> dict:
        return {
            ("GET", "/health"): lambda b: self.health(), ("GET", "/iceberg/stats"): lambda b: self.stats(),
            ("POST", "/predict"): lambda b: {"predictions": self.predict(b["records"], b.get("stage"))},
            ("POST", "/iceberg/query"): lambda b: {"rows": self.query(b.get("filter_condition"), b.get("limit", 100))},
            ("POST", "/iceberg/time-travel"): lambda b: {"rows": self.time_travel(b.get("snapshot_id"), b.get("timestamp"))},
            ("POST", "/pipeline/ml/run"): lambda b: self.run_ml_pipeline(**b), ("POST", "/pipeline/data/run"): lambda b: self.run_data_pipeline(**b),
        }

    def handle(self, method: str, path: str, body: dict) -> tuple[int, object]:
        call = self.routes().get((method, path))
        if call is None:
            return 404, {"error": f"no route {method} {path}"}
        try:
            return 200, call(body)
        except (ValueError, KeyError, TypeError, AnalysisException, ParseException) as e:
            return 400, {"error": str(e)}


def serve(service: Service, host: str = "127.0.0.1", port: int = 8000) -> ThreadingHTTPServer:
    """A server that the caller starts with ``serve_forever``."""

    class Handler(BaseHTTPRequestHandler):
        def _answer(self):
            length = int(self.headers.get("Content-Length") or 0)
            try:
                body = json.loads(self.rfile.read(length)) if length else {}
                status, out = service.handle(self.command, self.path, body)
            except ValueError:
                status, out = 400, {"error": "the body is not JSON"}
            data = json.dumps(out, default=str).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = _answer

        def log_message(self, *_):
            pass

    return ThreadingHTTPServer((host, port), Handler)


__all__ = ["Service", "as_records", "serve"]
