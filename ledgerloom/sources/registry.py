"""A versioned table: immutable Parquet files, a list of files for each snapshot, and manifests that name the snapshots.

A commit adds files and drops others from the list: an append writes its rows only; a merge and an update rewrite
the files that hold a matched key, found by a join of the keys with the table's key column; the other files
stay as they are. It then creates the next manifest with exclusive create; of two writers one loses, reads again
and retries. All file work goes through Hadoop's file system, so any store that Spark reads will do. Readers get
plain Parquet: pushdown and pruning stay intact.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.plans.scratch import settle

_S, _A, _TS = T.StringType(), T.ArrayType(T.StringType()), T.TimestampType()
REGISTRY = T.StructType(
    [T.StructField("corporate_id", _S, False)]
    + [T.StructField(c, _S) for c in ("corporate_name_S1", "corporate_name_S2", "corporate_name_clean", "address", "address_clean", "country", "country_clean", "postal_code", "postal_code_clean", "industry_sector")]
    + [T.StructField(c, _A) for c in ("activity_places", "top_suppliers", "main_customers")]
    + [T.StructField("revenue", T.DoubleType()), T.StructField("profit", T.DoubleType()), T.StructField("fiscal_year", T.IntegerType())]
    + [T.StructField("adverse_media_summary", _S), T.StructField("adverse_media_last_checked", _TS), T.StructField("risk_score", T.DoubleType()), T.StructField("has_adverse_media", T.BooleanType()), T.StructField("keywords_found", _A)]
    + [T.StructField("_source_system", _A), T.StructField("sources", _A), T.StructField("_load_timestamp", _TS), T.StructField("blocking_keys", _A), T.StructField("temp_id_S1_list", _A), T.StructField("temp_id_S2_list", _A)]
    + [T.StructField("created_at", _TS, False), T.StructField("updated_at", _TS, False)]
)
RISK_COLUMNS = ("adverse_media_summary", "adverse_media_last_checked", "risk_score", "has_adverse_media", "keywords_found")


def _name_of(path: str) -> str:
    """What names a file within the table: its place below the data folder."""
    return path.rsplit("/data/", 1)[-1]


class Conflict(RuntimeError):
    """Another writer made the manifest first, time after time."""


class Registry:
    """``key`` names a row; ``schema`` is fixed. ``partition_day`` names the timestamp whose day parts the files."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = REGISTRY, key: str = "corporate_id", partition_day: str | None = "created_at", clock: Callable[[], float] = time.time):
        self.spark, self.path, self.schema, self.key, self.day, self.clock = spark, path.rstrip("/"), schema, key, partition_day, clock

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _listed(self, path: str) -> list:
        fs, p = self._fs(path)
        return list(fs.listStatus(p)) if fs.exists(p) else []

    def _read(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _create(self, path: str, text: str) -> bool:
        """False if the file is there already."""
        fs, p = self._fs(path)
        try:
            stream = fs.create(p, False)
        except Exception as e:
            if "exists" in str(e).lower():
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def exists(self) -> bool:
        return bool(self._versions())

    def _versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._listed(f"{self.path}/metadata")]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self) -> dict:
        versions = self._versions()
        if not versions:
            raise ValueError(f"no table at {self.path}")
        return json.loads(self._read(f"{self.path}/metadata/v{versions[-1]}.json"))

    def create_if_missing(self) -> None:
        if not self.exists():
            self._create(f"{self.path}/metadata/v0.json", json.dumps({"version": 0, "snapshots": []}))

    def tables(self) -> list[str]:
        """Names of the tables beside this one."""
        parent = self.path.rsplit("/", 1)[0]
        return sorted(s.getPath().getName() for s in self._listed(parent) if self._listed(f"{s.getPath()}/metadata"))

    def _read_files(self, entries: list[dict]) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[e["path"] for e in entries])

    def _write(self, df: DataFrame, target: str, buckets: int | None = None) -> list[dict]:
        """Writes rows to a new folder, ``buckets`` files a day; returns its files with their bytes and rows."""
        out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        deal = F.pmod(F.xxhash64(self.key), F.lit(buckets or max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))))
        if self.day:
            out = out.withColumn("_day", F.to_date(self.day)).repartition("_day", deal).sortWithinPartitions("_day", self.key)
            out.write.partitionBy("_day").parquet(target)
        else:
            (out.repartition(buckets, self.key) if buckets else out).sortWithinPartitions(self.key).write.parquet(target)
        found, folders = [], [target]
        while folders:
            for s in self._listed(folders.pop()):
                if s.isDirectory():
                    folders.append(str(s.getPath()))
                elif s.getPath().getName().endswith(".parquet"):
                    found.append({"path": str(s.getPath()), "bytes": int(s.getLen())})
        if not found:
            return []
        counts = self._placed(self._read_files(found))
        return sorted(({**f, "rows": counts.get(_name_of(f["path"]), 0)} for f in found), key=lambda f: f["path"])

    def _placed(self, rows: DataFrame) -> dict[str, int]:
        """By file, how many of the rows; a file is a row here, so the driver gets as many as the table has files."""
        name = F.regexp_extract("_metadata.file_path", "/data/([^?]*)$", 1)
        return {r["f"]: r["n"] for r in rows.groupBy(name.alias("f")).agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}

    def _touched(self, entries: list[dict], source: DataFrame) -> tuple[list[dict], list[dict]]:
        """Files that hold a key of ``source``, and the others."""
        if not entries:
            return [], []
        name = F.regexp_extract("_metadata.file_path", "/data/([^?]*)$", 1)
        here = self._read_files(entries).select(F.col(self.key).alias("_key"), name.alias("f"))
        hit = {r["f"] for r in here.join(source.select(F.col(self.key).alias("_key")), "_key", "left_semi").select("f").distinct().toLocalIterator()}
        return [e for e in entries if _name_of(e["path"]) in hit], [e for e in entries if _name_of(e["path"]) not in hit]

    def entries(self, snapshot: dict) -> list[dict]:
        """Path, bytes and rows of each file of a snapshot."""
        return json.loads(self._read(f"{self.path}/metadata/files-{snapshot['list']}.json"))

    def _commit(self, change: Callable[[list[dict]], tuple[list[dict], DataFrame | None, int | None]], operation: str, attempts: int = 5) -> int:
        """``change`` gets the current files and gives those that stay, the rows to write, and files a day; after a lost race it is asked again."""
        self.create_if_missing()
        for _ in range(attempts):
            seen = self.manifest()
            now = seen["snapshots"][-1] if seen["snapshots"] else None
            at = max(self.clock(), (now["committed_at"] + 1e-3) if now else 0)
            snapshot = max(int(at * 1000), (now["snapshot_id"] + 1) if now else 0)
            own = f"{snapshot}-{uuid.uuid4().hex[:12]}"
            kept, rows, buckets = change(self.entries(now) if now else [])
            files = [*kept, *(self._write(rows, f"{self.path}/data/{own}", buckets) if rows is not None else [])]
            self._create(f"{self.path}/metadata/files-{own}.json", json.dumps(files))
            entry = {"snapshot_id": snapshot, "parent_id": now["snapshot_id"] if now else None, "committed_at": at, "operation": operation, "record_count": sum(f["rows"] for f in files), "file_count": len(files), "bytes": sum(f["bytes"] for f in files), "list": own}
            text = json.dumps({"version": seen["version"] + 1, "snapshots": [*seen["snapshots"], entry]})
            if self._create(f"{self.path}/metadata/v{seen['version'] + 1}.json", text):
                return snapshot
            self._drop(f"{self.path}/data/{own}")
            self._drop(f"{self.path}/metadata/files-{own}.json")
        raise Conflict(f"{attempts} commits to {self.path} lost against other writers")

    def commit(self, build: Callable[[DataFrame | None], DataFrame], operation: str, attempts: int = 5) -> int:
        """Write what ``build`` makes of all current rows; after a lost race build again on the winner's."""
        return self._commit(lambda files: ([], build(self._read_files(files) if files else None), None), operation, attempts)

    def _drop(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def at(self, snapshot_id: int | None = None, timestamp: float | datetime | None = None) -> DataFrame:
        """Rows now, of a snapshot, or of the latest snapshot up to a time; the id wins."""
        shots = self.manifest()["snapshots"]
        if snapshot_id is not None:
            shots = [s for s in shots if s["snapshot_id"] == snapshot_id]
        elif timestamp is not None:
            t = timestamp.replace(tzinfo=timestamp.tzinfo or timezone.utc).timestamp() if isinstance(timestamp, datetime) else timestamp
            shots = [s for s in shots if s["committed_at"] <= t]
        if not shots:
            raise ValueError("no such snapshot")
        return self._read_files(self.entries(shots[-1])).select(*self.schema.names)

    def time_travel(self, snapshot_id: int | None = None, timestamp=None) -> DataFrame:
        if snapshot_id is None and timestamp is None:
            raise ValueError("give a snapshot_id or a timestamp")
        return self.at(snapshot_id, timestamp)

    def query(self, filter_condition: str | None = None, limit: int | None = None) -> DataFrame:
        """Rows under a SQL predicate; with a limit, the least by key."""
        df = self.at()
        df = df.where(F.expr(filter_condition)) if filter_condition else df
        return df.orderBy(self.key).limit(limit) if limit else df

    def append(self, df: DataFrame) -> int:
        """Adds the rows in files of their own; what is there is not read."""
        stamped = self._stamped(df)
        return self._commit(lambda files: (files, stamped, None), "append")

    def _stamped(self, df: DataFrame) -> DataFrame:
        now = F.lit(datetime.fromtimestamp(self.clock(), timezone.utc).replace(tzinfo=None).isoformat(" ")).cast("timestamp")
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in self.schema if f.name not in df.columns})
        return df.withColumns({c: now for c in ("created_at", "updated_at") if c in self.schema.names}).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])

    def upsert(self, df: DataFrame) -> int:
        """Merge by key: values of the source where not null, else those there; new keys are inserted whole."""
        source = settle(self._stamped(df))
        if not source.groupBy(self.key).count().where("count > 1").isEmpty():
            raise ValueError(f"several source rows share a {self.key}")

        def change(files: list[dict]):
            touched, kept = self._touched(files, source)
            return kept, merge(self._read_files(touched), source, self.key, self.schema.names) if touched else source, None

        return self._commit(change, "merge")

    def replace(self, df: DataFrame, retired: DataFrame) -> int:
        """Rows of ``df`` take all its columns, null or not, and keep the others; keys of ``retired`` go. One commit."""
        source, columns = settle(self._stamped(df)), {*df.columns, "updated_at"}
        keys = source.select(self.key).union(retired.select(self.key))

        def change(files: list[dict]):
            touched, kept = self._touched(files, keys)
            if not touched:
                return kept, source, None
            t, s = self._read_files(touched).join(retired.select(self.key), self.key, "left_anti").alias("t"), source.alias("s")
            there = F.col(f"s.{self.key}").isNotNull()
            pick = lambda c: F.when(there, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in columns else F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
            return kept, t.join(s, F.col(f"t.{self.key}") == F.col(f"s.{self.key}"), "full_outer").select(*[pick(c).alias(c) for c in self.schema.names]), None

        return self._commit(change, "replace")

    def update_matched(self, df: DataFrame, columns=RISK_COLUMNS) -> int:
        """Only rows whose key is there; the given columns take the source's values."""
        source = settle(self._stamped(df))

        def change(files: list[dict]):
            touched, kept = self._touched(files, source)
            return kept, update_only(self._read_files(touched), source, self.key, self.schema.names, columns) if touched else None, None

        return self._commit(change, "update")

    def compact(self, target_bytes: int = 128 << 20) -> int:
        """Rewrites the files under half of ``target_bytes`` into files of about that size, day by day."""

        def change(files: list[dict]):
            small = [f for f in files if 2 * f["bytes"] < target_bytes]
            by_day: dict[str, list[dict]] = {}
            for f in small:
                by_day.setdefault(f["path"].split("/_day=")[-1].split("/")[0] if self.day else "", []).append(f)
            wanted = [f for own in by_day.values() if len(own) > 1 for f in own]
            if not wanted:
                return files, None, None
            names = {f["path"] for f in wanted}
            most = max(sum(f["bytes"] for f in own) for own in by_day.values() if len(own) > 1)
            return [f for f in files if f["path"] not in names], self._read_files(wanted), math.ceil(most / target_bytes)

        return self._commit(change, "replace")

    def expire(self, older_than_days: float = 7.0) -> int:
        """Forget snapshots older than that, never the current one, and delete their files; returns how many."""
        seen = self.manifest()
        limit = self.clock() - older_than_days * 86400
        old = [s for s in seen["snapshots"][:-1] if s["committed_at"] < limit]
        if old:
            kept = [s for s in seen["snapshots"] if s not in old]
            if not self._create(f"{self.path}/metadata/v{seen['version'] + 1}.json", json.dumps({"version": seen["version"] + 1, "snapshots": kept})):
                raise Conflict("the table changed meanwhile")
            held = {f["path"] for s in kept for f in self.entries(s)}
            for path in {f["path"] for s in old for f in self.entries(s)} - held:
                self._drop(path)
            for s in old:
                self._drop(f"{self.path}/metadata/files-{s['list']}.json")
        return len(old)

    def snapshots(self) -> DataFrame:
        rows = [(s["snapshot_id"], s["parent_id"], datetime.fromtimestamp(s["committed_at"], timezone.utc), s["operation"], s["record_count"], s["file_count"]) for s in self.manifest()["snapshots"]]
        return self.spark.createDataFrame(rows, "snapshot_id long, parent_id long, committed_at timestamp, operation string, record_count long, file_count int")

    def files(self) -> DataFrame:
        shots = self.manifest()["snapshots"]
        rows = [(f["path"], f["bytes"]) for f in (self.entries(shots[-1]) if shots else [])]
        return self.spark.createDataFrame(rows, "path string, bytes long")

    def statistics(self) -> dict:
        shots = self.manifest()["snapshots"]
        last = shots[-1] if shots else {"record_count": 0, "file_count": 0, "bytes": 0, "snapshot_id": None}
        latest = [s["snapshot_id"] for s in sorted(shots, key=lambda s: -s["committed_at"])[:5]]
        return {"row_count": last["record_count"], "snapshot_count": len(shots), "latest_snapshots": latest, "latest_snapshot": last["snapshot_id"], "file_count": last["file_count"], "total_size_mb": last["bytes"] / 1e6}


def merge(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Full outer join by key; per column the source's value if not null, but ``created_at`` stays."""
    t, s = target.alias("t"), source.alias("s")
    pick = lambda c: F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")) if c == "created_at" else F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}"))
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").select(*[pick(c).alias(c) for c in columns])


def update_only(target: DataFrame, source: DataFrame, key: str, columns: list[str], updated) -> DataFrame:
    """Left join by key; matched rows take the ``updated`` columns, and ``updated_at``, of the source."""
    t, s = target.alias("t"), source.alias("s")
    own = {*updated, "updated_at"}
    pick = lambda c: F.when(F.col(f"s.{key}").isNotNull(), F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}"))).otherwise(F.col(f"t.{c}")) if c in own else F.col(f"t.{c}")
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "left").select(*[pick(c).alias(c) for c in columns])
