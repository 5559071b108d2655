"""Stages of a run that name their written tables, so a run that broke off goes on from the last valid one.

A stage's name carries a fingerprint of all that its rows depend on: its own settings, the fingerprints of the stages it reads, and the names, sizes and
times of source files. A table counts as valid if its writer has finished (``_SUCCESS``); whatever else
lies in the folder is written again. Other settings or files give another name, so a stale table is never read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession


class Stages:
    def __init__(self, spark: SparkSession, folder: str, reuse: bool = True):
        self.spark, self.folder, self.reuse = spark, folder.rstrip("/"), reuse
        self.prints: dict[str, str] = {}
        self.computed: list[str] = []
        self.reused: list[str] = []

    def _status(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def files(self, *paths: str) -> str:
        """A fingerprint of the files that paths (or patterns) lead to."""
        seen = []
        for path in paths:
            fs, p = self._status(path)
            open_ = list(fs.globStatus(p) or ())
            while open_:
                s = open_.pop()
                if s.isDirectory():
                    open_ += list(fs.listStatus(s.getPath()))
                else:
                    seen.append((str(s.getPath()), int(s.getLen()), int(s.getModificationTime())))
        return hashlib.sha256(json.dumps(sorted(seen)).encode()).hexdigest()

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{self.prints[name][:24]}"

    def valid(self, name: str) -> bool:
        fs, p = self._status(f"{self.path(name)}/_SUCCESS")
        return bool(fs.exists(p))

    def run(self, name: str, build: Callable[[], DataFrame], after: Iterable[str] = (), settings: object = None) -> DataFrame:
        """The stage's table: what a run before has written, or what ``build`` gives, written now.

        ``after``: names of the stages it reads. ``settings``: whatever else its rows depend on; its ``repr`` counts.
        """
        text = json.dumps([name, [self.prints[a] for a in after], repr(settings)])
        self.prints[name] = hashlib.sha256(text.encode()).hexdigest()
        if self.reuse and self.valid(name):
            self.reused.append(name)
        else:
            build().write.mode("overwrite").parquet(self.path(name))
            self.computed.append(name)
        return self.spark.read.parquet(self.path(name))

    def drop_others(self) -> int:
        """Deletes tables of the folder that this run neither wrote nor read; returns how many."""
        fs, p = self._status(self.folder)
        kept = {self.path(n).rsplit("/", 1)[-1] for n in self.prints}
        others = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName() not in kept] if fs.exists(p) else []
        return sum(bool(fs.delete(o, True)) for o in others)
