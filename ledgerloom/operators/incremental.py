"""Resolution of new loads against what is stored: only blocks that a load touches are matched, labelled and merged again.

State is a folder of append-only Parquet tables, a subfolder for each load, and the list of loads that are done:

* ``rows_S1``, ``rows_S2``: prepared rows with the key of their compared values; ``gone``: row ids that a later load replaced.
* ``labels``: (block, key, label) of keys on a match, the last load's value holds; null takes a label back.
* ``ids``: (id, corporate_id), the last load's value holds.
* ``entities``: harmonised entities, and with ``retired`` the ids that no row has any more; the last load's row holds.

A load matches its new keys with all keys of their blocks, and the old keys with the new ones: pairs of two old keys were scored before. The
new matches, with ends replaced by their labels, are a graph of labels and new keys; its components say which
labels become one. A label is the least key of its component, so any order of loads ends in the same
labels as all rows at once. As blocks bound components, nothing beyond touched blocks changes its label.

A row whose id comes again replaces the stored one. Matches that hung on the old values may then fall away, so the old row's
block is ``dirty``: all its keys count as new and its labels are made afresh.

A load that runs again under the same number, as a micro-batch does after a failure, overwrites its own subfolders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.components import connected_components
from ledgerloom.operators.resolve import CLEAN, MatchConfig, apply_threshold, fingerprints, matching_candidates, merge_sources, prepare, score_pairs
from ledgerloom.plans.scratch import settle

SIDES = ("S1", "S2")
_NARROW = ("id", "side", "blocking_key", "key", *CLEAN)


@dataclass(frozen=True)
class Delta:
    """What a load changed: entities as they are now, and the ids that are no more."""

    load: int
    entities: DataFrame
    retired: DataFrame


def _key() -> Column:
    """A digest of the source's side and all that is compared; nulls and empty texts differ."""
    return F.concat(F.col("source"), F.lit("#"), F.md5(F.to_json(F.struct("blocking_key", *CLEAN), {"ignoreNullFields": "false"}).cast("binary")))


class Resolution:
    def __init__(self, spark: SparkSession, folder: str, cfg: MatchConfig = MatchConfig()):
        self.spark, self.folder, self.cfg = spark, folder.rstrip("/"), cfg

    def _path(self, table: str, load: int) -> str:
        return f"{self.folder}/{table}/load={load}"

    def _write(self, df: DataFrame, table: str, load: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self._path(table, load))
        return self.spark.read.schema(df.schema).parquet(self._path(table, load))

    def loads(self) -> list[int]:
        """Numbers of the loads that are done."""
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/done")
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(int(s.getPath().getName()[5:]) for s in fs.listStatus(place)) if fs.exists(place) else []

    def _table(self, name: str, loads: list[int]) -> DataFrame | None:
        """Rows of the given loads with their ``load``; columns that only some loads have are null in others."""
        if not loads:
            return None
        reader = self.spark.read.option("basePath", f"{self.folder}/{name}").option("mergeSchema", "true")
        return reader.parquet(*[self._path(name, k) for k in loads])

    @staticmethod
    def _latest(rows: DataFrame | None, key: str, *columns: str) -> DataFrame | None:
        """The last load's values of each key; an aggregate with a map-side half."""
        if rows is None:
            return None
        last = rows.groupBy(key).agg(F.max_by(F.struct(*columns), "load").alias("_last"))
        return last.select(key, "_last.*")

    def rows(self, side: str, loads: list[int] | None = None) -> DataFrame | None:
        """Stored rows that no later load replaced."""
        loads = self.loads() if loads is None else loads
        stored = self._table(f"rows_{side}", loads)
        if stored is None:
            return None
        gone = self._table("gone", loads).select(F.col("id").alias(f"temp_id_{side}"), F.col("old_load").alias("load"))
        return stored.join(gone, [f"temp_id_{side}", "load"], "left_anti")

    def _narrow(self, loads: list[int]) -> DataFrame | None:
        out = None
        for side in SIDES:
            rows = self.rows(side, loads)
            if rows is not None:
                own = rows.select(F.col(f"temp_id_{side}").alias("id"), F.lit(side).alias("side"), *_NARROW[2:], "load")
                out = own if out is None else out.unionByName(own)
        return out

    def _arrived(self, sources: dict[str, DataFrame], keys: dict[str, Column | None], load: int) -> DataFrame:
        """Writes the load's prepared rows; returns their compared columns."""
        out = None
        for side in SIDES:
            source = sources[side]
            rows = prepare(source, side, keys.get(side)).withColumn("key", _key())
            stored = self._write(rows, f"rows_{side}", load)
            own = stored.select(F.col(f"temp_id_{side}").alias("id"), F.lit(side).alias("side"), *_NARROW[2:])
            out = own if out is None else out.unionByName(own)
        if not out.groupBy("id").count().where("count > 1").isEmpty():
            raise ValueError(f"several rows of load {load} share an id")
        return out

    def _matched(self, keys: DataFrame) -> DataFrame:
        """(src, dst) keys that match and were not compared before; ``keys``: (side, key, compared columns, fresh)."""
        side = lambda s, which: keys.where((F.col("side") == s) & which).withColumnRenamed("key", f"temp_id_{s}")
        new, old, any_ = F.col("fresh"), ~F.col("fresh"), F.lit(True)
        pairs = matching_candidates(side("S1", new), side("S2", any_), self.cfg).unionByName(matching_candidates(side("S1", old), side("S2", new), self.cfg))
        return settle(apply_threshold(score_pairs(pairs, self.cfg), self.cfg).select(F.col("id_s1").alias("src"), F.col("id_s2").alias("dst")))

    def _relabelled(self, keys: DataFrame, matched: DataFrame, before: DataFrame, left: DataFrame) -> DataFrame:
        """(key, label) of the keys whose label this load sets; ``before``: labels of the keys that are not fresh; ``left``: keys of replaced rows."""
        known = before.where("label is not null")
        end = lambda c: F.coalesce(F.col(f"label_{c}"), F.col(c)).alias(c)
        ends = matched
        for c in ("src", "dst"):
            ends = ends.join(known.select(F.col("key").alias(c), F.col("label").alias(f"label_{c}")), c, "left")
        merged = settle(connected_components(settle(ends.select(end("src"), end("dst")))))
        moved = known.join(merged.withColumnRenamed("node", "label"), "label").where("component <> label").select("key", F.col("component").alias("label"))
        met = matched.select(F.col("src").alias("key")).union(matched.select("dst")).distinct()
        born = met.join(known.select("key"), "key", "left_anti").join(merged.withColumnRenamed("node", "key"), "key").select("key", F.col("component").alias("label"))
        set_ = moved.unionByName(born)
        # Keys of dirty blocks that match nothing any more lose what an earlier load said.
        lost = keys.where("dirty").select("key").union(left).distinct().join(set_.select("key"), "key", "left_anti").select("key", F.lit(None).cast("string").alias("label"))
        return set_.unionByName(lost)

    def load(self, number: int, source1: DataFrame, source2: DataFrame, keys: tuple[Column | None, Column | None] = (None, None)) -> Delta:
        """Resolves a load's rows of both sources with all earlier loads; ``keys`` name rows across loads."""
        earlier = [k for k in self.loads() if k != number]
        sources, by = dict(zip(SIDES, (source1, source2), strict=True)), dict(zip(SIDES, keys, strict=True))
        new = self._arrived(sources, by, number)
        old = self._narrow(earlier)
        if old is None:
            old = new.withColumn("load", F.lit(number)).where("false")
        replaced = settle(old.join(new.select("id"), "id", "left_semi").select("id", "load", "blocking_key", "key"))
        self._write(replaced.select("id", F.col("load").alias("old_load")), "gone", number)

        dirty = replaced.select("blocking_key").distinct().withColumn("dirty", F.lit(True))
        touched = new.select("blocking_key").union(replaced.select("blocking_key")).distinct().join(dirty, "blocking_key", "left").fillna(False, ["dirty"])
        stays = old.join(replaced.select("id", "load"), ["id", "load"], "left_anti").select(*_NARROW, F.lit(False).alias("new"))
        here = settle(stays.unionByName(new.select(*_NARROW, F.lit(True).alias("new"))).join(touched, "blocking_key"))
        compared = ["side", "key", "blocking_key", *CLEAN]
        all_keys = settle(here.groupBy(*compared).agg(F.min(F.col("new") | F.col("dirty")).alias("fresh"), F.max("dirty").alias("dirty")))

        labels = self._latest(self._table("labels", earlier), "key", "label")
        if labels is None:
            labels = self.spark.createDataFrame([], "key string, label string")
        before = settle(all_keys.where(~F.col("fresh")).select("key").join(labels, "key"))
        set_ = self._write(self._relabelled(all_keys, self._matched(all_keys), before, replaced.select("key")), "labels", number)

        now = before.join(set_.select("key"), "key", "left_anti").unionByName(set_)
        labelled = here.join(now, "key", "left").join(set_.select("key", F.lit(True).alias("_set")), "key", "left")
        placed = settle(labelled.select("id", "side", *CLEAN, F.coalesce("label", "id").alias("component"), (F.col("new") | F.col("dirty") | F.coalesce("_set", F.lit(False))).alias("changed")))
        # A component changed if it has a new row or a key whose label was set.
        changed = placed.where("changed").select("component").distinct()
        affected = settle(placed.join(changed, "component", "left_semi"))
        sided = lambda s: affected.where(F.col("side") == s).withColumnRenamed("id", f"temp_id_{s}")
        ids = self._write(fingerprints(affected.select("id", "component"), sided("S1"), sided("S2")), "ids", number)
        return self._merged(number, earlier, ids)

    def _merged(self, number: int, earlier: list[int], ids: DataFrame) -> Delta:
        """Entities of all ids that the load gave or took, from all their rows."""
        stored = self._latest(self._table("ids", earlier), "id", "corporate_id")
        touched, all_ids = ids.select("corporate_id"), ids
        if stored is not None:
            was = stored.join(ids.select("id"), "id", "left_semi").select("corporate_id")
            touched = touched.union(was)
            all_ids = stored.join(ids.select("id"), "id", "left_anti").unionByName(ids)
        touched = settle(touched.distinct())
        owners = settle(all_ids.join(touched, "corporate_id", "left_semi").select("id", "corporate_id"))
        own = []
        for side in SIDES:
            rows = self.rows(side, [*earlier, number])
            own.append(rows.join(owners.select(F.col("id").alias(f"temp_id_{side}")), f"temp_id_{side}", "left_semi").drop("load", "key"))
        entities = self._write(merge_sources(own[0], own[1], owners), "entities", number)
        retired = self._write(touched.join(owners.select("corporate_id"), "corporate_id", "left_anti"), "retired", number)
        self._finish(number)
        return Delta(number, entities, retired)

    def _finish(self, number: int) -> None:
        self.spark.range(1).select(F.lit(number).alias("load_number")).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/done/load={number}")

    def folded(self, folder: str) -> Resolution:
        """The same state in another folder, as one load of the last one's number: without replaced rows and outdated labels, ids and entities.

        The old folder stays as it is, so a reader or a run that breaks off loses nothing; later loads go to the new one.
        """
        loads, other = self.loads(), Resolution(self.spark, folder, self.cfg)
        last = loads[-1]
        for side in SIDES:
            other._write(self.rows(side, loads).drop("load"), f"rows_{side}", last)
        for name in ("gone", "retired"):
            other._write(self._table(name, loads).where("false").drop("load"), name, last)
        other._write(self._latest(self._table("labels", loads), "key", "label").where("label is not null"), "labels", last)
        other._write(self._latest(self._table("ids", loads), "id", "corporate_id"), "ids", last)
        other._write(self.entities(), "entities", last)
        other._finish(last)
        return other

    def entities(self) -> DataFrame:
        """All entities after the loads so far: of each id the last load's row, without retired ones."""
        loads = self.loads()
        every, gone = self._table("entities", loads), self._table("retired", loads)
        said = every.select("corporate_id", "load").unionByName(gone.select("corporate_id", "load"))
        latest = said.groupBy("corporate_id").agg(F.max("load").alias("load"))
        return every.join(latest, ["corporate_id", "load"], "left_semi").drop("load")
