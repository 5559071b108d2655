"""Asking as a stream: retries by timers, the budget of calls, expiry, and state that survives a restart."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.risk import RiskConfig
from ledgerloom.streaming.asking import ask_stream

SCHEMA = "corporate_id string, corporate_name string, context string, asked_at timestamp"


def scoring():
    """The rule of failures, and a scorer of it; made here, as workers can't import this module."""

    def fails(company, attempt):
        return (int(company) + attempt) % 3 == 0 or int(company) % 7 == 6

    def scorer(record):
        if fails(record["corporate_id"], record["attempt"]):
            raise OSError("no answer")
        return {"has_adverse_media": True, "summary": record["context"], "risk_score": 0.25, "keywords_found": ["fraud"]}

    return fails, scorer


class Asked:
    def __init__(self, spark, place, cfg, lanes):
        self.spark, self.place, self.cfg, self.lanes, self.files = spark, place, cfg, lanes, 0

    def write(self, minute, ids=()):
        """A file of requests at a minute; without ids, of time alone."""
        at = f"2024-01-01 {minute // 60:02}:{minute % 60:02}:00"
        rows = [(str(k), f"name {k}", f"context {k}", at) for k in ids] or [(None, None, None, at)]
        df = self.spark.createDataFrame(rows, SCHEMA.replace("timestamp", "string")).withColumn("asked_at", F.col("asked_at").cast("timestamp"))
        df.coalesce(1).write.parquet(f"{self.place}/in/{self.files:03}")
        self.files += 1

    def run(self):
        requests = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.place}/in/*")
        out = ask_stream(requests, scoring()[1], self.cfg, lanes=self.lanes)
        out.writeStream.format("parquet").option("path", f"{self.place}/out").option("checkpointLocation", f"{self.place}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        return self.spark.read.parquet(f"{self.place}/out").collect()


def plain(ids, attempts):
    """How each company ends, and after how many attempts."""
    fails = scoring()[0]
    good = {k: next((a for a in range(1, attempts + 1) if not fails(k, a)), None) for k in ids}
    return {str(k): ("found", a) if a else ("expired", attempts) for k, a in good.items()}


@pytest.mark.parametrize("lanes", [1, 3])
def test_failures_come_back_and_the_budget_holds(spark, tmp_path, lanes):
    """Nine calls a minute for 30 companies; the stream stops halfway, and goes on from its state."""
    asked = Asked(spark, tmp_path, RiskConfig(calls_per_minute=9, attempts=3, first_wait=2.0), lanes)
    asked.write(0, range(20))
    asked.write(1, [*range(20, 30), 3])  # 3 waits already or is done; asked once more if done
    half = asked.run()
    assert len(half) < 30
    for minute in range(2, 17):
        asked.write(minute)
    got = asked.run()
    want = plain(range(30), 3)
    assert {r["corporate_id"]: (r["outcome"], r["attempts"]) for r in got} == want
    assert Counter(r["outcome"] for r in got)["expired"] >= 4
    for r in got:
        known = r["outcome"] == "found"
        assert (r["risk_score"] == 0.25) == (r["adverse_media_last_checked"] is not None) == known and (r["has_adverse_media"] is None) != known
    by_minute = Counter(r["adverse_media_last_checked"].minute for r in got if r["outcome"] == "found")
    assert max(by_minute.values()) <= 9


def test_requests_of_one_time_in_many_files(spark, tmp_path):
    """Each file is a batch: those after the second hold the time that the watermark has reached already."""
    asked = Asked(spark, tmp_path, RiskConfig(calls_per_minute=1000, attempts=2, first_wait=2.0), 2)
    for k in range(5):
        asked.write(0, range(5 * k, 5 * k + 5))
    for minute in range(1, 5):
        asked.write(minute)
    assert {r["corporate_id"]: (r["outcome"], r["attempts"]) for r in asked.run()} == plain(range(25), 2)
