"""Companies asked about as a stream: what fails is asked again later, from state that survives restarts.

Each company that waits has a row of state: its record, its attempts, and when it is due. The companies are dealt to ``lanes`` by a hash, and every lane
has its share of the one budget of calls a minute, so all tasks together never exceed it and none waits for another. A failed call
comes back after a doubled wait, by a timer; after the last attempt the company expires and says so. No call blocks a task: nothing sleeps.

Time is the stream's own watermark, so a replay of the same files ends in the same state; with ``clock="processingTime"`` it is the wall clock.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerloom.operators.risk import RESULT, RiskConfig, Scorer, read_reply

#: What the stream gives: a finding, how it ended ("found" or "expired"), after how many attempts.
OUTCOME = T.StructType([*RESULT.fields, T.StructField("outcome", T.StringType()), T.StructField("attempts", T.IntegerType())])
_MINUTE = 60_000
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Asking(StatefulProcessor):
    """State of one lane: the companies that wait, and the calls of the present minute."""

    def __init__(self, scorer: Scorer, cfg: RiskConfig, share: int, wall_clock: bool):
        self.scorer, self.cfg, self.share, self.wall_clock = scorer, cfg, share, wall_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "corporate_id string", "record string, attempts int, due long")
        self.spent = handle.getValueState("spent", "minute long, calls int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs() if self.wall_clock else timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            for record in frame.drop(columns="_lane", errors="ignore").to_dict("records"):
                asked = record.pop("asked_at")
                if not self.wall_clock:
                    now = max(now, int(pd.Timestamp(asked).value // 1_000_000))
                if record["corporate_id"] is not None and not self.waiting.containsKey((record["corporate_id"],)):
                    self.waiting.updateValue((record["corporate_id"],), (json.dumps(record), 0, now))
        yield from self._ask(now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._ask(expiredTimerInfo.getExpiryTimeInMs())

    def _tokens(self, now: int) -> int:
        spent = self.spent.get() if self.spent.exists() else (0, 0)
        return self.share - (spent[1] if spent[0] == now // _MINUTE else 0)

    def _ask(self, now: int) -> Iterator[pd.DataFrame]:
        """Asks for all that is due while calls are left, in the order of due time and id, and sets the timer of the next."""
        known = sorted((int(v[2]), k[0], v[0], int(v[1])) for k, v in self.waiting.iterator())
        tokens, out, next_due = self._tokens(now), [], []
        before = tokens
        for due, company, text, attempts in known:
            if due > now:
                next_due.append(due)
                continue
            if tokens <= 0:
                later = (now // _MINUTE + 1) * _MINUTE
                self.waiting.updateValue((company,), (text, attempts, later))
                next_due.append(later)
                continue
            tokens -= 1
            record, attempts = json.loads(text), attempts + 1
            at = pd.Timestamp(now, unit="ms")
            try:
                got = read_reply(self.scorer({**record, "attempt": attempts}))
                out.append((company, record["corporate_name"], got["has_adverse_media"], got["summary"], got["risk_score"], got["keywords_found"], at, "found", attempts))
            except Exception:
                if attempts < self.cfg.attempts:
                    later = now + int(1000 * self.cfg.first_wait * 2 ** (attempts - 1))
                    self.waiting.updateValue((company,), (text, attempts, later))
                    next_due.append(later)
                    continue
                out.append((company, record["corporate_name"], None, None, None, None, None, "expired", attempts))
            self.waiting.removeKey((company,))
        if tokens < before:
            self.spent.update((now // _MINUTE, self.share - tokens))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if next_due:
            self.handle.registerTimer(min(next_due))
        if out:
            yield pd.DataFrame(out, columns=OUTCOME.names).astype({"has_adverse_media": "object", "adverse_media_last_checked": "datetime64[ns]"})

    def close(self) -> None:
        pass


def ask_stream(requests: DataFrame, scorer: Scorer, cfg: RiskConfig = RiskConfig(), clock: str = "eventTime", delay: str = "0 seconds", lanes: int | None = None) -> DataFrame:
    """``OUTCOME`` rows of a stream of (corporate_id, corporate_name, context, asked_at); a null id only moves the time on.

    Requests may be ``delay`` older than the newest of earlier batches; those that are still older are lost. A company that waits already is not asked twice. The scorer gets the record with the number of the ``attempt``.
    """
    spark = requests.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    lanes = max(1, min(lanes or cfg.parallelism or int(spark.conf.get("spark.sql.shuffle.partitions")), cfg.calls_per_minute))
    rows = requests.select("corporate_id", "corporate_name", "context", "asked_at", F.pmod(F.xxhash64("corporate_id"), F.lit(lanes)).alias("_lane"))
    if clock == "eventTime":
        # Spark drops rows at the watermark itself too: requests of one time may come in several batches.
        rows = rows.withWatermark("asked_at", f"{delay} 1 millisecond")
    asking = Asking(scorer, cfg, cfg.calls_per_minute // lanes, clock == "processingTime")
    return rows.groupBy("_lane").transformWithStateInPandas(asking, OUTCOME, "append", clock)
