"""Adverse-media findings: a prompt, an injected scorer under a rate limit, and parsing of its replies."""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The words that a finding is about.
KEYWORDS = ("fraud", "lawsuit", "bankruptcy", "scandal", "investigation", "violation", "penalty")

RESULT = T.StructType([T.StructField("corporate_id", T.StringType()), T.StructField("corporate_name", T.StringType()), T.StructField("has_adverse_media", T.BooleanType()), T.StructField("adverse_media_summary", T.StringType()), T.StructField("risk_score", T.DoubleType()), T.StructField("keywords_found", T.ArrayType(T.StringType())), T.StructField("adverse_media_last_checked", T.TimestampType())])
REPLY = "has_adverse_media boolean, summary string, risk_score double, keywords_found array<string>"


def keywords_in(text: Column, keywords=KEYWORDS) -> Column:
    """The keywords that the text holds, in the list's order."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(low, k))


def keyword_risk(df: DataFrame, text_col: str, keywords=KEYWORDS) -> DataFrame:
    """The default scorer as expressions: keywords found, their share of the list as the risk."""
    found = df.withColumn("keywords_found", keywords_in(F.col(text_col), keywords))
    return found.withColumns({"has_adverse_media": F.size("keywords_found") > 0, "risk_score": F.size("keywords_found") / F.lit(float(len(keywords)))})


def prompt(name: Column, country: Column, industry: Column, keywords=KEYWORDS, days_back: int = 365) -> Column:
    known = lambda c: F.coalesce(c, F.lit("unknown"))
    return F.format_string(f"Company: %s\nCountry: %s\nIndustry: %s\nLook for: {', '.join(keywords)}\nPeriod: last {days_back} days", known(name), known(country), known(industry))


def parse_reply(reply: Column) -> Column:
    """A struct (``REPLY``) of a JSON reply, code fences gone, risk within 0 and 1.

    What isn't JSON gives the neutral result; JSON that lacks one of the four keys gives null.
    """
    bare = F.trim(F.regexp_replace(reply, r"^\s*```(?:json)?\s*|\s*```\s*$", ""))
    got = F.from_json(bare, REPLY)
    whole = F.size(F.array_intersect(F.json_object_keys(bare), F.array(*[F.lit(k) for k in ("has_adverse_media", "summary", "risk_score", "keywords_found")]))) == 4
    clamped = F.struct(got["has_adverse_media"].alias("has_adverse_media"), got["summary"].alias("summary"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), got["risk_score"])).alias("risk_score"), got["keywords_found"].alias("keywords_found"))
    neutral = F.struct(F.lit(False).alias("has_adverse_media"), F.lit(None).cast("string").alias("summary"), F.lit(0.0).alias("risk_score"), F.array().cast("array<string>").alias("keywords_found"))
    return F.when(F.json_object_keys(bare).isNull(), neutral).when(whole, clamped)


class RateLimit:
    """At most ``calls`` in any ``window`` seconds, by waiting."""

    def __init__(self, calls: int, window: float = 60.0, clock=time.monotonic, sleep=time.sleep):
        self.calls, self.window, self.clock, self.sleep, self.at = max(1, calls), window, clock, sleep, deque()

    def wait(self) -> None:
        now = self.clock()
        while self.at and now - self.at[0] >= self.window:
            self.at.popleft()
        if len(self.at) >= self.calls:
            self.sleep(self.window - (now - self.at[0]))
            now = self.clock()
            self.at.popleft()
        self.at.append(now)


@dataclass(frozen=True)
class RiskConfig:
    calls_per_minute: int = 50
    parallelism: int | None = None  # None: the cluster's, and no more than there are calls a minute
    attempts: int = 3
    first_wait: float = 2.0
    keywords: tuple[str, ...] = KEYWORDS


Scorer = Callable[[dict], dict | str]


def keyword_scorer(record: dict) -> dict:
    """Deterministic, without any service: looks for the keywords in the record's ``context``."""
    text = (record.get("context") or "").lower()
    found = [k for k in KEYWORDS if k in text]
    return {"has_adverse_media": bool(found), "summary": f"mentions {', '.join(found)}" if found else None, "risk_score": len(found) / len(KEYWORDS), "keywords_found": found}


def read_reply(reply: dict | str) -> dict:
    if isinstance(reply, str):
        bare = reply.strip().removeprefix("```json").removeprefix("```").removesuffix("```").strip()
        try:
            reply = json.loads(bare)
        except ValueError:
            return {"has_adverse_media": False, "summary": None, "risk_score": 0.0, "keywords_found": []}
    return {"has_adverse_media": bool(reply["has_adverse_media"]), "summary": reply["summary"], "risk_score": min(1.0, max(0.0, float(reply["risk_score"]))), "keywords_found": list(reply["keywords_found"])}


def analyse(df: DataFrame, scorer: Scorer = keyword_scorer, cfg: RiskConfig = RiskConfig()) -> DataFrame:
    """A finding (``RESULT``) per row of (corporate_id, corporate_name, context, ...).

    The default scorer runs as expressions, in the partitions that the rows have. Others run on ``parallelism`` partitions that share
    the rate. A row whose scorer fails for good gets nulls, whatever happens to others; as it was never
    checked, the next run asks for it again and a merge keeps what is known of it.
    """
    if scorer is keyword_scorer:
        found = keyword_risk(df, "context", KEYWORDS)
        summary = F.when(F.col("has_adverse_media"), F.concat(F.lit("mentions "), F.array_join("keywords_found", ", ")))
        return found.select("corporate_id", "corporate_name", "has_adverse_media", summary.alias("adverse_media_summary"), "risk_score", "keywords_found", F.current_timestamp().alias("adverse_media_last_checked"))
    tasks = cfg.parallelism or max(1, min(df.sparkSession.sparkContext.defaultParallelism, cfg.calls_per_minute))
    share = max(1, cfg.calls_per_minute // tasks)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limit = RateLimit(share)
        for frame in frames:
            out = []
            for record in frame.to_dict("records"):
                got, checked = {}, None
                for k in range(cfg.attempts):
                    try:
                        limit.wait()
                        got = read_reply(scorer(record))
                        checked = pd.Timestamp.now(tz="UTC").tz_localize(None)
                        break
                    except Exception:
                        if k < cfg.attempts - 1:
                            time.sleep(min(10.0, cfg.first_wait * 2**k))
                out.append((record["corporate_id"], record["corporate_name"], *[got.get(c) for c in ("has_adverse_media", "summary", "risk_score", "keywords_found")], checked))
            yield pd.DataFrame(out, columns=RESULT.names).astype({"adverse_media_last_checked": "datetime64[ns]", "has_adverse_media": "object"})

    return df.repartition(tasks, "corporate_id").mapInPandas(run, RESULT)


def attach(entities: DataFrame, findings: DataFrame) -> DataFrame:
    """Left join by corporate_id; the planner broadcasts the findings only where they are small."""
    return entities.join(findings.drop("corporate_name"), "corporate_id", "left")


def adverse(entities: DataFrame) -> DataFrame:
    """The entities with adverse media."""
    return entities.where("has_adverse_media")


def without_findings(entities: DataFrame) -> DataFrame:
    """The skipped stage: typed nulls, so that a merge keeps what earlier runs found."""
    kinds = {f.name: f.dataType for f in RESULT if f.name not in ("corporate_id", "corporate_name")}
    return entities.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items()})
