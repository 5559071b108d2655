"""Declarative data-quality rules, all compiled into one aggregate pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

KINDS = ("not_null", "min_length", "max_length", "numeric", "positive", "range", "pattern", "unique")


@dataclass(frozen=True)
class Rule:
    """``value`` is the length or pattern; ``low`` and ``high`` are inclusive; ``approx`` is for unique only."""

    field: str
    kind: str
    value: int | str | None = None
    low: float | None = None
    high: float | None = None
    approx: bool = False

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown rule kind {self.kind!r} on {self.field}")

    @classmethod
    def parse(cls, rules: dict[str, list[dict]]) -> list[Rule]:
        return [cls(field, r["type"], r.get("value", r.get("pattern")), r.get("min"), r.get("max"), bool(r.get("approx", False))) for field, own in rules.items() for r in own]


def error_condition(rule: Rule) -> Column:
    """Rows for which it holds are errors; null is an error of not_null only."""
    c = F.col(f"`{rule.field}`")
    length = F.length(c.cast("string"))
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "min_length":
        return length < int(1 if rule.value is None else rule.value)
    if rule.kind == "max_length":
        return length > int(1000 if rule.value is None else rule.value)
    if rule.kind == "numeric":
        return c.isNotNull() & c.cast("string").try_cast("double").isNull()
    if rule.kind == "positive":
        return c.isNotNull() & (c < 0)
    if rule.kind == "pattern":
        return c.isNotNull() & ~c.rlike(str(rule.value))
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (c < rule.low)
    if rule.high is not None:
        bad = bad | (c > rule.high)
    return c.isNotNull() & bad


def _errors(rule: Rule) -> Column:
    if rule.kind != "unique":
        return F.count_if(F.coalesce(error_condition(rule), F.lit(False)))
    c = F.col(f"`{rule.field}`")
    kinds = F.approx_count_distinct(c) if rule.approx else F.count_distinct(c)
    return F.greatest(F.lit(0), F.count(c) - kinds)


def report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(field, kind, rows, errors) per rule whose column exists, from one aggregate."""
    own = [r for r in rules if r.field in df.columns]
    rows = F.count(F.lit(1)).alias("rows")
    one = df.agg(rows, *[_errors(r).cast("long").alias(f"e{k}") for k, r in enumerate(own)])
    if not own:
        return one.select(F.lit("").alias("field"), F.lit("").alias("kind"), "rows", F.lit(0).cast("long").alias("errors")).where("false")
    out = F.explode(F.array(*[F.struct(F.lit(r.field).alias("field"), F.lit(r.kind).alias("kind"), F.col("rows"), F.col(f"e{k}").alias("errors")) for k, r in enumerate(own)]))
    return one.select(out.alias("x")).select("x.*")


def decision(rule_report: DataFrame, error_threshold: float = 0.05) -> DataFrame:
    """One row: checks, errors, error_rate and passed."""
    total = rule_report.agg(F.count(F.lit(1)).alias("checks"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"), F.coalesce(F.max("rows"), F.lit(0)).alias("rows"))
    rate = F.col("errors") / F.nullif(F.col("rows") * F.col("checks"), F.lit(0))
    return total.select("checks", "errors", rate.alias("error_rate"), F.coalesce(rate <= error_threshold, F.lit(False)).alias("passed"))


def apart(spark: SparkSession) -> SparkSession:
    """A session with the same settings, for frames that are observed.

    An ``Observation`` leaves its manager in the frame's session, and some fitted models ship their session
    with their code; with such a manager in it Spark 4.1 can't serialize them. So no session does both.
    """
    other = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            other.conf.set(k, v)
    return other


def observed(df: DataFrame, rules: list[Rule], name: str = "quality") -> tuple[DataFrame, Observation, list[Rule]]:
    """``df`` with all rules counted while it runs, what they count into, and the rules that this leaves out.

    ``df`` comes from a session made by ``apart``. No scan of its own: the counts come with whatever writes or reads the frame. An exact distinct count can't be
    observed, so exact ``unique`` rules are left to ``report`` on the table that was written; approximate ones are counted here.
    """
    own = [r for r in rules if r.field in df.columns]
    here = [r for r in own if r.kind != "unique" or r.approx]
    seen = Observation(name)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[_errors(r).cast("long").alias(f"e{k}") for k, r in enumerate(here)])
    return counted, seen, [r for r in own if r not in here]


def observed_report(seen: Observation, rules: list[Rule], columns: list[str], written: DataFrame | None = None) -> list[dict]:
    """The rows of ``report`` in the order of the rules, once the observed frame has run; ``written`` is that frame's table."""
    own = [r for r in rules if r.field in columns]
    counts, here = seen.get, iter(range(len(own)))
    found = {id(r): counts[f"e{next(here)}"] for r in own if r.kind != "unique" or r.approx}
    rest = [r for r in own if id(r) not in found]
    if rest:
        found |= {id(r): x["errors"] for r, x in zip(rest, report(written, rest).collect(), strict=True)}
    return [{"field": r.field, "kind": r.kind, "rows": counts["rows"], "errors": found[id(r)]} for r in own]


def judged(found: list[dict], error_threshold: float = 0.05) -> bool:
    """Whether a report passes. No applicable rule fails; an empty frame raises."""
    if not found:
        return False
    if not found[0]["rows"]:
        raise ValueError("no rows to validate")
    return sum(r["errors"] for r in found) / (found[0]["rows"] * len(found)) <= error_threshold


def validate(df: DataFrame, rules: list[Rule], error_threshold: float = 0.05) -> tuple[bool, list[dict]]:
    """Whether the frame passes, with the report. No applicable rule fails; an empty frame raises."""
    found = [r.asDict() for r in report(df, rules).collect()]
    return judged(found, error_threshold), found
