"""Quality rules: document measures, and a decision list learned from labels by sequential covering.

DataFrame and SQL functions only; a text's measures are array functions within its row, so nothing
shuffles. Learning reads aggregates of the labelled rows (counts by feature and bin, bounded by
``BINS`` times the number of features), never rows: a rule grows by the threshold of most FOIL gain on
two thirds of the labels, is pruned on the rest, and stays when precise enough there; the rows it
covers leave, and the next rule grows. The list becomes one ordered CASE expression.

Defined cases: a null text has no words and fails the base rule. Ties between thresholds go to the
first feature and least cut. With no label, or none of one class, the list is empty and the base
rule decides alone; an empty table gives an empty result. Rows that repeat repeat their result; a null id is measured and not
learned from; texts are read whole; extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.scratch import settle

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
BINS = 40
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.95
MIN_COVER = 10
MIN_SHARE = 0.002
FEATURES = ("symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "mean_word", "digit_rate", "n_words")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the features.

    Each step is a column of its own that later steps use several times, so none is computed anew for
    every element of an array.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("raw"), F.translate(text, "\t\x0b\x0c\r", "    ").alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    words = F.filter(F.split(F.translate("text", "\n", " "), " "), lambda x: x != "")
    without = lambda chars: (F.length("raw") - F.length(F.translate("raw", chars, ""))).cast("long")
    rows = rows.select("id", words.alias("words"), lines.alias("lines"), without(SYMBOLS).alias("n_symbols"), without(" \t\n\x0b\x0c\r").alias("n_blank"), F.length("raw").cast("long").alias("n_chars"), without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"), without("0123456789").alias("n_digits"), _raw_lines("raw").alias("raw_lines"))
    triple = F.transform(F.sequence(F.lit(1), F.size("words") - 2), lambda i: F.xxhash64(F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2)))
    grams = F.when(F.size("words") >= 4, triple).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select("id", "n_symbols", "n_chars", "n_upper", "n_digits", F.size("words").cast("long").alias("n_words"), (F.col("n_chars") - F.col("n_blank")).alias("word_chars"), F.size("raw_lines").cast("long").alias("n_lines"), (F.size("raw_lines") - F.size(F.array_distinct("raw_lines"))).cast("long").alias("n_dup_lines"), grams.alias("grams"))
    some = F.size("grams") > F.size(F.array_distinct("grams"))
    ranked = F.when(some, F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.select(*[c for c in rows.columns if c != "grams"], ranked.alias("ranked"))
    item = lambda k: F.get(F.col("ranked"), k)["h"]
    twice = F.filter("ranked", lambda x, k: (item(k - 1) == x["h"]) | (item(k + 1) == x["h"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    rows = rows.withColumn("n_repeat_words", F.when(F.col("ranked").isNull(), 0).otherwise(covered).cast("long")).drop("ranked")
    over = lambda x, y: F.coalesce(F.try_divide(F.col(x), F.col(y)), F.lit(0.0))
    return rows.withColumns({"symbol_rate": over("n_symbols", "n_words"), "dup_line_rate": over("n_dup_lines", "n_lines"), "repeat_rate": over("n_repeat_words", "n_words"), "upper_rate": over("n_upper", "word_chars"), "digit_rate": over("n_digits", "word_chars"), "mean_word": over("word_chars", "n_words")})


def _raw_lines(raw: str) -> Column:
    """The lines, unchanged, that hold a word."""
    return F.filter(F.split(raw, "\n"), lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def _any(rules: list[Rule]) -> Column:
    out = F.lit(False)
    for r in rules:
        out = out | _all(r)
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    if p == 0:
        return -1.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _widened(rows: DataFrame, c: Condition) -> Condition:
    """The cut moved to the middle of the gap between what it leaves and the nearest bad row it covers."""
    hit = c.column()
    low, high = (F.max, F.min) if c.above else (F.min, F.max)
    left, met = rows.agg(low(F.when(~hit, F.col(c.feature)).cast("double")), high(F.when(hit & F.col("bad"), F.col(c.feature)).cast("double"))).first()
    return c if left is None or met is None else Condition(c.feature, c.above, (left + met) / 2)


def learn(labelled: DataFrame) -> list[Rule]:
    """The decision list from rows (features, bad boolean, prune boolean), each rule a reason to reject."""
    quantiles = [k / BINS for k in range(1, BINS)]
    row = labelled.agg(*[F.percentile_approx(f, quantiles, 10_000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(row[f] or [])) for f in FEATURES}
    if not any(cuts.values()):
        return []
    index = lambda f: F.aggregate(F.array(*[F.lit(float(c)) for c in cuts[f]]), F.lit(0), lambda a, c: a + (F.col(f) > c).cast("int")) if cuts[f] else F.lit(0)
    binned = settle(labelled.select(*FEATURES, "bad", "prune", F.array(*[index(f) for f in FEATURES]).alias("bins")))
    n_prune = binned.where("prune").count()
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        left = binned.where(~_any(rules)) if rules else binned
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            counts = left.where(~F.col("prune") & _all(rule)).select("bad", F.posexplode("bins").alias("f", "bin")).groupBy("f", "bin").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
            own = [(r["f"], r["bin"], r["p"], r["n"]) for r in counts]
            p0, n0 = sum(p for f, _, p, _ in own if f == 0), sum(n for f, _, _, n in own if f == 0)
            if p0 < MIN_COVER or n0 == 0:
                break
            best: tuple[float, Condition | None] = (1e-9, None)
            for k, f in enumerate(FEATURES):
                for j, cut in enumerate(cuts[f]):
                    p, n = sum(x for a, b, x, _ in own if a == k and b > j), sum(x for a, b, _, x in own if a == k and b > j)
                    for above, hit in ((True, (p, n)), (False, (p0 - p, n0 - n))):
                        if hit[0] >= MIN_COVER and (g := _gain(*hit, p0, n0)) > best[0] * (1 + 1e-12):
                            best = g, Condition(f, above, cut)
            if best[1] is None:
                break
            rule.append(_widened(left.where(~F.col("prune") & _all(rule)), best[1]))
        if not rule:
            break
        heads = [tuple(rule[:k]) for k in range(1, len(rule) + 1)]
        sums = left.where("prune").agg(*[F.count_if(_all(h) & (F.col("bad") == b)).alias(f"c{k}{int(b)}") for k, h in enumerate(heads) for b in (True, False)]).first()
        scored = []
        for k, h in enumerate(heads):
            p, n = sums[f"c{k}1"], sums[f"c{k}0"]
            if p + n >= max(3, MIN_SHARE * n_prune) and p / (p + n) >= MIN_PRECISION:
                scored.append(((p - n) / (p + n) * math.sqrt(p), -k, h))
        if not scored:
            break
        rules.append(max(scored)[2])
    return rules


def decision(rules: list[Rule], default: bool = True) -> Column:
    """kept: false by the base rule, false by the first learned rule that holds, else ``default``."""
    out = F.when(base_failed(), False)
    for rule in rules:
        out = out.when(_all(rule), False)
    return out.otherwise(default)


def reason(rules: list[Rule]) -> Column:
    out = F.when(base_failed(), "base")
    for rule in rules:
        out = out.when(_all(rule), " and ".join(map(str, rule)))
    return out


def train(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> list[Rule]:
    """Learn from the rows that have a quality label and pass the base rule; a third of them prunes."""
    known = labels.where(f"{id_col} is not null and quality is not null").groupBy(F.col(id_col).alias("id")).agg((F.min("quality") == 0).alias("bad"))
    rows = measured.where(~base_failed()).join(known, "id")
    return learn(settle(rows.select(*FEATURES, "bad", (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("prune"))))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures of every row with base_failed, kept and reason; the learned list decides what the base keeps."""
    measured = settle(measures(docs, id_col, text_col))
    rules = train(measured, labels, id_col)
    judged = measured.withColumns({"base_failed": base_failed(), "kept": decision(rules), "reason": reason(rules)})
    return judged.withColumnRenamed("id", id_col)
