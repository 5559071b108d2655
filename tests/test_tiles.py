"""Pairs scored in tiles: workers get rows, not pairs, and give the plain functions' numbers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom import queries
from ledgerloom.functions import similarity
from ledgerloom.operators import resolve

SMALL = "/root/testdata/sf0.001"
ONE = "k long, corporate_name_S1 string, address string, country string, postal_code string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sides(spark, seed, n, addresses):
    rng = random.Random(seed)
    names = ["Acme Trading", "Acme Tradings", "Acmee Tradings", "acm", "Globl Tech", None, "", "acme " + "x" * 70]
    row = lambda k: (k, rng.choice(names), rng.choice(addresses), rng.choice(["US", "DE", None]), rng.choice(["100", "200", None]))
    made = [spark.createDataFrame([row(k) for k in range(n)], ONE.replace("S1", s)) for s in ("S1", "S2")]
    return [resolve.prepare(df, s, F.col("k")) for df, s in zip(made, ("S1", "S2"), strict=True)]


@pytest.mark.parametrize("cfg", [resolve.MatchConfig(), resolve.MatchConfig(renormalize_missing=True), resolve.MatchConfig(threshold=0.35), resolve.MatchConfig(threshold=0.8)])
@pytest.mark.parametrize("addresses", [["1 Main Street", "Main St 1", "2 Oak Road"], ["1 Main Street", "Main St 1", "Street Main 1 " + "y" * 70, "", None]])
def test_rows_with_addresses_are_scored_in_tiles(spark, monkeypatch, cfg, addresses):
    one, two = sides(spark, 7, 80, addresses)
    every = resolve.score_pairs(resolve.candidate_pairs(one, two), cfg, prune=False).where(F.col("score") >= cfg.threshold)
    want = sorted(map(tuple, every.select("id_s1", "id_s2", F.round("score", 6)).collect()))
    given, score_pairs = [], resolve.score_pairs
    monkeypatch.setattr(resolve, "score_pairs", lambda pairs, *more: given.append(pairs) or score_pairs(pairs, *more))
    got = sorted(map(tuple, resolve.matched_rows(one, two, cfg, digits=6).collect()))
    assert got == want and len(got) > 50
    assert [p.where("addr_s1 <> '' and addr_s2 <> ''").count() for p in given] == [0]


def test_tiles_of_rows_with_addresses_spread_over_tasks(spark):
    many = lambda n, s: resolve.prepare(spark.range(n).selectExpr("id k", f"'Acme Trading' corporate_name_{s}", "'1 Main Street' address", "'US' country", "'1' postal_code"), s, F.col("k"))
    rows = resolve.matched_rows(many(900, "S1"), many(800, "S2"))
    per = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(per) == 720_000 and len(per) == 4 and max(per) <= 2 * sum(per) / len(per)


def word(rng):
    return "".join(rng.choice("abcde éñ中,-") for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 12, 20, 31, 32, 33, 63, 64, 65, 90])))


def test_grids_equal_the_plain_functions():
    rng = random.Random(5)
    one, two = [word(rng) for _ in range(150)], [word(rng) for _ in range(140)]
    two[:40] = [w[:3] + w[4:] + "a" for w in one[:40]]
    two[40:60] = one[40:60]
    for grid, plain in ((similarity.jaro_winkler_grid, similarity.jaro_winkler), (similarity.token_sort_grid, similarity.token_sort_ratio)):
        assert grid(one, two).tolist() == [[plain(a, b) for b in two] for a in one]
        assert grid([], two).shape == (0, len(two)) and grid(one, []).shape == (len(one), 0) and grid(["", ""], [""]).tolist() == [[0.0], [0.0]]


def test_rounding_is_that_of_spark(spark):
    values = [k / 10**7 for k in range(5, 10**7, 12_345)] + [0.8333335, 0.5000005, 0.0, 1.0, 1 / 3, 0.9999995]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", F.round("x", 6).alias("y")).collect()
    x, y = (np.array([r[c] for r in rows]) for c in ("x", "y"))
    assert similarity.round_half_up(x, 6).tolist() == y.tolist()


def test_scored_values_are_distinct_pairs_of_any_block(spark):
    rng = random.Random(9)
    made = [spark.createDataFrame([(rng.choice([*"pqrst", None]), rng.choice(["ab", "abc", "ba", "", None, "acb", "b c", "c b a"])) for _ in range(90)], "blocking_key string, name string") for _ in range(2)]
    pairs = made[0].join(made[1].withColumnRenamed("name", "b"), "blocking_key").select("name", "b").distinct().collect()
    for grid, plain in ((similarity.jaro_winkler_grid, similarity.jaro_winkler), (similarity.token_sort_grid, similarity.token_sort_ratio)):
        got = resolve.value_pairs(*made, "name", score=grid)
        key = lambda r: tuple((x is None, x or "") for x in r[:2])
        assert sorted(map(tuple, got.collect()), key=key) == sorted(((a, b, plain(a, b)) for a, b in pairs), key=key)


@pytest.mark.parametrize("name", ["token_sort_score", "jaro_winkler_score"])
def test_scores_send_no_pair_to_a_worker(spark, name):
    got = plan(queries.QUERIES[name](spark, SMALL))
    assert "EvalPython" not in got and got.count("MapInArrow") == 1


def test_candidate_pairs_read_each_text_once(spark):
    assert "documents.parquet" not in plan(queries.QUERIES["candidate_pairs"](spark, SMALL))
