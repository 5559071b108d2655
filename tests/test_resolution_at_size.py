"""Resolution whose work, and what it sends through the driver, must not outgrow the sources."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom import queries
from ledgerloom.operators import components, resolve

SMALL = "/root/testdata/sf0.001"


def sides(spark, rows):
    schema = "k long, corporate_name_S1 string, address string, country string, postal_code string"
    made = [spark.createDataFrame(own, schema.replace("S1", s)) for own, s in zip(rows, ("S1", "S2"), strict=True)]
    return [resolve.prepare(df, s, F.col("k")) for df, s in zip(made, ("S1", "S2"), strict=True)]


@pytest.fixture
def seen(monkeypatch):
    """Plans of the tables that resolution writes on its way."""
    plans, settle = [], resolve.settle

    def watched(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return settle(df, *more)

    monkeypatch.setattr(resolve, "settle", watched)
    monkeypatch.setattr(components, "settle", watched)
    return plans


def plain_pairs(one, two, block="blocking_key", sizes=None):
    """Without tiles, whose list of large blocks is broadcast and much smaller than the rows."""
    two = two.withColumnRenamed(block, "_other")
    return one.join(two.hint("merge"), one[block] == two["_other"]).drop(block, "_other")


@pytest.mark.parametrize("name", ["harmonized_entities", "entity_counts", "entity_fingerprint", "components_of_matches"])
def test_no_table_of_the_sources_goes_through_the_driver(spark, monkeypatch, seen, name):
    monkeypatch.setattr(resolve, "block_pairs", plain_pairs)
    found = queries.QUERIES[name](spark, SMALL)
    seen.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(seen) > 5 and not [p for p in seen if "Broadcast" in p]


def test_equal_postal_codes_meet_in_even_tiles(spark):
    rng = random.Random(5)
    rows = [[(k, "the " + "".join(rng.choice("abcdef") for _ in range(8)), None, "DE", "1") for k in range(600)] for _ in range(2)]
    pairs = resolve.matching_candidates(*sides(spark, rows))
    per = [r["n"] for r in pairs.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(per) > 350_000 and len(per) >= 4 and max(per) <= 0.5 * sum(per)


def test_a_name_of_both_sides_is_linked_by_as_many_links_as_keys(spark, monkeypatch):
    links, whole = [], resolve.connected_components

    def counted(edges, *more):
        links.append(edges.count())
        return whole(edges, *more)

    monkeypatch.setattr(resolve, "connected_components", counted)
    rows = [[(k, "Acme Trading", None, "US", str(k)) for k in range(40)], [(k, "Acme Trading", None, "US", str(k)) for k in range(20, 70)]]
    comp = resolve.match_components(*sides(spark, rows))
    assert comp.agg(F.count("id"), F.count_distinct("component")).first()[:] == (90, 1)
    assert links == [90]


@pytest.mark.parametrize("cfg", [resolve.MatchConfig(), resolve.MatchConfig(threshold=0.3, name_weight=0.3, address_weight=0.5, postal_weight=0.2), resolve.MatchConfig(threshold=0.75), resolve.MatchConfig(threshold=0.5), resolve.MatchConfig(renormalize_missing=True)])
def test_components_and_ids_are_those_of_all_matching_pairs(spark, cfg):
    rng = random.Random(11)
    names = ["acme one", "acme two", "acme onne", "acme", "bolt", "bolt co", "bolts and nuts", "", None]
    row = lambda k: (k, rng.choice(names), rng.choice(["x street 1", "y road 2", "", None]), rng.choice(["de", "fr", None]), rng.choice(["1", "2", "3", None]))
    one, two = sides(spark, [[row(k) for k in range(45)] for _ in range(2)])
    every = resolve.apply_threshold(resolve.score_pairs(resolve.candidate_pairs(one, two), cfg, prune=False), cfg)
    up = {r["id"]: r["id"] for r in one.select(F.col("temp_id_S1").alias("id")).union(two.select("temp_id_S2")).collect()}
    for a, b in every.collect():
        a, b = up[a], up[b]
        up = {x: min(a, b) if y in (a, b) else y for x, y in up.items()}
    groups = lambda pairs: sorted(sorted(x for x, y in pairs if y == c) for c in {y for _, y in pairs})
    comp = resolve.match_components(one, two, cfg)
    assert groups(list(map(tuple, comp.collect()))) == groups(list(up.items()))
    want = sorted(map(tuple, resolve.fingerprints(comp, one, two).collect()))
    assert sorted(map(tuple, resolve.corporate_ids(one, two, cfg).collect())) == want and len(want) == 90


def test_a_task_keeps_links_that_connect_the_same(spark):
    rng = random.Random(3)
    links = pd.DataFrame([(f"S1:{rng.randrange(60)}", f"S2:{rng.randrange(60)}") for _ in range(900)], columns=["src", "dst"])
    kept = pd.concat(resolve._forest(iter([links[:400], links[400:], links[:0]])))
    label = lambda df: sorted(map(tuple, components.connected_components(spark.createDataFrame(df)).collect()))
    assert label(kept) == label(links) and len(kept) < 120
