"""Loads that follow each other, large blocks, and the batched similarity kernels."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import similarity
from ledgerloom.operators import resolve
from ledgerloom.operators.incremental import Resolution
from ledgerloom.sources.registry import REGISTRY, Registry
from ledgerloom.streaming.incremental import resolve_stream

ONE = "k long, corporate_name_S1 string, address string, country string, postal_code string, industry_sector string"
TWO = "k long, corporate_name_S2 string, country string, postal_code string, revenue double, profit double"


def keys():
    return F.col("k"), F.col("k")


def companies(seed, n, start=0):
    """Few names, many of them one letter apart, so that components grow and merge between loads."""
    rng = random.Random(seed)
    names = ["Acme Trading", "Acme Tradings", "Acmee Tradings", "Global Tech", "Globl Tech", "Northern Steel", "Northen Steel", "Norhten Stel", None, ""]
    pick = lambda: (rng.choice(names), rng.choice(["US", "DE", None]), rng.choice(["100", "200", None]))
    one, two = [], []
    for k in range(start, start + n):
        name, country, postal = pick()
        one.append((k, name, rng.choice([None, "", "1 Main Street", "1 Main St"]), country, postal, f"s{k % 3}"))
        name, country, postal = pick()
        two.append((k, name, country, postal, float(k), None if k % 4 == 0 else k - 5.0))
    return one, two


def told(entities):
    return sorted(str({c: r[c] for c in sorted(r.asDict()) if c != "_load_timestamp"}) for r in entities.collect())


def at_once(spark, one, two):
    return told(resolve.resolve_entities(spark.createDataFrame(one, ONE), spark.createDataFrame(two, TWO), keys=keys()))


def test_loads_end_as_one_resolution_of_all_rows(spark, tmp_path):
    one, two = companies(1, 36)
    state = Resolution(spark, f"file://{tmp_path}/state")
    seen: tuple[list, list] = ([], [])
    live: dict = {}
    for number, (lo, hi) in enumerate(((0, 12), (12, 13), (13, 36))):
        seen[0].extend(one[lo:hi])
        seen[1].extend(two[lo:hi] if number != 1 else [])
        own = (one[lo:hi], two[lo:hi] if number != 1 else [])
        delta = state.load(number, spark.createDataFrame(own[0], ONE), spark.createDataFrame(own[1], TWO), keys())
        changed = {r["corporate_id"]: str(r) for r in delta.entities.collect()}
        for r in delta.retired.collect():
            live.pop(r["corporate_id"])
        live |= changed
        assert live.keys() == {r["corporate_id"] for r in state.entities().collect()}
    assert state.loads() == [0, 1, 2] and told(state.entities()) == at_once(spark, *seen)


def test_replaced_rows_undo_their_matches_and_a_load_may_run_again(spark, tmp_path):
    one, two = companies(2, 14)
    state = Resolution(spark, f"file://{tmp_path}/state")
    state.load(0, spark.createDataFrame(one, ONE), spark.createDataFrame(two, TWO), keys())
    new_one = [(k, "Southern Copper", None, "FR", "9", "s") for k in (0, 3, 5)] + [(k, *one[7][1:]) for k in (9, 10)]
    new_two = [(k, f"Other {k}", "FR", None, 1.0, None) for k in (1, 2)] + [(k, *two[k][1:4], None, 2.0) for k in (4, 6)]
    for _ in range(2):  # a micro-batch that failed after writing comes again
        state.load(1, spark.createDataFrame(new_one, ONE), spark.createDataFrame(new_two, TWO), keys())
    rows = lambda old, new: list({r[0]: r for r in [*old, *new]}.values())
    back = [one[k] for k in (0, 3, 5, 9, 10)]  # old keys come again: no label of theirs has survived
    folded = state.folded(f"file://{tmp_path}/folded")
    assert folded.loads() == [1] and told(folded.entities()) == told(state.entities())
    want = at_once(spark, one, rows(two, new_two))
    for each in (state, folded):
        each.load(2, spark.createDataFrame(back, ONE), spark.createDataFrame([], TWO), keys())
        assert told(each.entities()) == want
    assert state.loads() == [0, 1, 2] and folded.loads() == [1, 2]
    with pytest.raises(ValueError, match="share an id"):
        state.load(3, spark.createDataFrame([one[0], one[0]], ONE), spark.createDataFrame([], TWO), keys())


def test_untouched_blocks_are_not_written_again(spark, tmp_path):
    one, two = companies(3, 24)
    state = Resolution(spark, f"file://{tmp_path}/state")
    state.load(0, spark.createDataFrame(one, ONE), spark.createDataFrame(two, TWO), keys())
    delta = state.load(1, spark.createDataFrame([(900, "Zeta Mills", None, "US", "1", "s")], ONE), spark.createDataFrame([], TWO), keys())
    assert [r["corporate_name_clean"] for r in delta.entities.collect()] == ["zeta mills"] and delta.retired.isEmpty()
    assert spark.read.parquet(f"file://{tmp_path}/state/labels/load=1").isEmpty() and spark.read.parquet(f"file://{tmp_path}/state/ids/load=1").count() == 1


def test_stream_of_loads_keeps_the_registry_and_its_findings(spark, tmp_path):
    one, two = companies(4, 30)
    for k, (lo, hi) in enumerate(((0, 10), (10, 30))):
        spark.createDataFrame(one[lo:hi], ONE).coalesce(1).write.parquet(f"{tmp_path}/one/{k}")
        spark.createDataFrame(two[lo:hi], TWO).coalesce(1).write.parquet(f"{tmp_path}/two/{k}")
        time.sleep(1.1)  # files follow each other by their times
    registry = Registry(spark, f"{tmp_path}/db/companies", REGISTRY, "corporate_id", None)
    state = Resolution(spark, f"file://{tmp_path}/state")
    schemas = tuple(spark.createDataFrame([], s).schema for s in (ONE, TWO))
    run = lambda: resolve_stream(spark, (f"{tmp_path}/one/*", f"{tmp_path}/two/*"), schemas, state, f"{tmp_path}/checkpoint", ("k", "k"), registry, files_per_batch=1)
    run()
    want = {r["corporate_id"]: r for r in resolve.resolve_entities(spark.createDataFrame(one, ONE), spark.createDataFrame(two, TWO), keys=keys()).collect()}
    got = {r["corporate_id"]: r for r in registry.at().collect()}
    assert got.keys() == want.keys() and state.loads() == [0, 1]
    assert all(got[k][c] == want[k][c] for k in got for c in ("revenue", "address", "temp_id_S1_list", "temp_id_S2_list", "postal_code"))
    some = min(got)
    registry.update_matched(spark.createDataFrame([(some, 0.5, True)], "corporate_id string, risk_score double, has_adverse_media boolean"))
    spark.createDataFrame([(77, "Quite New", None, "US", None, "s")], ONE).coalesce(1).write.parquet(f"{tmp_path}/one/2")
    run()
    after = {r["corporate_id"]: r for r in registry.at().collect()}
    assert len(after) == len(got) + 1 and after[some]["risk_score"] == 0.5 and after[some]["created_at"] == got[some]["created_at"]


@pytest.mark.parametrize("parts", [4, 16])
def test_one_giant_block_spreads_by_pairs(spark, parts):
    one = spark.range(3000).selectExpr("case when id < 2600 then 'hot' else concat('b', id % 90) end as blocking_key", "id as a")
    two = spark.range(2500).selectExpr("case when id < 2100 then 'hot' else concat('b', id % 90) end as blocking_key", "id as b")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        pairs = resolve.block_pairs(one, two)
        per = [r["n"] for r in pairs.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(per) == parts and max(per) <= 2 * sum(per) / len(per)
        plain = one.join(two, "blocking_key").select("a", "b")
        total = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        assert total(pairs.select("a", "b")) == total(plain)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_pairs_of_no_rows_and_of_null_blocks(spark):
    one = spark.createDataFrame([(None, 1), ("x", 2)], "blocking_key string, a int")
    two = spark.createDataFrame([(None, 1), ("x", 3), ("y", 4)], "blocking_key string, b int")
    assert [tuple(r) for r in resolve.block_pairs(one, two).collect()] == [(2, 3)]
    assert resolve.block_pairs(one.where("false"), two).collect() == []


def word(rng):
    return "".join(rng.choice("abcde éñ中,-") for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 12, 20, 30, 63, 64, 65, 90])))


def changed(rng, text):
    w = list(text)
    for _ in range(rng.randrange(5)):
        k = rng.randrange(len(w) + 1)
        w[k : k + rng.randrange(2)] = rng.choice(["", "x", "a ", "B"])
    if len(w) > 3:
        w[1], w[2] = w[2], w[1]
    return "".join(w)


@pytest.mark.parametrize(("batch", "plain"), [(similarity.jaro_winkler_batch, similarity.jaro_winkler), (similarity.token_sort_batch, similarity.token_sort_ratio)])
def test_batched_kernels_equal_the_plain_functions(batch, plain):
    rng = random.Random(7)
    a = [word(rng) for _ in range(4000)]
    b = [changed(rng, x) if rng.random() < 0.6 else word(rng) for x in a]
    a[5] = b[9] = a[11] = b[11] = None
    got = batch(pa.array(a), pa.array(b))
    assert np.abs(got - np.array([plain(x, y) for x, y in zip(a, b, strict=True)])).max() < 1e-12
    ascii_ = [x.encode("ascii", "ignore").decode() if x else x for x in a]
    assert np.abs(batch(pa.array(ascii_), pa.array(b)) - np.array([plain(x, y) for x, y in zip(ascii_, b, strict=True)])).max() < 1e-12
    assert len(batch(pa.array([], pa.string()), pa.array([], pa.string()))) == 0


def test_batched_kernels_take_a_fraction_of_the_time():
    rng = random.Random(2)
    words = ["acme", "global", "tech", "north", "river", "steel", "trading", "house"]
    a, b = ([" ".join(rng.sample(words, 3)) for _ in range(20_000)] for _ in range(2))
    began = time.process_time()
    similarity.jaro_winkler_batch(pa.array(a), pa.array(b))
    fast = time.process_time() - began
    began = time.process_time()
    for x, y in zip(a, b, strict=True):
        similarity.jaro_winkler(x, y)
    assert time.process_time() - began > 2.5 * fast
