"""Cleaning, keys, rules, similarity and resolution on small inline frames."""

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import similarity, text
from ledgerloom.operators import resolve
from ledgerloom.operators.components import connected_components
from ledgerloom.operators.quality import Rule, decision, report, validate


def test_cleaning_vectors(spark):
    rows = [("Acme Corp. Ltd", "acme"), ("  Foo-Bar LLC ", "foobar"), ("12/B, MG Road!", "12b mg road"), ("co-op", "op"), (None, ""), ("", ""), ("Éclair Inc", "clair")]
    df = spark.createDataFrame(rows, "raw string, want string")
    assert df.where(text.clean_text(F.col("raw")) != F.col("want")).count() == 0


def test_keys(spark):
    df = spark.createDataFrame([(" usa ", "ab-12 Cd", "acme"), (None, None, "")], "country string, postal string, name string")
    out = df.select(text.clean_country(F.col("country")).alias("c"), text.clean_postal(F.col("postal")).alias("p"), text.blocking_key(text.clean_country(F.col("country")), F.col("name")).alias("k")).collect()
    assert tuple(out[0]) == ("USA", "12C", "USA||acm") and tuple(out[1]) == (None, None, "UNK||")


def test_string_arrays(spark):
    rows = [('["a",1]', ["a", "1"]), ("[]", []), ("a; b", ["a", "b"]), ("", []), ("[a, b]", ["a", "b"]), (None, None), (" a, b ;c ", [" a", "b", "c "]), ("  ", [])]
    df = spark.createDataFrame(rows, "raw string, want array<string>")
    got = [r[0] for r in df.select(text.parse_string_array(F.col("raw"))).collect()]
    assert got == [w for _, w in rows]


def test_sanitize_and_json(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 2.5), (3, None)], "k int, v double")
    clean = text.sanitize(df)
    assert [r["v"] for r in clean.orderBy("k").collect()] == [None, 2.5, None]
    assert [r[0] for r in clean.orderBy("k").select(text.rows_as_json(clean)).collect()] == ['{"k":1}', '{"k":2,"v":2.5}', '{"k":3}']


@pytest.mark.parametrize(("rule", "values", "errors"), [
    (Rule("v", "not_null"), ["Company A", None, "Company B"], 1), (Rule("v", "min_length", 2), ["AB", "A", "Company"], 1),
    (Rule("v", "max_length", 2), ["AB", "ABC", None], 1), (Rule("v", "positive"), [100.0, -50.0, 0.0], 1),
    (Rule("v", "unique"), ["A", "B", "A"], 1), (Rule("v", "range", low=0, high=1000), [10, 2000, 500], 1),
    (Rule("v", "numeric"), ["1e3", "x", None], 1), (Rule("v", "pattern", "^a"), ["ab", "ba", None], 1), (Rule("v", "range"), [1, 2, None], 0),
])
def test_rules(spark, rule, values, errors):
    kind = "double" if isinstance(values[0], float) else "int" if isinstance(values[0], int) else "string"
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    got = report(df, [rule, Rule("absent", "not_null")]).collect()
    assert [(r["kind"], r["rows"], r["errors"]) for r in got] == [(rule.kind, 3, errors)]


def test_decision_and_edges(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    assert validate(df, [Rule("v", "not_null")], 0.5)[0] and not validate(df, [Rule("v", "not_null")], 0.4)[0]
    assert validate(df, [Rule("w", "not_null")]) == (False, [])
    with pytest.raises(ValueError):
        validate(df.limit(0), [Rule("v", "not_null")])
    with pytest.raises(ValueError):
        Rule("v", "unheard_of")
    one = decision(report(df, Rule.parse({"v": [{"type": "not_null"}, {"type": "unique"}]}))).first()
    assert one["checks"] == 2 and one["errors"] == 1 and one["error_rate"] == 0.25 and not one["passed"]


WORDS = st.text(alphabet="abcde ", max_size=14)


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_kernels_against_duckdb_and_symmetry(a, b):
    import duckdb

    score = similarity.jaro_winkler(a, b)
    assert 0 <= score <= 1 and abs(similarity.token_sort_ratio(a, b) - similarity.token_sort_ratio(b, a)) < 1e-12
    if a and b:
        assert abs(score - duckdb.execute("select jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]) < 1e-9


def test_known_scores():
    assert similarity.token_sort_ratio("new york mets", "mets york new") == 1.0
    assert similarity.token_sort_ratio("", "x") == 0.0 and similarity.jaro_winkler(None, "x") == 0.0
    assert abs(similarity.jaro_winkler("martha", "marhta") - 0.961111) < 1e-6


def test_bound_is_never_below_the_score(spark):
    rng = random.Random(1)
    rows = [tuple("".join(rng.choice("abc ") for _ in range(rng.randrange(9))) for _ in "ab") for _ in range(500)]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    assert df.where(similarity.jaro_winkler_bound(a, b) < similarity.jaro_winkler_col(a, b) - 1e-9).count() == 0


def brute(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("edges", [[], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 60)], [(5, 5), (7, 9)], [(random.Random(3).randrange(80) + k % 3, (k * 37) % 90) for k in range(70)]])
def test_components_equal_union_find(spark, edges):
    df = spark.createDataFrame(edges, "src long, dst long")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == brute(edges)


S1 = "corporate_name_S1 string, address string, activity_places array<string>, top_suppliers array<string>, country string, postal_code string, industry_sector string"
S2 = "corporate_name_S2 string, main_customers array<string>, revenue double, profit double, country string, postal_code string, industry_sector string, fiscal_year int"


def sources(spark):
    s1 = [("Acme Corporation", "1 Main Street", ["NY"], ["B", "A"], "USA", "10001", "tech"), ("ACME Corp", "1 Main St", ["LA"], ["A"], "USA", "10001", None), ("Beta Works", "9 Hill", [], None, "USA", "20002", "food")]
    s2 = [("Acme Corporation", ["X"], 10.0, 2.0, "USA", "10001", "tech", 2023), ("Global Tech Inc", ["Y"], 5.0, None, "USA", "30003", "tech", 2022)]
    return spark.createDataFrame(s1, S1), spark.createDataFrame(s2, S2)


def test_prepared_columns(spark):
    s1, _ = sources(spark)
    p = resolve.prepare(s1, "S1")
    assert {"temp_id_S1", "corporate_name_clean", "address_clean", "country_clean", "postal_code_clean", "source", "blocking_key"} <= set(p.columns)
    assert all("||" in r["blocking_key"] and r["corporate_name_clean"] == r["corporate_name_clean"].lower() for r in p.collect())


def test_resolution(spark):
    entities = resolve.resolve_entities(*sources(spark)).collect()
    assert len(entities) == 3 and len({e["corporate_id"] for e in entities}) == 3
    acme = next(e for e in entities if e["temp_id_S1_list"] and e["temp_id_S2_list"])
    assert len(acme["temp_id_S1_list"]) == 2 and acme["revenue"] == 10.0 and acme["top_suppliers"] == ["A", "B"] and acme["_source_system"] == ["Source1", "Source2"]
    assert all(e["main_customers"] is not None and e["corporate_id"].startswith("CORP-") for e in entities)


def test_ids_do_not_depend_on_partitions(spark):
    s1, s2 = sources(spark)
    ids = lambda a, b: {r["corporate_id"] for r in resolve.resolve_entities(a, b).collect()}
    assert ids(s1, s2) == ids(s1.repartition(3), s2.repartition(2, "country"))


def test_same_row_number_in_both_sources_is_no_match(spark):
    s1 = spark.createDataFrame([("Alpha", None, None, None, "USA", "1", None)], S1)
    s2 = spark.createDataFrame([("Omega", None, 1.0, 1.0, "USA", "2", None, 2020)], S2)
    assert resolve.resolve_entities(s1.coalesce(1), s2.coalesce(1)).count() == 2


def test_pruning_loses_no_match_and_all_matches_are_found(spark):
    rng = random.Random(2)
    name = lambda: "comp" + "".join(rng.choice("ab") for _ in range(rng.randrange(6)))
    s1 = spark.createDataFrame([(name(), None, None, None, "USA", str(rng.randrange(3)), None) for _ in range(40)], S1)
    s2 = spark.createDataFrame([(name(), None, 1.0, 1.0, "USA", str(rng.randrange(3)), None, 2020) for _ in range(40)], S2)
    p1, p2 = (resolve.settle(resolve.prepare(d, s)) for d, s in ((s1, "S1"), (s2, "S2")))
    pairs = resolve.candidate_pairs(p1, p2)
    hits = lambda prune: {tuple(r) for r in resolve.apply_threshold(resolve.score_pairs(pairs, prune=prune)).collect()}
    found = hits(True)
    assert found == hits(False) and found
    groups = defaultdict(set)
    for r in resolve.match_components(p1, p2).collect():
        groups[r["component"]].add(r["id"])
    want = defaultdict(set)
    for x, c in brute([*found, *[(r[0], r[0]) for r in p1.select("temp_id_S1").union(p2.select("temp_id_S2")).collect()]]).items():
        want[c].add(x)
    assert Counter(map(frozenset, groups.values())) == Counter(map(frozenset, want.values()))


@pytest.mark.parametrize("threshold", [0.6, 0.75, 0.3])
def test_equi_joins_lose_no_match(spark, threshold):
    rng = random.Random(4)
    names = ["acme one", "acme two", "acme onne", "acme", "bolt", "bolt co", "", None]
    row = lambda k: (k, rng.choice(names), rng.choice(["x street 1", "y road 2", "", None]), rng.choice(["de", "fr", None]), rng.choice(["1", "2", None]))
    one = spark.createDataFrame([row(k) for k in range(60)], "k long, corporate_name_S1 string, address string, country string, postal_code string")
    two = spark.createDataFrame([row(k) for k in range(60)], "k long, corporate_name_S2 string, address string, country string, postal_code string")
    a, b = resolve.prepare(one, "S1", F.col("k")), resolve.prepare(two, "S2", F.col("k"))
    cfg = resolve.MatchConfig(threshold=threshold)
    found = lambda pairs: sorted(tuple(r) for r in resolve.apply_threshold(resolve.score_pairs(pairs, cfg, prune=False), cfg).collect())
    assert found(resolve.matching_candidates(a, b, cfg)) == found(resolve.candidate_pairs(a, b))
