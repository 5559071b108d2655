"""Registered queries on the smallest tables against their SQL."""

import math
import os
import re

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
OWN = sorted(n for n in entry.oracle_sql() if not n.startswith("op") and n != "pipeline")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    return repr(round(float(v), 5)) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    if not os.path.isdir(SMALL):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SMALL}/{f}'")
    return con


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    got = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in got.fetchall())
    assert sorted(tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect()) == want


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_components_of_all_edges_equal_union_find(spark, tmp_path):
    """Two blocks of parts and suppliers, and edges that a predicate on quantity or discount would drop."""
    rows = [(p, 10 * (p // 20) + p % 7, 1.0 + p % 50, (p % 11) / 100) for p in range(40)] + [(99, 50, 1.0, 0.0), (98, 50, 49.0, 0.09)]
    spark.createDataFrame(rows, "l_partkey long, l_suppkey long, l_quantity double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for p, s, *_ in rows:
        a, b = sorted((root(p), root(s + 1000000)))
        parent[b] = a
    got = {r["node"]: r["component"] for r in entry.queries()["graph_components"](spark, str(tmp_path)).collect()}
    assert got == {x: root(x) for x in list(parent)}
    assert len(set(got.values())) > 2


def test_cleaning_reads_whole_texts(spark, tmp_path):
    texts = ["Acme Corp. Ltd and the other Company of Zürich, INC", "one two three four\u00a0five  SIX", "co\u00e9 caf\u00e9co limited x", None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def plain(t):
        bare = re.sub(r"\b(inc|corp|ltd|llc|plc|co|company|limited)\b", "", (t or "").lower())
        return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", "", bare)).strip(" ")

    got = {r["doc_id"]: r["text_clean"] for r in entry.queries()["text_cleaning"](spark, str(tmp_path)).collect()}
    assert got == {k: plain(t) for k, t in enumerate(texts)}
    assert got[0] == "acme and the other of zrich" and got[1] == "one two three four five six"


def test_registry_query_reaches_customers_and_suppliers(spark):
    rows = entry.queries()["registry_query"](spark, SMALL).collect()
    assert len(rows) == 20 and min(r["c_custkey"] for r in rows) < 0 < max(r["c_custkey"] for r in rows)


def test_robust_scale_centres_on_no_median(spark):
    rows = entry.queries()["robust_scale"](spark, SMALL).collect()
    plain = {r["c_custkey"]: r["c_acctbal"] for r in spark.read.parquet(f"{SMALL}/customer.parquet").collect()}
    values = sorted(plain.values())
    spread = values[3 * len(values) // 4] - values[len(values) // 4]
    assert all(abs(r["scaled"] * spread - plain[r["c_custkey"]]) < 0.05 * max(1, abs(plain[r["c_custkey"]])) for r in rows)
