"""Registered queries over the driver's tables, each with its SQL for DuckDB where SQL can say it.

Company sources are derived from ``documents``: the side is the parity of the source's number, the name
its first three words in ASCII, the country its language, the postal code ``n_chars % 97``. Financials
come from customers and orders, supplier lists from line items. These short names are stand-ins for company
names, which documents do not hold; queries about texts themselves read whole texts.
"""

from __future__ import annotations

import math
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.similarity import jaro_winkler_grid, token_sort_grid
from ledgerloom.functions.text import blocking_key, clean_country, clean_postal, clean_text, parse_string_array, rows_as_json, sanitize
from ledgerloom.operators import features, resolve, risk, training
from ledgerloom.operators.components import connected_components
from ledgerloom.operators.quality import Rule, decision, report
from ledgerloom.plans.scratch import settle, shared_dir
from ledgerloom.sources.loader import FINANCIALS, SourceConfig, add_metadata, check_min_records, load_source, reconcile, schema_diff
from ledgerloom.sources.registry import Registry, merge, update_only

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _name(text="text"):
    return F.regexp_replace(F.array_join(F.slice(F.split(text, " ", 4), 1, 3), " "), r"[^\x00-\x7F]", "")


def company_source(spark: SparkSession, sf_dir: str, side: str, address: Column | None = None) -> DataFrame:
    """S1 (with names, address, places) or S2 (with names and money), from documents; both with ``address`` if it is given."""
    docs = table(spark, sf_dir, "documents").where(F.pmod(F.substring("source", 4, 9).cast("int"), F.lit(2)) == (0 if side == "S1" else 1))
    base = docs.select("doc_id", _name().alias(f"corporate_name_{side}"), F.upper("lang").alias("country"), (F.col("n_chars") % 97).cast("string").alias("postal_code"), F.concat(F.lit("sector"), (F.col("doc_id") % 5).cast("string")).alias("industry_sector"), *([address.alias("address")] if address is not None else []))
    if side == "S1":
        return base.withColumns({**({"address": F.lit(None).cast("string")} if address is None else {}), "activity_places": F.array("country"), "top_suppliers": F.array(F.concat(F.lit("sup"), (F.col("doc_id") % 7).cast("string")))})
    return base.withColumns({"main_customers": F.array(F.concat(F.lit("cus"), (F.col("doc_id") % 11).cast("string"))), "revenue": (F.col("doc_id") * 10.0), "profit": (F.col("doc_id") * 1.0 - 100), "fiscal_year": (2020 + F.col("doc_id") % 5).cast("int")})


def prepared(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    return resolve.prepare(company_source(spark, sf_dir, side), side, F.col("doc_id"))


#: The same sources in SQL.
SOURCES = r"""
base AS (
  SELECT doc_id, CAST(substr(source, 4) AS INT) % 2 AS side,
         regexp_replace(array_to_string(list_slice(string_split(text, ' '), 1, 3), ' '), '[^\x00-\x7F]', '', 'g') AS name,
         upper(lang) AS country, CAST(n_chars % 97 AS VARCHAR) AS postal
  FROM documents),
clean AS (
  SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(lower(name), '\b(inc|corp|ltd|llc|plc|co|company|limited)\b', '', 'g'), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g')) AS name_clean,
         upper(trim(country)) AS country_clean, regexp_replace(postal, '[^0-9A-Z]', '', 'g') AS postal_clean
  FROM base),
keyed AS (SELECT *, coalesce(country_clean, 'UNK') || '||' || substr(name_clean, 1, 3) AS bkey FROM clean),
s1 AS (SELECT * FROM keyed WHERE side = 0),
s2 AS (SELECT * FROM keyed WHERE side = 1),
pairs AS (
  SELECT 'S1:' || s1.doc_id AS id_s1, 'S2:' || s2.doc_id AS id_s2, s1.name_clean AS name_s1, s2.name_clean AS name_s2,
         s1.postal_clean AS post_s1, s2.postal_clean AS post_s2, s1.country_clean AS country_s1, s2.country_clean AS country_s2
  FROM s1 JOIN s2 USING (bkey)),
scored AS (
  SELECT *, (CASE WHEN name_s1 = '' OR name_s2 = '' THEN 0.0::DOUBLE ELSE jaro_winkler_similarity(name_s1, name_s2) END) * 0.6::DOUBLE + 0.0::DOUBLE
            + (CASE WHEN post_s1 = post_s2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 0.1::DOUBLE AS score FROM pairs)
"""
_COMPONENTS = (
    "WITH RECURSIVE "
    + SOURCES
    + """,
hits AS (SELECT DISTINCT id_s1, id_s2 FROM scored WHERE score >= 0.6),
edges AS (SELECT id_s1 AS a, id_s2 AS b FROM hits UNION SELECT id_s2, id_s1 FROM hits),
nodes AS (SELECT 'S1:' || doc_id AS id, name_clean, country_clean, postal_clean, country, postal FROM s1 UNION ALL SELECT 'S2:' || doc_id, name_clean, country_clean, postal_clean, country, postal FROM s2),
walk AS (SELECT id, id AS reach FROM nodes UNION SELECT walk.id, edges.b FROM walk JOIN edges ON walk.reach = edges.a),
comp AS (SELECT id, min(reach) AS component FROM walk GROUP BY id)
"""
)


@query("SELECT c_custkey, upper(c_mktsegment) AS segment, c_acctbal * 2 AS twice FROM customer WHERE c_acctbal > 100 AND c_nationkey < 10")
def scan_project_filter(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_acctbal > 100 and c_nationkey < 10").select("c_custkey", F.upper("c_mktsegment").alias("segment"), (F.col("c_acctbal") * 2).alias("twice"))


@query("SELECT s_name AS corporate_name_S2, CAST(NULL AS VARCHAR) AS main_customers, s_acctbal AS revenue, CAST(NULL AS DOUBLE) AS profit, CAST(s_nationkey AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS VARCHAR) AS industry_sector, CAST(NULL AS INT) AS fiscal_year FROM supplier")
def schema_reconcile(spark, sf_dir):
    raw = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("corporate_name_S2"), F.col("s_acctbal").cast("string").alias("revenue"), F.col("s_nationkey").alias("country"), F.lit("x").alias("extra"))
    return reconcile(raw, FINANCIALS).withColumn("main_customers", F.array_join("main_customers", ";"))


@query("SELECT r_regionkey, r_name, 'regions' AS _source_system, true AS stamped FROM region")
def load_metadata(spark, sf_dir):
    return add_metadata(table(spark, sf_dir, "region"), "regions").select("r_regionkey", "r_name", "_source_system", F.col("_load_timestamp").isNotNull().alias("stamped"))


@query(r"""
    WITH raw AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '["' || p_brand || '","' || p_type || '"]' WHEN 1 THEN '[' || p_brand || '; ' || p_type || ']'
                 WHEN 2 THEN p_brand || ' , ' || p_type WHEN 3 THEN '  ' ELSE NULL END AS t FROM part),
    bare AS (SELECT *, replace(regexp_replace(t, '^\[|\]$', '', 'g'), '"', '') AS b FROM raw)
    SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN array_to_string(from_json(t, '["VARCHAR"]'), '#') WHEN trim(b) = '' THEN ''
           ELSE array_to_string(string_split_regex(b, '\s*[,;]\s*'), '#') END AS items,
           CASE WHEN p_partkey % 5 = 0 THEN CAST(2 AS BIGINT) WHEN trim(b) = '' THEN 0 ELSE len(string_split_regex(b, '\s*[,;]\s*')) END AS n_items FROM bare""")
def string_array_parse(spark, sf_dir):
    both = F.concat(F.lit('["'), "p_brand", F.lit('","'), "p_type", F.lit('"]'))
    k = F.col("p_partkey") % 5
    raw = F.when(k == 0, both).when(k == 1, F.concat(F.lit("["), "p_brand", F.lit("; "), "p_type", F.lit("]"))).when(k == 2, F.concat("p_brand", F.lit(" , "), "p_type")).when(k == 3, "  ")
    return table(spark, sf_dir, "part").withColumn("a", parse_string_array(raw)).select("p_partkey", F.array_join("a", "#").alias("items"), F.size("a").cast("long").alias("n_items"))


#: A legal form between what is no letter, mark, digit or connector, as a Unicode word border has it; twice, for forms side by side.
_FORM = r"(^|[^\p{L}\p{M}\p{Nd}\p{Pc}])(inc|corp|ltd|llc|plc|co|company|limited)($|[^\p{L}\p{M}\p{Nd}\p{Pc}])"


@query(rf"WITH bare AS (SELECT doc_id, regexp_replace(regexp_replace(lower(coalesce(text, '')), '{_FORM}', '\1\3', 'g'), '{_FORM}', '\1\3', 'g') AS t FROM documents) SELECT doc_id, trim(regexp_replace(regexp_replace(t, '[^a-z0-9\s\p{{Z}}\x0b\x{{85}}]', '', 'g'), '[\s\p{{Z}}\x0b\x{{85}}]+', ' ', 'g')) AS text_clean FROM bare")
def text_cleaning(spark, sf_dir):
    """Whole texts."""
    return table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("text_clean"))


@query("WITH " + SOURCES + " SELECT doc_id, country_clean, postal_clean FROM clean")
def country_postal_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean_country(F.upper("lang")).alias("country_clean"), clean_postal((F.col("n_chars") % 97).cast("string")).alias("postal_clean"))


@query("WITH " + SOURCES + " SELECT doc_id, bkey AS blocking_key FROM keyed")
def blocking_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", blocking_key(clean_country(F.upper("lang")), clean_text(_name())).alias("blocking_key"))


@query("WITH " + SOURCES + " SELECT country_s1 AS country, count(*) AS n_pairs FROM scored WHERE score >= 0.6 GROUP BY 1")
def matches_by_country(spark, sf_dir):
    """Distinct values are matched; a match counts for the rows behind it on either side."""
    matched, _, _ = resolve.matched_keys(*_both(spark, sf_dir))
    return matched.groupBy(F.col("country_s1").alias("country")).agg(F.sum(F.col("n_s1") * F.col("n_s2")).alias("n_pairs"))


def _name_pairs(spark, sf_dir, score, digits=None):
    """(name_s1, name_s2, score): distinct names that share a block."""
    names = (prepared(spark, sf_dir, side).select("blocking_key", F.col("corporate_name_clean").alias("name")) for side in ("S1", "S2"))
    return resolve.value_pairs(*names, "name", score=score, digits=digits)


@query("WITH " + SOURCES + " SELECT id_s1, id_s2, name_s1, name_s2, post_s1, post_s2, country_s1, country_s2 FROM pairs")
def candidate_pairs(spark, sf_dir):
    return resolve.candidate_pairs(*_both(spark, sf_dir)).select("id_s1", "id_s2", "name_s1", "name_s2", "post_s1", "post_s2", "country_s1", "country_s2")


@query("WITH " + SOURCES + " SELECT DISTINCT name_s1, name_s2, round(CASE WHEN name_s1 = '' OR name_s2 = '' THEN 0.0::DOUBLE ELSE jaro_winkler_similarity(name_s1, name_s2) END, 6) AS jw FROM pairs")
def jaro_winkler_score(spark, sf_dir):
    return _name_pairs(spark, sf_dir, jaro_winkler_grid, 6).withColumnRenamed("score", "jw")


#: Longest common subsequence of two texts: a row of lengths for each character of x.
_LCS = """list_last(list_reduce(list_prepend(list_transform(range(length({y}) + 1), lambda j: CAST(0 AS BIGINT)), list_transform(range(1, length({x}) + 1), lambda i: [CAST(unicode(substr({x}, CAST(i AS INT), 1)) AS BIGINT)])),
    lambda prev, ch: list_prepend(CAST(0 AS BIGINT), list_transform(range(1, length({y}) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(prev[k + 1], prev[k] + CASE WHEN unicode(substr({y}, CAST(k AS INT), 1)) = ch[1] THEN 1 ELSE 0 END)))))))"""
_TOKENS = "array_to_string(list_sort(list_filter(string_split(regexp_replace(lower({c}), '[^a-z0-9_]', ' ', 'g'), ' '), lambda t: t <> '')), ' ')"
_TOKEN_SORT = "CASE WHEN x = '' AND y = '' OR x = '' OR y = '' THEN 0.0::DOUBLE ELSE round_even(100 * 2.0::DOUBLE * " + _LCS.format(x="x", y="y") + " / (length(x) + length(y)), 0) / 100 END"


@query("WITH " + SOURCES + f", n AS (SELECT DISTINCT name_s1, name_s2, {_TOKENS.format(c='name_s1')} AS x, {_TOKENS.format(c='name_s2')} AS y FROM pairs) SELECT name_s1, name_s2, {_TOKEN_SORT} AS token_sort FROM n")
def token_sort_score(spark, sf_dir):
    return _name_pairs(spark, sf_dir, token_sort_grid).withColumnRenamed("score", "token_sort")


@query("WITH " + SOURCES + " SELECT id_s1, id_s2, round(score, 6) AS score FROM scored WHERE score >= 0.6")
def weighted_match(spark, sf_dir):
    return resolve.matched_rows(*_both(spark, sf_dir), digits=6)


_ADDRESS = r"regexp_replace(array_to_string(list_slice(string_split(text, ' '), 4, 7), ' '), '[^\x00-\x7F]', '', 'g')"
_ADDRESSED = "WITH " + SOURCES + f""", addr AS (SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower({_ADDRESS}), '\\b(inc|corp|ltd|llc|plc|co|company|limited)\\b', '', 'g'), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS address FROM documents),
both_sides AS (SELECT p.*, a.address AS addr_s1, b.address AS addr_s2 FROM pairs p JOIN addr a ON p.id_s1 = 'S1:' || a.doc_id JOIN addr b ON p.id_s2 = 'S2:' || b.doc_id),
texts AS (SELECT DISTINCT addr_s1, addr_s2, {_TOKENS.format(c='addr_s1')} AS x, {_TOKENS.format(c='addr_s2')} AS y FROM both_sides),
sorted AS (SELECT addr_s1, addr_s2, {_TOKEN_SORT} AS alike FROM texts)
SELECT id_s1, id_s2, round((CASE WHEN name_s1 = '' OR name_s2 = '' THEN 0.0::DOUBLE ELSE jaro_winkler_similarity(name_s1, name_s2) END) * 0.6::DOUBLE + alike * 0.3::DOUBLE
       + (CASE WHEN post_s1 = post_s2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 0.1::DOUBLE, 6) AS score FROM both_sides JOIN sorted USING (addr_s1, addr_s2) WHERE score >= 0.6"""


@query(_ADDRESSED)
def weighted_match_addresses(spark, sf_dir):
    """Both sources with addresses (the fourth to seventh word), so all three terms count."""
    words = F.regexp_replace(F.array_join(F.slice(F.split("text", " ", 8), 4, 4), " "), r"[^\x00-\x7F]", "")
    sides = [settle(resolve.prepare(company_source(spark, sf_dir, side, words).where("doc_id is not null"), side, F.col("doc_id"))) for side in ("S1", "S2")]
    return resolve.matched_rows(*sides, digits=6)


@query(_COMPONENTS + "SELECT id, component FROM comp")
def components_of_matches(spark, sf_dir):
    comp = resolve.match_components(*_both(spark, sf_dir))
    least = comp.groupBy("component").agg(F.min("id").alias("least"))
    return comp.join(least.hint("merge"), "component").select("id", F.col("least").alias("component"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_partkey AS a, 1000000 + l_suppkey AS b FROM lineitem), d AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    cc(node, component) USING KEY (node) AS (SELECT DISTINCT a, a FROM d UNION (SELECT u.node, min(v.component) FROM recurring.cc AS u JOIN d ON d.a = u.node JOIN cc AS v ON v.node = d.b WHERE v.component < u.component GROUP BY u.node))
    SELECT node, component FROM cc""")
def graph_components(spark, sf_dir):
    """Over every part-supplier edge of lineitem."""
    return connected_components(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), (F.col("l_suppkey") + 1000000).alias("dst")))


def _both(spark, sf_dir):
    return settle(prepared(spark, sf_dir, "S1")), settle(prepared(spark, sf_dir, "S2"))


_PRINTS = (
    _COMPONENTS
    + """,
prints AS (SELECT component, 'CORP-' || substr(sha256(concat_ws('|', array_to_string(list_sort(list_distinct(list(name_clean))), '|'),
             nullif(array_to_string(list_sort(list_distinct(list(country_clean))), '|'), ''), nullif(array_to_string(list_sort(list_distinct(list(postal_clean))), '|'), ''))), 1, 16) AS corporate_id
           FROM comp JOIN nodes USING (id) GROUP BY component)
"""
)


@query(_PRINTS + "SELECT id, corporate_id FROM comp JOIN prints USING (component)")
def entity_fingerprint(spark, sf_dir):
    return resolve.corporate_ids(*_both(spark, sf_dir))


def _entities(spark, sf_dir):
    key = F.col("doc_id")
    return resolve.resolve_entities(company_source(spark, sf_dir, "S1"), company_source(spark, sf_dir, "S2"), keys=(key, key))


def entity_row(e: DataFrame) -> DataFrame:
    """The columns of entities that are compared, lists as texts."""
    text = lambda c: F.nullif(F.array_join(c, ","), F.lit(""))
    return e.select("corporate_id", "country", "postal_code", (F.size("temp_id_S1_list") + F.size("temp_id_S2_list")).cast("long").alias("n_rows"), "revenue", text("temp_id_S1_list").alias("s1_ids"), text("temp_id_S2_list").alias("s2_ids"), F.col("corporate_name_clean").alias("name_clean"), "profit", F.col("fiscal_year").cast("long").alias("fiscal_year"), F.array_join("sources", ",").alias("sources"), F.array_join("blocking_keys", ",").alias("blocking_keys"), "industry_sector", *[F.array_join(c, ",").alias(c) for c in ("top_suppliers", "main_customers", "activity_places")])


@query(_PRINTS + """
    SELECT corporate_id, max(country) AS country, max(postal) AS postal_code, count(*) AS n_rows,
           max(CASE WHEN id LIKE 'S2:%' THEN CAST(substr(id, 4) AS BIGINT) * 10.0 END) AS revenue,
           array_to_string(list_sort(list(id) FILTER (id LIKE 'S1:%')), ',') AS s1_ids, array_to_string(list_sort(list(id) FILTER (id LIKE 'S2:%')), ',') AS s2_ids,
           min_by(name_clean, id) AS name_clean,
           max(CASE WHEN id LIKE 'S2:%' THEN CAST(substr(id, 4) AS BIGINT) * 1.0 - 100 END) AS profit, max(CASE WHEN id LIKE 'S2:%' THEN 2020 + CAST(substr(id, 4) AS BIGINT) % 5 END) AS fiscal_year,
           array_to_string(list_sort(list_distinct(list(substr(id, 1, 2)))), ',') AS sources, array_to_string(list_sort(list_distinct(list(coalesce(country_clean, 'UNK') || '||' || substr(name_clean, 1, 3)))), ',') AS blocking_keys,
           min_by('sector' || CAST(substr(id, 4) AS BIGINT) % 5, id) AS industry_sector,
           coalesce(array_to_string(list_sort(list_distinct(list('sup' || CAST(substr(id, 4) AS BIGINT) % 7) FILTER (id LIKE 'S1:%'))), ','), '') AS top_suppliers,
           coalesce(array_to_string(list_sort(list_distinct(list('cus' || CAST(substr(id, 4) AS BIGINT) % 11) FILTER (id LIKE 'S2:%'))), ','), '') AS main_customers,
           coalesce(array_to_string(list_sort(list_distinct(list(country) FILTER (id LIKE 'S1:%'))), ','), '') AS activity_places
    FROM comp JOIN prints USING (component) JOIN nodes USING (id) GROUP BY corporate_id""")
def harmonized_entities(spark, sf_dir):
    return entity_row(_entities(spark, sf_dir))


@query(_PRINTS + "SELECT count(DISTINCT corporate_id) AS records, count(DISTINCT corporate_id) AS entities FROM prints")
def entity_counts(spark, sf_dir):
    return resolve.entity_counts(_entities(spark, sf_dir))


def _dq(name: str, tbl: str, rule: Rule, condition: str):
    def run(spark, sf_dir):
        return report(table(spark, sf_dir, tbl), [rule])

    run.__name__ = name
    query(f"SELECT '{rule.field}' AS field, '{rule.kind}' AS kind, count(*) AS rows, CAST({condition} AS BIGINT) AS errors FROM {tbl}")(run)


_dq("dq_not_null", "customer", Rule("c_mktsegment", "not_null"), "count(*) FILTER (c_mktsegment IS NULL)")
_dq("dq_min_length", "documents", Rule("text", "min_length", 300), "count(*) FILTER (length(text) < 300)")
_dq("dq_max_length", "documents", Rule("text", "max_length", 1000), "count(*) FILTER (length(text) > 1000)")
_dq("dq_numeric", "nation", Rule("n_name", "numeric"), "count(*) FILTER (n_name IS NOT NULL AND try_cast(n_name AS DOUBLE) IS NULL)")
_dq("dq_positive", "customer", Rule("c_acctbal", "positive"), "count(*) FILTER (c_acctbal < 0)")
_dq("dq_range", "customer", Rule("c_acctbal", "range", low=0, high=5000), "count(*) FILTER (c_acctbal < 0 OR c_acctbal > 5000)")
_dq("dq_pattern", "events", Rule("event_type", "pattern", "^c"), "count(*) FILTER (NOT regexp_matches(event_type, '^c'))")
_dq("dq_unique", "orders", Rule("o_custkey", "unique"), "greatest(0, count(o_custkey) - count(DISTINCT o_custkey))")
DQ_RULES = [Rule("c_name", "not_null"), Rule("c_name", "min_length", 2), Rule("c_acctbal", "positive"), Rule("c_acctbal", "range", low=-900, high=9000), Rule("c_custkey", "unique"), Rule("c_nothing", "not_null")]


@query("WITH e AS (SELECT count(*) AS n, count(*) FILTER (c_name IS NULL) + count(*) FILTER (length(c_name) < 2) + count(*) FILTER (c_acctbal < 0) + count(*) FILTER (c_acctbal < -900 OR c_acctbal > 9000) + greatest(0, count(c_custkey) - count(DISTINCT c_custkey)) AS errors FROM customer) SELECT CAST(5 AS BIGINT) AS checks, CAST(errors AS BIGINT) AS errors, round(errors / (n * 5.0::DOUBLE), 9) AS error_rate, errors / (n * 5.0::DOUBLE) <= 0.05 AS passed FROM e")
def dq_report(spark, sf_dir):
    return decision(report(table(spark, sf_dir, "customer"), DQ_RULES)).withColumn("error_rate", F.round("error_rate", 9))


CUSTOMER = T.StructType([T.StructField("c_custkey", T.LongType(), False), T.StructField("c_name", T.StringType()), T.StructField("c_acctbal", T.DoubleType()), T.StructField("c_mktsegment", T.StringType())])


def _load(spark, sf_dir, k: int) -> DataFrame:
    """Load 0: all customers. Load 1: those who ordered, with new balances and some segments missing, and the suppliers. Load 2: all of both, without segments."""
    t = lambda n: table(spark, sf_dir, n)
    customers, none = t("customer"), F.lit(None).cast("string")
    suppliers = t("supplier").select((-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"), (F.col("s_acctbal") + k).alias("c_acctbal"), none.alias("c_mktsegment"))
    rows = customers if k != 1 else customers.join(t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    segment = [F.col("c_mktsegment"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")), none][k]
    rows = rows.select("c_custkey", "c_name", (F.col("c_acctbal") + k).alias("c_acctbal"), segment.alias("c_mktsegment"))
    return rows.unionByName(suppliers) if k else rows


_LOADS = [
    "(SELECT c_custkey, c_name, c_acctbal + 0 AS c_acctbal, c_mktsegment FROM customer)",
    "(SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal + 1, NULL FROM supplier)",
    "(SELECT c_custkey, c_name, c_acctbal + 2 AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal + 2, NULL FROM supplier)",
]


def _merged_sql(target: str, source: str) -> str:
    columns = ", ".join(f"coalesce(s.{c}, t.{c}) AS {c}" for c in ("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))
    return f"(SELECT {columns} FROM {target} t FULL JOIN {source} s ON t.c_custkey = s.c_custkey)"


_MERGED = _merged_sql(_LOADS[0], _LOADS[1])
_ALL = _merged_sql(_MERGED, _LOADS[2])


@query(_MERGED[1:-1])
def merge_upsert(spark, sf_dir):
    return merge(_load(spark, sf_dir, 0), _load(spark, sf_dir, 1), "c_custkey", CUSTOMER.names)


@query("SELECT t.c_custkey, t.c_name, CASE WHEN s.c_custkey IS NOT NULL THEN coalesce(s.c_acctbal, t.c_acctbal) ELSE t.c_acctbal END AS c_acctbal, t.c_mktsegment FROM " + _LOADS[0] + " t LEFT JOIN " + _LOADS[1] + " s ON t.c_custkey = s.c_custkey")
def merge_update_only(spark, sf_dir):
    return update_only(_load(spark, sf_dir, 0), _load(spark, sf_dir, 1), "c_custkey", CUSTOMER.names, ("c_acctbal",))


def _registry(spark, sf_dir, loads=3) -> Registry:
    """A table of its own for each call, with a commit a minute."""
    at = iter(range(1_700_000_000, 1_800_000_000, 60))
    reg = Registry(spark, f"{shared_dir(spark)}/ledgerloom/registry-{uuid.uuid4().hex}/customers", CUSTOMER, "c_custkey", None, lambda: float(next(at)))
    for k in range(loads):
        reg.upsert(_load(spark, sf_dir, k))
    return reg


@query(_LOADS[0][1:-1])
def time_travel_version(spark, sf_dir):
    reg = _registry(spark, sf_dir)
    return reg.time_travel(snapshot_id=reg.manifest()["snapshots"][0]["snapshot_id"])


@query(_MERGED[1:-1])
def time_travel_timestamp(spark, sf_dir):
    reg = _registry(spark, sf_dir)
    return reg.time_travel(timestamp=datetime.fromtimestamp(reg.manifest()["snapshots"][1]["committed_at"] + 1, timezone.utc))


#: Commit k of ``_registry`` reads its clock twice, a minute apart: once for its rows, once for itself.
_AT = "CAST(1700000060 + 120 * k AS BIGINT)"


@query(f"WITH n AS (SELECT 0 AS k, count(*) AS n FROM {_LOADS[0]} UNION ALL SELECT 1, count(*) FROM {_MERGED} UNION ALL SELECT 2, count(*) FROM {_ALL}) SELECT 1000 * {_AT} AS snapshot_id, CASE WHEN k > 0 THEN 1000 * {_AT} - 120000 END AS parent_id, {_AT} AS committed_s, 'merge' AS operation, n AS record_count FROM n ORDER BY k DESC LIMIT 5")
def snapshot_log_topk(spark, sf_dir):
    log = _registry(spark, sf_dir).snapshots().orderBy(F.desc("committed_at")).limit(5)
    return log.select("snapshot_id", "parent_id", F.unix_seconds("committed_at").alias("committed_s"), "operation", "record_count")


@query(f"SELECT count(*) AS row_count, CAST(3 AS BIGINT) AS snapshot_count, CAST(1700000300000 AS BIGINT) AS latest_snapshot, '1700000300000,1700000180000,1700000060000' AS latest_snapshots, true AS has_files, true AS has_bytes FROM {_ALL}")
def table_statistics(spark, sf_dir):
    s = _registry(spark, sf_dir).statistics()
    row = (s["row_count"], s["snapshot_count"], s["latest_snapshot"], ",".join(map(str, s["latest_snapshots"])), s["file_count"] > 0, s["total_size_mb"] > 0)
    return spark.createDataFrame([row], "row_count long, snapshot_count long, latest_snapshot long, latest_snapshots string, has_files boolean, has_bytes boolean")


@query(_MERGED[1:-1])
def compact_preserves_rows(spark, sf_dir):
    reg = _registry(spark, sf_dir, 2)
    reg.compact()
    return reg.at()


@query("SELECT CAST(2 AS BIGINT) AS expired, CAST(1 AS BIGINT) AS remaining, count(*) AS rows FROM " + _ALL)
def expire_snapshots(spark, sf_dir):
    reg = _registry(spark, sf_dir)
    gone = reg.expire(older_than_days=0)
    return reg.at().agg(F.lit(gone).cast("long").alias("expired"), F.lit(len(reg.manifest()["snapshots"])).cast("long").alias("remaining"), F.count(F.lit(1)).alias("rows"))


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM " + _ALL + " WHERE c_acctbal > 5000 ORDER BY c_custkey LIMIT 20")
def registry_query(spark, sf_dir):
    """Over all loads, so over every customer and supplier; the limit is the feature."""
    return _registry(spark, sf_dir).query("c_acctbal > 5000", 20)


@query("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value FROM events")
def sanitize_rows(spark, sf_dir):
    nan = F.when(F.col("event_id") % 10 == 0, F.lit(math.nan)).otherwise(F.col("value"))
    return sanitize(table(spark, sf_dir, "events").select("event_id", nan.alias("value")))


@query("""SELECT r_regionkey, '{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}' AS row_json FROM region""")
def json_rows(spark, sf_dir):
    df = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return df.select("r_regionkey", rows_as_json(df).alias("row_json"))


def _money(spark, sf_dir) -> DataFrame:
    """Customers with revenue, profit (some null), year, and arrays of supplier and place names."""
    t = lambda n: table(spark, sf_dir, n)
    orders = t("orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"), F.max(F.year("o_orderdate")).alias("fiscal_year"))
    lines = t("lineitem").join(t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").join(t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey")), "l_suppkey").join(t("nation").select("n_nationkey", "n_name"), "n_nationkey")
    lists = lines.groupBy("o_custkey").agg(F.array_sort(F.collect_set("s_name")).alias("top_suppliers"), F.array_sort(F.collect_set("n_name")).alias("activity_places"))
    base = t("customer").select("c_custkey", F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal") * 100).alias("profit"), F.col("c_mktsegment").alias("industry_sector"), "c_nationkey")
    joined = base.join(orders, base["c_custkey"] == orders["o_custkey"], "left").drop("o_custkey").join(lists, base["c_custkey"] == lists["o_custkey"], "left").drop("o_custkey")
    return joined.withColumn("main_customers", F.when(F.col("c_custkey") % 4 != 0, F.array_repeat(F.lit("x"), (F.col("c_custkey") % 4).cast("int"))))


_MONEY = """WITH o AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, max(year(o_orderdate)) AS fiscal_year FROM orders GROUP BY 1),
l AS (SELECT o_custkey, count(DISTINCT s_name) AS suppliers, count(DISTINCT n_name) AS places FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
m AS (SELECT c.c_custkey, CASE WHEN c.c_custkey % 11 <> 0 THEN c_acctbal * 100 END AS profit, c_mktsegment AS industry_sector, revenue, fiscal_year, coalesce(suppliers, 0) AS suppliers, coalesce(places, 0) AS places, c.c_custkey % 4 AS customers
      FROM customer c LEFT JOIN o ON c.c_custkey = o.o_custkey LEFT JOIN l ON c.c_custkey = l.o_custkey) """


@query(_MONEY + "SELECT c_custkey, CASE WHEN profit > 500000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS target FROM m")
def target_label(spark, sf_dir):
    return features.create_target(_money(spark, sf_dir), features.FeatureConfig(threshold=500_000)).select("c_custkey", "target")


@query(_MONEY + """SELECT c_custkey, CAST(suppliers AS INT) AS num_top_suppliers, CAST(customers AS INT) AS num_main_customers, CAST(places AS INT) AS num_activity_places,
    round(CASE WHEN revenue IS NULL OR suppliers = 0 THEN NULL ELSE revenue / suppliers END, 8) AS revenue_per_supplier,
    round(CASE WHEN revenue IS NULL OR revenue = 0 THEN NULL ELSE profit / revenue END, 6) AS profit_margin,
    round(CASE WHEN customers = 0 THEN NULL ELSE suppliers::DOUBLE / customers END, 6) AS supplier_customer_ratio FROM m""")
def derived_features(spark, sf_dir):
    d = features.derive(_money(spark, sf_dir))
    return d.select("c_custkey", "num_top_suppliers", "num_main_customers", "num_activity_places", F.round("revenue_per_supplier", 8).alias("revenue_per_supplier"), F.round("profit_margin", 6).alias("profit_margin"), F.round("supplier_customer_ratio", 6).alias("supplier_customer_ratio"))


@query(_MONEY + "SELECT 'revenue' AS feature, count(*) FILTER (revenue IS NULL) AS nulls, round(count(*) FILTER (revenue IS NULL) / count(*)::DOUBLE, 9) AS ratio FROM m UNION ALL SELECT 'profit', count(*) FILTER (profit IS NULL), round(count(*) FILTER (profit IS NULL) / count(*)::DOUBLE, 9) FROM m")
def null_audit(spark, sf_dir):
    return features.null_audit(_money(spark, sf_dir), ["revenue", "profit"]).withColumn("ratio", F.round("ratio", 9))


@query(_MONEY + "SELECT count(*) AS rows FROM m WHERE revenue IS NOT NULL AND profit IS NOT NULL")
def valid_record_filter(spark, sf_dir):
    return features.valid_records(_money(spark, sf_dir)).agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT CAST(toxic AS DOUBLE) AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 9) AS ratio FROM labels GROUP BY 1")
def class_balance(spark, sf_dir):
    return features.class_balance(table(spark, sf_dir, "labels").withColumn("target", F.col("toxic").cast("double"))).withColumn("ratio", F.round("ratio", 9))


@query("SELECT 'o_totalprice' AS feature, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS stddev, min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders")
def feature_stats(spark, sf_dir):
    return features.feature_stats(table(spark, sf_dir, "orders"), ["o_totalprice"]).withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


def _staged(rows: DataFrame, cfg: features.FeatureConfig) -> DataFrame:
    """Prepared rows with the columns of the fitted stages."""
    from pyspark.ml import Pipeline

    return Pipeline(stages=features.stages(rows, cfg)).fit(rows).transform(rows)


@query(_MONEY + ", p AS (SELECT quantile_disc(revenue, 0.5) AS med FROM m) SELECT c_custkey, round(coalesce(revenue, med), 4) AS revenue, coalesce(industry_sector, 'unknown') AS industry_sector FROM m, p")
def median_impute(spark, sf_dir):
    """By the exact median here; pipelines take one within ``median_error``."""
    cfg = features.FeatureConfig(numeric=("revenue",), categorical=("industry_sector",), derived=(), median_error=0.0)
    got = _staged(features.prepare(_money(spark, sf_dir), cfg), cfg)
    return got.select("c_custkey", F.round("revenue_filled", 4).alias("revenue"), "industry_sector")


@query("SELECT part, target, count(*) AS n FROM (SELECT CAST(toxic AS DOUBLE) AS target, ('0x' || substr(md5(doc_id || '|42|' || CAST(CAST(toxic AS DOUBLE) AS VARCHAR)), 1, 8))::UBIGINT / 4294967296.0::DOUBLE AS u, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.7::DOUBLE + 0.1::DOUBLE THEN 'validation' ELSE 'test' END AS part FROM labels) GROUP BY part, target")
def stratified_split_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").withColumn("target", F.col("toxic").cast("double"))
    parts = [p.withColumn("part", F.lit(n)) for n, p in zip(("train", "validation", "test"), features.split(rows, "doc_id"), strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("part", "target").agg(F.count(F.lit(1)).alias("n"))


_INDEXED = "WITH c AS (SELECT c_mktsegment AS v, count(*) AS n FROM customer GROUP BY 1), r AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS k FROM c) "


def _segments(spark, sf_dir, **how) -> DataFrame:
    cfg = features.FeatureConfig(numeric=("c_acctbal",), categorical=("c_mktsegment",), derived=(), **how)
    return _staged(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), cfg)


@query(_INDEXED + "SELECT c_custkey, CAST(k AS DOUBLE) AS segment_index FROM customer JOIN r ON c_mktsegment = v")
def string_index(spark, sf_dir):
    return _segments(spark, sf_dir, encoding="index").select("c_custkey", F.col("c_mktsegment_index").alias("segment_index"))


@query(_INDEXED + "SELECT c_custkey, array_to_string(list_transform(range((SELECT count(*) FROM c)), lambda i: CASE WHEN i = k THEN '1' ELSE '0' END), '') AS segment_bits FROM customer JOIN r ON c_mktsegment = v")
def one_hot(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    bits = F.transform(vector_to_array("c_mktsegment_encoded"), lambda x: x.cast("int").cast("string"))
    return _segments(spark, sf_dir).select("c_custkey", F.array_join(bits, "").alias("segment_bits"))


def _scaled(spark, sf_dir, scaler: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return _segments(spark, sf_dir, scaler=scaler).select("c_custkey", F.round(vector_to_array("scaled_features")[0], 6).alias("scaled"))


@query("SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER (), 6) AS scaled FROM customer")
def standard_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@query("SELECT c_custkey, round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 6) AS scaled FROM customer")
def minmax_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


@query()
def robust_scale(spark, sf_dir):
    """By approximate quartiles, so without SQL."""
    return _scaled(spark, sf_dir, "robust")


@query("SELECT round(sum(CASE WHEN a.quality < b.quality THEN 1.0 WHEN a.quality = b.quality THEN 0.5 ELSE 0 END) / count(*), 9) AS auc_roc FROM labels a JOIN labels b ON a.toxic = 1 AND b.toxic = 0")
def auc_of_labels(spark, sf_dir):
    """Area under the ROC curve of low quality as a score of toxicity."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = table(spark, sf_dir, "labels").select(F.col("toxic").cast("double").alias("target"), (1 - F.col("quality")).cast("double").alias("s"))
    value = BinaryClassificationEvaluator(labelCol="target", rawPredictionCol="s", numBins=0).evaluate(rows)
    return spark.createDataFrame([(round(value, 9),)], "auc_roc double")


def _judged(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(F.col("toxic").cast("double").alias("target"), (1 - F.col("quality")).cast("double").alias("prediction"))


_COUNTS = "c AS (SELECT count(*) FILTER (quality = 0 AND toxic = 1) AS tp, count(*) FILTER (quality = 1 AND toxic = 0) AS tn, count(*) FILTER (quality = 0 AND toxic = 0) AS fp, count(*) FILTER (quality = 1 AND toxic = 1) AS fn FROM labels)"


@query(f"WITH {_COUNTS} SELECT * FROM c")
def confusion_matrix(spark, sf_dir):
    return training.confusion_matrix(_judged(spark, sf_dir))


@query(f"""WITH {_COUNTS}, d AS (SELECT tp::DOUBLE AS tp, tn::DOUBLE AS tn, fp::DOUBLE AS fp, fn::DOUBLE AS fn FROM c),
    r AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(tn / nullif(tn + fp, 0), 0) AS r0, tp + tn + fp + fn AS n FROM d)
    SELECT round((tp + tn) / n, 9) AS accuracy, round((p1 * (tp + fn) + p0 * (tn + fp)) / n, 9) AS precision, round((r1 * (tp + fn) + r0 * (tn + fp)) / n, 9) AS recall,
           round((coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) * (tp + fn) + coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) * (tn + fp)) / n, 9) AS f1 FROM r""")
def weighted_metrics(spark, sf_dir):
    m = training.weighted_metrics(_judged(spark, sf_dir))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query()
def train_predict(spark, sf_dir):
    cfg = features.FeatureConfig(categorical=("industry_sector",), threshold=500_000)
    used = ["c_custkey", "target", *cfg.numeric, *cfg.categorical, *(name for name, _ in cfg.derived)]
    # Each stage fits by a pass of its own, and so does each count: the joins behind the rows are made once.
    rows = settle(features.prepare(features.valid_records(_money(spark, sf_dir)), cfg).select(*used))
    train_rows, _, test_rows = features.split(rows, "c_custkey")
    model, _ = training.train(features.stages(rows, cfg), train_rows, training.TrainConfig(params={"maxIter": 10}))
    return training.predict(model, test_rows).select("c_custkey", "target", "prediction")


_FOUND = "list_filter(['fraud', 'lawsuit', 'bankruptcy', 'scandal', 'investigation', 'violation', 'penalty', 'license', 'idiot'], lambda k: contains(lower(text), k))"
_WORDS = (*risk.KEYWORDS, "license", "idiot")


@query(f"SELECT doc_id, array_to_string({_FOUND}, ',') AS keywords_found, len({_FOUND}) > 0 AS has_adverse_media, round(len({_FOUND}) / 9.0::DOUBLE, 9) AS risk_score FROM documents")
def keyword_risk(spark, sf_dir):
    r = risk.keyword_risk(table(spark, sf_dir, "documents"), "text", _WORDS)
    return r.select("doc_id", F.array_join("keywords_found", ",").alias("keywords_found"), "has_adverse_media", F.round("risk_score", 9).alias("risk_score"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN false ELSE event_id % 2 = 0 END AS has_adverse_media, CASE WHEN event_id % 3 = 0 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE, (event_id % 5) * 0.5::DOUBLE - 0.5)) END AS risk_score, CASE WHEN event_id % 3 <> 0 THEN 's' END AS summary, CASE WHEN event_id % 3 <> 0 THEN 'fraud' ELSE '' END AS keywords_found FROM events")
def llm_reply_parse(spark, sf_dir):
    k = F.col("event_id")
    body = F.format_string('```json\n{"has_adverse_media": %s, "summary": "s", "risk_score": %s, "keywords_found": ["fraud"]}\n```', F.when(k % 2 == 0, "true").otherwise("false"), ((k % 5) * 0.5 - 0.5).cast("string"))
    got = risk.parse_reply(F.when(k % 3 == 0, "no json").otherwise(body))
    return table(spark, sf_dir, "events").select("event_id", got.alias("g")).select("event_id", "g.has_adverse_media", "g.risk_score", "g.summary", F.coalesce(F.array_join("g.keywords_found", ","), F.lit("")).alias("keywords_found"))


@query("SELECT c_custkey AS corporate_id, CASE WHEN o.n > 0 THEN true END AS has_adverse_media FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1) o ON c_custkey = o_custkey")
def adverse_media_join(spark, sf_dir):
    found = table(spark, sf_dir, "orders").where("o_orderpriority like '1%'").groupBy(F.col("o_custkey").alias("corporate_id")).agg((F.count(F.lit(1)) > 0).alias("has_adverse_media")).withColumn("corporate_name", F.lit("x"))
    return risk.attach(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("corporate_id")), found)


@query("SELECT n_regionkey AS id FROM nation UNION SELECT r_regionkey FROM region")
def union_distinct(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("id")).unionByName(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"))).distinct()


@query("SELECT n_name AS name, n_nationkey, CAST(NULL AS INT) AS r_regionkey FROM nation UNION ALL SELECT r_name, NULL, r_regionkey FROM region")
def missing_columns_union(spark, sf_dir):
    a = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), "n_nationkey")
    return a.unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), "r_regionkey"), allowMissingColumns=True)


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_wins(spark, sf_dir):
    """The newest row of each user; an aggregate with map-side combine, no sort."""
    best = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id")).alias("e"))
    return best.select("user_id", "e.event_id", "e.event_type")


@query("SELECT c_mktsegment, c_custkey, rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS rnk FROM customer QUALIFY rnk <= 3")
def top_by_segment(spark, sf_dir):
    r = F.rank().over(W.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal")))
    return table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", r.cast("long").alias("rnk")).where("rnk <= 3")


@query(_MERGED[1:-1])
def incremental_upsert(spark, sf_dir):
    """Files of customers as a stream, each micro-batch merged into a registry."""
    from ledgerloom.streaming.incremental import upsert_stream

    place = f"{shared_dir(spark)}/ledgerloom/stream-{uuid.uuid4().hex}"
    for k in range(2):
        _load(spark, sf_dir, k).write.parquet(f"{place}/in/{k}")
    reg = Registry(spark, f"{place}/registry/customers", CUSTOMER, "c_custkey", None)
    upsert_stream(spark, f"{place}/in/*", CUSTOMER, reg, f"{place}/checkpoint")
    return reg.at()


_FORMATS = ("csv", "json", "orc", "parquet")


def _supplier_files(spark, sf_dir, kind: str) -> str:
    """Suppliers as raw files of a format, lists as text and an extra column with them."""
    place = f"{shared_dir(spark)}/ledgerloom/files-{uuid.uuid4().hex}"
    lists = F.concat(F.lit('["'), "s_name", F.lit('","b, c"]'))
    rows = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("corporate_name_S2"), lists.alias("main_customers"), F.col("s_acctbal").cast("string").alias("revenue"), F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("postal_code"), F.lit("2021").alias("fiscal_year"), F.lit("x").alias("extra"))
    rows.write.format(kind).options(**({"header": "true", "escape": '"'} if kind == "csv" else {})).save(place)
    return place


@query("SELECT f AS format, s_name AS corporate_name_S2, s_name || '#b, c' AS main_customers, s_acctbal AS revenue, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS postal_code, CAST(2021 AS INT) AS fiscal_year, CAST(NULL AS VARCHAR) AS country, f || ' files' AS _source_system, true AS stamped FROM supplier, (SELECT unnest(['csv', 'json', 'orc', 'parquet']) AS f)")
def load_formats(spark, sf_dir):
    """Raw files of four formats through the loader: casts, lists from text, leading zeros, missing and extra columns, metadata."""
    loaded = None
    for kind in _FORMATS:
        cfg = SourceConfig(_supplier_files(spark, sf_dir, kind), kind, name=f"{kind} files", min_records=1)
        got = load_source(spark, cfg, FINANCIALS).select(F.lit(kind).alias("format"), "corporate_name_S2", F.array_join("main_customers", "#").alias("main_customers"), "revenue", "postal_code", "fiscal_year", "country", "_source_system", F.col("_load_timestamp").isNotNull().alias("stamped"))
        loaded = got if loaded is None else loaded.unionByName(got)
    return loaded


@query("SELECT least, n >= least AS enough FROM (SELECT count(*) AS n FROM region), (SELECT unnest([0, 1, 5, 6, 100]) AS least)")
def minimum_records(spark, sf_dir):
    """Which least numbers of rows the loader accepts for the regions."""
    rows, out = table(spark, sf_dir, "region"), []
    for least in (0, 1, 5, 6, 100):
        try:
            check_min_records(rows, least)
            out.append((least, True))
        except ValueError:
            out.append((least, False))
    return spark.createDataFrame(out, "least int, enough boolean")


@query("SELECT column_name AS name, 'missing' AS how FROM (DESCRIBE customer) WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE documents)) UNION ALL SELECT column_name, 'extra' FROM (DESCRIBE documents) WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE customer))")
def schema_difference(spark, sf_dir):
    missing, extra = schema_diff(table(spark, sf_dir, "documents").schema, table(spark, sf_dir, "customer").schema)
    return spark.createDataFrame([(n, "missing") for n in sorted(missing)] + [(n, "extra") for n in sorted(extra)], "name string, how string")


@query("SELECT unnest(['customers', 'others']) AS name, true AS there UNION ALL SELECT 'none', false")
def catalog_tables(spark, sf_dir):
    """Tables beside each other: listing, creation, and whether a table is there."""
    reg = _registry(spark, sf_dir, 1)
    beside = lambda name: Registry(spark, f"{reg.path.rsplit('/', 1)[0]}/{name}", CUSTOMER, "c_custkey", None)
    beside("others").create_if_missing()
    return spark.createDataFrame([(n, beside(n).exists()) for n in [*reg.tables(), "none"]], "name string, there boolean")


@query(f"SELECT * FROM {_LOADS[0]} UNION ALL SELECT * FROM {_LOADS[1]}")
def append_rows(spark, sf_dir):
    """An append keeps what is there, rows of equal keys too."""
    reg = _registry(spark, sf_dir, 1)
    reg.append(_load(spark, sf_dir, 1))
    return reg.at()


@query(f"SELECT count(*) AS rows, true AS listed FROM {_ALL}")
def snapshot_files(spark, sf_dir):
    """The rows in the files that the table lists for its current snapshot."""
    reg = _registry(spark, sf_dir)
    files = [r for r in reg.files().toLocalIterator()]
    return spark.read.schema(CUSTOMER).parquet(*[r["path"] for r in files]).agg(F.count(F.lit(1)).alias("rows"), F.lit(all(r["bytes"] > 0 for r in files)).alias("listed"))


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM " + _ALL + " WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 50")
def service_query(spark, sf_dir):
    """The service's answer to a query with a limit, null fields left out of its records and back again here."""
    from ledgerloom.plans.service import Service

    status, body = Service(spark, _registry(spark, sf_dir)).handle("POST", "/iceberg/query", {"filter_condition": "c_acctbal < 0", "limit": 50})
    if status != 200:
        raise ValueError(body)
    return spark.createDataFrame([tuple(r.get(c) for c in CUSTOMER.names) for r in body["rows"]], CUSTOMER)


def _scripted(record: dict):
    """A scorer that fails for some companies and answers others in fenced JSON, or in prose."""
    k = int(record["corporate_id"])
    if k % 7 == 0:
        raise RuntimeError("no answer")
    if k % 3 == 0:
        return "nothing found"
    return f'```json\n{{"has_adverse_media": {str(k % 2 == 0).lower()}, "summary": "s{k}", "risk_score": {k % 5 * 0.5 - 0.5}, "keywords_found": ["fraud", "k{k % 4}"]}}\n```'


@query("""SELECT CAST(c_custkey AS VARCHAR) AS corporate_id, c_name AS corporate_name, CASE WHEN known THEN c_custkey % 2 = 0 WHEN answered THEN false END AS has_adverse_media, CASE WHEN known THEN 's' || c_custkey END AS adverse_media_summary,
    CASE WHEN known THEN least(1.0::DOUBLE, greatest(0.0::DOUBLE, (c_custkey % 5) * 0.5::DOUBLE - 0.5::DOUBLE)) WHEN answered THEN 0.0::DOUBLE END AS risk_score, CASE WHEN known THEN 'fraud,k' || c_custkey % 4 WHEN answered THEN '' END AS keywords_found, answered AS checked
    FROM (SELECT *, c_custkey % 7 <> 0 AS answered, c_custkey % 7 <> 0 AND c_custkey % 3 <> 0 AS known FROM customer)""")
def risk_findings(spark, sf_dir):
    """Findings of every customer by a scorer that sometimes fails: a row's failure is its own, and no finding."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("corporate_id"), F.col("c_name").alias("corporate_name"), F.lit("").alias("context"))
    found = risk.analyse(rows, _scripted, risk.RiskConfig(calls_per_minute=10**9, parallelism=8, attempts=1))
    return found.select("corporate_id", "corporate_name", "has_adverse_media", "adverse_media_summary", "risk_score", F.array_join("keywords_found", ",").alias("keywords_found"), F.col("adverse_media_last_checked").isNotNull().alias("checked"))


@query("SELECT c_custkey, 'Company: ' || c_name || chr(10) || 'Country: ' || CASE WHEN c_custkey % 4 = 0 THEN 'unknown' ELSE CAST(c_nationkey AS VARCHAR) END || chr(10) || 'Industry: ' || coalesce(c_mktsegment, 'unknown') || chr(10) || 'Look for: fraud, lawsuit, bankruptcy, scandal, investigation, violation, penalty' || chr(10) || 'Period: last 365 days' AS prompt FROM customer")
def risk_prompt(spark, sf_dir):
    country = F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", risk.prompt(F.col("c_name"), country, F.col("c_mktsegment")).alias("prompt"))


@query("SELECT count(DISTINCT c_custkey) AS adverse_entities FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderpriority LIKE '1%'")
def adverse_entities(spark, sf_dir):
    return risk.adverse(adverse_media_join(spark, sf_dir)).agg(F.count(F.lit(1)).alias("adverse_entities"))


@query("SELECT c_custkey, CAST(NULL AS BOOLEAN) AS has_adverse_media, CAST(NULL AS VARCHAR) AS adverse_media_summary, CAST(NULL AS DOUBLE) AS risk_score, CAST(NULL AS VARCHAR) AS keywords_found, true AS unchecked FROM customer")
def skipped_findings(spark, sf_dir):
    """The skipped stage: every finding a typed null."""
    got = risk.without_findings(table(spark, sf_dir, "customer"))
    return got.select("c_custkey", "has_adverse_media", "adverse_media_summary", "risk_score", F.array_join("keywords_found", ",").alias("keywords_found"), F.col("adverse_media_last_checked").isNull().alias("unchecked"))


@query("SELECT part, count(*) AS n FROM (SELECT ('0x' || substr(md5(doc_id || '|42'), 1, 8))::UBIGINT / 4294967296.0::DOUBLE AS u, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.7::DOUBLE + 0.1::DOUBLE THEN 'validation' ELSE 'test' END AS part FROM documents) GROUP BY part")
def random_split_counts(spark, sf_dir):
    parts = features.split(table(spark, sf_dir, "documents"), "doc_id", target=None)
    named = [p.select(F.lit(n).alias("part")) for n, p in zip(("train", "validation", "test"), parts, strict=True)]
    return named[0].union(named[1]).union(named[2]).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query(_INDEXED + "SELECT c_custkey, c_acctbal AS balance, CAST(k AS DOUBLE) AS segment FROM customer JOIN r ON c_mktsegment = v")
def assembled_features(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    x = vector_to_array("features")
    return _segments(spark, sf_dir, scaler="none", encoding="index").select("c_custkey", x[0].alias("balance"), x[1].alias("segment"))


@query("SELECT 'both' AS labels, count(DISTINCT toxic) > 1 AS usable FROM labels UNION ALL SELECT 'toxic only', count(DISTINCT toxic) FILTER (toxic = 1) > 1 FROM labels UNION ALL SELECT 'none', false")
def feature_validation(spark, sf_dir):
    cfg = features.FeatureConfig(numeric=(), categorical=(), derived=())
    rows = table(spark, sf_dir, "labels").withColumn("target", F.col("toxic").cast("double"))
    cases = {"both": rows, "toxic only": rows.where("toxic = 1"), "none": rows.drop("target")}
    return spark.createDataFrame([(n, features.validate_features(r, cfg)) for n, r in cases.items()], "labels string, usable boolean")


@query(f"""WITH {_COUNTS}, d AS (SELECT (tp + tn) / (tp + tn + fp + fn)::DOUBLE AS accuracy FROM c)
    SELECT least, accuracy >= least AS passed FROM d, (SELECT unnest([0.0::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 1.0::DOUBLE]) AS least)""")
def metric_gates(spark, sf_dir):
    """Least accuracies against that of the labels' judgement."""
    row = training.weighted_metrics(_judged(spark, sf_dir)).first()
    metrics = {"accuracy": row["accuracy"], "weightedPrecision": row["precision"], "weightedRecall": row["recall"], "f1": row["f1"]}
    return spark.createDataFrame([(x, training.check_gates(metrics, {"min_accuracy": x})[0]) for x in (0.0, 0.25, 0.5, 0.75, 1.0)], "least double, passed boolean")


@query("SELECT true AS near")
def dq_unique_approx(spark, sf_dir):
    """Repeats by approximate distinct counts lie within a tenth of the distinct values of the exact ones."""
    orders = table(spark, sf_dir, "orders")
    exact, approx = (report(orders, [Rule("o_custkey", "unique", approx=a)]).select("rows", F.col("errors").alias(f"e{int(a)}")) for a in (False, True))
    return exact.join(approx, "rows").select((F.abs(F.col("e0") - F.col("e1")) <= 0.1 * (F.col("rows") - F.col("e0"))).alias("near"))
