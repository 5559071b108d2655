"""Registered queries on loads that follow each other: resolution step by step, quality, rejects and sketches within the load."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import evaluation, features, quality, resolve, risk, selection, sketches
from ledgerloom.operators.incremental import Resolution
from ledgerloom.plans.scratch import settle, shared_dir
from ledgerloom.queries import DQ_RULES, ORACLES, QUERIES, company_source, entity_row, query, table
from ledgerloom.sources.loader import split_rejects
from ledgerloom.sources.registry import REGISTRY, Registry
from ledgerloom.streaming.asking import ask_stream
from ledgerloom.streaming.incremental import resolve_stream

__all__ = ["ORACLES", "QUERIES"]


@query(ORACLES["harmonized_entities"])
def incremental_resolution(spark, sf_dir):
    """Both sources in three parts of as many files as they need, streamed about a part of each at a time; what the registry holds at the end equals one resolution of all rows.

    The first files hold other postal codes for every fifth row, so later files also replace rows and undo matches.
    """
    place = f"{shared_dir(spark)}/ledgerloom/resolve-{uuid.uuid4().hex}"
    schemas, most = [], 1
    for side in ("S1", "S2"):
        rows = settle(company_source(spark, sf_dir, side))
        part = F.pmod(F.xxhash64("doc_id"), F.lit(3))
        early = rows.where((part == 0) | (F.col("doc_id") % 5 == 0)).withColumn("postal_code", F.when((F.col("doc_id") % 5 == 0) & (part != 0), F.lit("00")).otherwise(F.col("postal_code")))
        for k, df in enumerate((early, rows.where(part == 1), rows.where(part == 2))):
            df.write.parquet(f"{place}/{side}/{k}")
            most = max(most, len(spark.read.schema(rows.schema).parquet(f"{place}/{side}/{k}").inputFiles()))
        schemas.append(rows.schema)
    registry = Registry(spark, f"{place}/registry/companies", REGISTRY, "corporate_id", None)
    resolution = Resolution(spark, f"{place}/state")
    resolve_stream(spark, (f"{place}/S1/*", f"{place}/S2/*"), tuple(schemas), resolution, f"{place}/checkpoint", ("doc_id", "doc_id"), registry, files_per_batch=most)
    return entity_row(registry.at())


@query("""
    SELECT count(*) AS blocks, sum(n1 * n2)::BIGINT AS pairs, max(n1 * n2)::BIGINT AS largest FROM
      (SELECT city || '|' || coalesce(segment, '') AS b, count(*) AS n1 FROM clients WHERE source = 'crm' AND city IS NOT NULL GROUP BY 1)
      JOIN (SELECT city || '|' || coalesce(segment, '') AS b, count(*) AS n2 FROM clients WHERE coalesce(source, '') <> 'crm' AND city IS NOT NULL GROUP BY 1) USING (b)""")
def block_pair_counts(spark, sf_dir):
    """Pairs of the clients of one system with those of the others, by city and segment; counted as the tiled join makes them."""
    rows = table(spark, sf_dir, "clients").where("city is not null").withColumn("blocking_key", F.concat(F.col("city"), F.lit("|"), F.coalesce("segment", F.lit(""))))
    is_crm = F.coalesce(F.col("source"), F.lit("")) == "crm"
    side = lambda df, c: df.select("blocking_key", F.struct("client_id", F.col("blocking_key").alias("b"), "updated_at").alias(c))
    pairs = resolve.block_pairs(side(rows.where(is_crm), "one"), side(rows.where(~is_crm), "two"))
    return pairs.groupBy("one.b").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("pairs"), F.max("n").alias("largest"))


_CHI_BINS = 8


@query(f"""
    WITH x AS (SELECT CASE WHEN flag = 'kept' THEN 1 ELSE 0 END AS label, unnest([{{'f': 0, 'x': quantity::DOUBLE}}, {{'f': 1, 'x': amount}}, {{'f': 2, 'x': discount}}, {{'f': 3, 'x': line_no::DOUBLE}}]) AS v FROM sale_lines WHERE flag IS NOT NULL),
    long AS (SELECT label, v.f AS feature, v.x AS x FROM x),
    edges AS (SELECT feature, list_distinct(quantile_disc(x, [{", ".join(f"{k} / {_CHI_BINS}.0" for k in range(1, _CHI_BINS))}])) AS cuts FROM long GROUP BY 1),
    cells AS (SELECT feature, CASE WHEN x IS NULL THEN -1 ELSE len(list_filter(cuts, lambda e: e < x)) END AS bin, label, count(*) AS n FROM long JOIN edges USING (feature) GROUP BY ALL),
    e AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature, bin) AS r, sum(n) OVER (PARTITION BY feature, label) AS c, sum(n) OVER (PARTITION BY feature) AS t FROM cells)
    SELECT feature::INT AS feature, round(sum((n - r * c / t) * (n - r * c / t) / (r * c / t)), 3) AS statistic, d.degrees FROM e
    JOIN (SELECT feature, (count(DISTINCT bin) - 1) * (count(DISTINCT label) - 1) AS degrees FROM cells GROUP BY 1) d USING (feature) GROUP BY feature, degrees""")
def chi_square_features(spark, sf_dir):
    """The chi-square statistic of four numbers of sale lines, in eighths by quantiles, against whether the line was kept.

    The quantiles' accuracy makes them exact up to 10^6 rows, as SQL has them; beyond, ranks are off by 10^-6 at most, with summaries of bounded size.
    """
    rows = table(spark, sf_dir, "sale_lines").where("flag is not null")
    values = F.array(*[F.col(c).cast("double") for c in ("quantity", "amount", "discount", "line_no")])
    edges = selection.quantile_edges(rows, values, _CHI_BINS, accuracy=1_000_000)
    found = selection.chi_square(selection.contingency(rows, values, (F.col("flag") == "kept").cast("int"), edges))
    return found.select("feature", F.round("statistic", 3).alias("statistic"), "degrees")


@query(ORACLES["dq_report"])
def dq_report_observed(spark, sf_dir):
    """The same rules as ``dq_report``, counted while the rows are written; only the exact distinct count reads the table, one column of it."""
    rows, seen, _ = quality.observed(table(quality.apart(spark), sf_dir, "customer"), DQ_RULES, f"customer-{uuid.uuid4().hex}")
    written = settle(rows)
    found = quality.observed_report(seen, DQ_RULES, rows.columns, written)
    told = spark.createDataFrame([(r["field"], r["kind"], r["rows"], r["errors"]) for r in found], "field string, kind string, rows long, errors long")
    return quality.decision(told).select("checks", "errors", F.round("error_rate", 9).alias("error_rate"), "passed")


_CLICK = T.StructType([
    T.StructField("click_id", T.LongType()), T.StructField("value", T.IntegerType()),
    T.StructField("props", T.StructType([T.StructField("k", T.IntegerType()), T.StructField("tags", T.ArrayType(T.StringType()))])), T.StructField("kind", T.StringType()),
])


@query("""
    WITH r AS (SELECT click_id, value::VARCHAR AS value, props, CASE WHEN kind = 'error' THEN 'x' || click_id ELSE click_id::VARCHAR END AS raw_id FROM clicks),
    bad AS (SELECT click_id, 'click_id' AS col, 'not a bigint' AS reason FROM r WHERE try_cast(raw_id AS BIGINT) IS NULL
            UNION ALL SELECT click_id, 'props', 'not a struct<k:int,tags:array<string>>' FROM r WHERE props IS NOT NULL AND (NOT json_valid(props) OR json_type(props, '$.k') = 'VARCHAR'))
    SELECT col AS "column", reason, count(*) AS n, sum(click_id)::BIGINT AS ids FROM bad GROUP BY 1, 2
    UNION ALL SELECT NULL, 'kept', count(*), sum(click_id)::BIGINT FROM r WHERE click_id NOT IN (SELECT click_id FROM bad)""")
def load_rejects(spark, sf_dir):
    """Clicks under a typed schema, as raw texts: broken JSON and ids that are no numbers go to the rejects, the rest is kept; one pass parts them."""
    clicks = table(spark, sf_dir, "clicks")
    bad_id = F.when(F.col("kind") == "error", F.concat(F.lit("x"), F.col("click_id").cast("string"))).otherwise(F.col("click_id").cast("string"))
    raw = clicks.select(bad_id.alias("click_id"), F.floor("value").cast("string").alias("value"), "props", F.col("click_id").cast("string").alias("kind"))
    kept, rejects = split_rejects(raw, _CLICK, "kind")
    told = rejects.groupBy("column", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("kind").cast("long")).alias("ids"))
    return told.unionByName(kept.agg(F.lit(None).cast("string").alias("column"), F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("n"), F.sum(F.col("kind").cast("long")).alias("ids")))


@query("SELECT sale_id, client_id, status, total FROM sales ORDER BY md5(sale_id::VARCHAR), sale_id LIMIT 100")
def sample_rows(spark, sf_dir):
    """A sample of 100 sales, the same under any partitioning."""
    return features.bottom_k(table(spark, sf_dir, "sales"), "sale_id").select("sale_id", "client_id", "status", "total")


@query("""
    WITH x AS (SELECT unnest([{'c': 'total', 'x': total}, {'c': 'priority', 'x': priority::DOUBLE}, {'c': 'client_id', 'x': client_id::DOUBLE}]) AS v FROM sales)
    SELECT v.c AS "column", count(v.x) AS n, count(*) - count(v.x) AS nulls, round(avg(v.x), 6) AS mean, round(stddev_samp(v.x), 6) AS stddev, min(v.x) AS low, max(v.x) AS high, true AS distinct_close, true AS quartiles_close FROM x GROUP BY 1""")
def merged_load_statistics(spark, sf_dir):
    """Statistics of sales kept by month of arrival and merged: no month is read twice. Sketched values are held against exact ones of all rows."""
    columns = ["total", "priority", "client_id"]
    sales = table(spark, sf_dir, "sales")
    month = F.coalesce(F.month("arrived_at"), F.lit(0))
    kept = None
    for k in sorted(r[0] for r in sales.select(month.alias("m")).distinct().collect()):  # twelve months and none
        own = sketches.sketched(sales.where(month == k), columns, k)
        kept = own if kept is None else kept.unionByName(own)
    found = sketches.statistics(sketches.merged(settle(kept)))
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    long = sales.select(values.alias("v")).select("v.*").where("x is not null")
    exact = long.groupBy("column").agg(F.count_distinct("x").alias("_distinct"))
    # Of each sketched quartile, the share of rows below it and up to it: the quartile itself lies between, within the sketch's error of rank.
    cuts = found.select(F.col("column").alias("_c"), F.explode(F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"q{round(100 * q)}").alias("at")) for q in sketches.QUANTILES])).alias("cut"))
    ranks = long.join(F.broadcast(cuts), F.col("column") == F.col("_c")).groupBy("column", "cut.q").agg(F.avg((F.col("x") < F.col("cut.at")).cast("double")).alias("below"), F.avg((F.col("x") <= F.col("cut.at")).cast("double")).alias("upto"))
    close = ranks.groupBy("column").agg(F.min((F.col("below") <= F.col("q") + 0.02) & (F.col("upto") >= F.col("q") - 0.02)).alias("quartiles_close"))
    both = found.join(exact, "column").join(close, "column")
    return both.select("column", "n", "nulls", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"), "low", "high", (F.abs(F.col("distinct_values") - F.col("_distinct")) <= 0.06 * F.col("_distinct") + 1).alias("distinct_close"), "quartiles_close")


#: A score in 0 to 1 of a sale and whether it is done.
_SCORED = "SELECT total / (total + 60.0::DOUBLE) AS s, status = 'done' AS t FROM sales WHERE total IS NOT NULL AND status IS NOT NULL"
_HISTOGRAM = f"h AS (SELECT least(floor(s * 100), 99)::INT AS bin, count(*) FILTER (t) AS p, count(*) FILTER (NOT t) AS n, sum(s) AS said FROM ({_SCORED}) GROUP BY 1)"


def _histogram(spark, sf_dir):
    sales = table(spark, sf_dir, "sales").where("total is not null and status is not null")
    return evaluation.score_histogram(sales, F.col("total") / (F.col("total") + 60.0), (F.col("status") == "done").cast("double"))


@query(f"WITH {_HISTOGRAM} SELECT bin, sum(p) OVER w / sum(p) OVER () AS true_positive_rate, sum(n) OVER w / sum(n) OVER () AS false_positive_rate, sum(p) OVER w / (sum(p + n) OVER w) AS precision FROM h WINDOW w AS (ORDER BY bin DESC)")
def score_curves(spark, sf_dir):
    """ROC and precision-recall points of a score of sales, from its histogram."""
    return evaluation.curves(_histogram(spark, sf_dir))


@query(f"WITH {_HISTOGRAM} SELECT (bin // 10)::INT AS \"group\", sum(p + n)::BIGINT AS n, round(sum(said) / sum(p + n), 9) AS mean_score, sum(p) / sum(p + n) AS positive_rate FROM h GROUP BY 1")
def score_calibration(spark, sf_dir):
    found = evaluation.calibration(_histogram(spark, sf_dir))
    return found.withColumn("mean_score", F.round("mean_score", 9))


_ATTEMPTS = 4


def _unsteady(record: dict) -> dict:
    """A scorer that fails at times, by a rule of the id and the attempt."""
    k, a = int(record["corporate_id"]), record["attempt"]
    if (7 * k + 5 * a * a + k // 11) % 3 == 0 or k % 97 == 5:
        raise OSError("no answer")
    return {"has_adverse_media": k % 2 == 0, "summary": record["corporate_name"], "risk_score": (k % 10) / 10, "keywords_found": []}


@query(f"""
    WITH asked AS (SELECT client_id, name, list_min(list_filter(range(1, {_ATTEMPTS + 1}), lambda a: NOT ((7 * client_id + 5 * a * a + client_id // 11) % 3 = 0 OR client_id % 97 = 5))) AS good FROM clients WHERE client_id IS NOT NULL)
    SELECT client_id::VARCHAR AS corporate_id, CASE WHEN good IS NULL THEN 'expired' ELSE 'found' END AS outcome, coalesce(good, {_ATTEMPTS})::INT AS attempts,
           CASE WHEN good IS NOT NULL THEN client_id % 2 = 0 END AS has_adverse_media, CASE WHEN good IS NOT NULL THEN client_id % 10 / 10.0::DOUBLE END AS risk_score, good IS NOT NULL AS checked FROM asked""")
def asked_again(spark, sf_dir):
    """All clients asked about as a stream, by a scorer that fails at times: each ends found or expired after as many attempts as it needed."""
    place = f"{shared_dir(spark)}/ledgerloom/asked-{uuid.uuid4().hex}"
    clients = table(spark, sf_dir, "clients").where("client_id is not null").groupBy("client_id").agg(F.max("name").alias("name"))
    first = clients.select(F.col("client_id").cast("string").alias("corporate_id"), F.col("name").alias("corporate_name"), F.lit("").alias("context"), F.lit("2024-06-01 00:00:00").cast("timestamp").alias("asked_at"))
    first.write.parquet(f"{place}/in/0")
    for k in range(1, 8):  # time goes on, with nobody to ask for
        spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in first.columns[:3]], F.lit(f"2024-06-01 00:{k:02}:00").cast("timestamp").alias("asked_at")).coalesce(1).write.parquet(f"{place}/in/{k}")
    requests = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/in/*")
    outcomes = ask_stream(requests, _unsteady, risk.RiskConfig(calls_per_minute=10_000_000, attempts=_ATTEMPTS))
    outcomes.writeStream.format("parquet").option("path", f"{place}/out").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(f"{place}/out")
    return found.select("corporate_id", "outcome", "attempts", "has_adverse_media", "risk_score", F.col("adverse_media_last_checked").isNotNull().alias("checked"))
