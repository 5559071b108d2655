"""URL filters: listed rules first, then association rules that Spark's FP-growth mines from labels.

DataFrame and SQL functions only. A URL is a set of tokens (labels of its host, its registered domain,
path segments without numbers, names of query fields, scheme). Labelled URLs with the token of their
label are the transactions; kept are rules ``tokens -> block`` of enough support and confidence, with any
number of tokens, without those that a shorter one of no less confidence makes idle. However small the table, a rule
must hold for ``LEAST_PAGES`` blocked pages, and the lower end of its confidence's 95 % interval (Wilson's)
must lie above the share of blocked pages among all labelled ones: labels that do not depend on the URL give no rule.

Matching goes by an inverted index: each rule stands once, under the one of its tokens that the fewest labelled
URLs have; a URL that has this token is tested for the others.

Defined cases: a URL that is null or has no ``://`` has empty host and path, no token, and the verdict
"allow". Rows that repeat each keep a row. Of rules that hold for a URL the surest is named, then the one of most
support, then the least by its tokens. With no labelled URL no rule is mined; an empty table of pages gives an
empty result. Very long URLs are read whole. Other columns pass through; those named like an added one give way to it.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import free_name
from ledgerloom.plans.scratch import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path); a rule fits its host and all subdomains, and paths that start with its own.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MIN_SUPPORT = 0.001
MIN_CONFIDENCE = 0.8
#: Blocked pages that a rule must hold for, however small the table: fewer pages say little of a confidence of 0.8.
LEAST_PAGES = 10
_Z = 1.96
_SALTS = 32


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Verdict and text of the longest rule that fits; null where none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    verdict, text = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own_host, own_path in reversed(ordered):
        fits = ((host == own_host) | F.endswith(host, F.lit(f".{own_host}"))) & F.startswith(path, F.lit(own_path))
        verdict = F.when(fits, kind).otherwise(verdict)
        text = F.when(fits, own_host + own_path).otherwise(text)
    return verdict, text


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    tag = lambda kind, items: F.transform(items, lambda x: F.concat(F.lit(kind), x))
    segments = F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.rlike("[0-9]"))
    names = F.filter(F.transform(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    domain = F.array(F.concat(F.lit("d:"), F.substring_index(host, ".", -2)))
    scheme = F.array(F.concat(F.lit("s:"), F.substring_index(url, "://", 1)))
    found = F.array_distinct(F.concat(tag("h:", labels), domain, tag("p:", segments), tag("q:", names), scheme))
    return F.when(F.instr(url, "://") > 0, found).otherwise(F.array().cast("array<string>"))


def _least_confidence(confidence: Column, n: Column) -> Column:
    """Lower end of the Wilson interval of a share found in n rows."""
    z2 = _Z * _Z
    return (confidence + z2 / (2 * n) - _Z * F.sqrt(confidence * (1 - confidence) / n + z2 / (4 * n * n))) / (1 + z2 / n)


#: Between the items of a prefix, and before an item of a transaction; no token holds them at its start.
_AND, _OF = "\u0001", "\u0002"


def _told_apart(level: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Of rows (row, bad, prefix, over, item): the items of each prefix that may make new rules, and the rows with these only.

    An item must be frequent, and no item of all of the prefix's ``over`` rows; of items with the same rows the least stands for all.
    Sets of rows are told apart by their number and two xor-ed hashes.
    """
    cover = [F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("hits"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(2))).alias("y")]
    met = settle(level.groupBy("prefix", "over", "item").agg(*cover).where((F.col("n") >= least) & (F.col("n") < F.col("over"))))
    kept = met.groupBy("prefix", "n", "hits", "x", "y").agg(F.min("item").alias("item"))
    return met, settle(level.join(kept.select("prefix", "item", "n"), ["prefix", "item"]).select("row", "bad", "prefix", "item", "n"))


def _grown(bags: DataFrame, least: float, min_confidence: float) -> DataFrame | None:
    """FP-growth's rules (items, confidence, hits) over the transactions of several prefixes at once: items carry their prefix, so these never mix."""
    total = bags.count()
    if not total:
        return None
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, math.ceil(least) / total * (1 - 1e-9)), minConfidence=min_confidence).fit(bags)
    found = model.associationRules.where(F.endswith(F.col("consequent")[0], F.lit(f"{_OF}=block")))
    prefix = F.filter(F.split(F.substring_index(F.col("antecedent")[0], _OF, 1), _AND), lambda t: t != "")
    items = F.array_sort(F.concat(prefix, F.transform("antecedent", lambda t: F.substring_index(t, _OF, -1))))
    return found.select(items.alias("items"), "confidence", F.round(F.col("support") * total).alias("hits"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (rule_id, items, anchor, confidence, support) from rows (tokens, bad).

    FP-growth lists every frequent set: 2^k of k tokens that come together, or of which each implies the next, as the segments of a
    path do. None of these is a new rule, so FP-growth never sees them: tokens that the same URLs hold are one item, and where an
    item implies another, the URLs are projected: each rarer item becomes a prefix, whose rows are transactions of the more frequent items
    that it doesn't imply. That goes on for prefixes in which items still imply each other; all others, often the
    whole table at once, are mined as they are. A token by itself is a rule for each token of its item; in
    longer rules an item is named by its least token.
    """
    schema = "rule_id long, items array<string>, anchor string, confidence double, support double"
    n, bad = labelled.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    if n < LEAST_PAGES:
        return labelled.sparkSession.createDataFrame([], schema)
    least = max(min_support * n, LEAST_PAGES - 0.5)
    rows = labelled.select(F.monotonically_increasing_id().alias("row"), F.coalesce("bad", F.lit(False)).alias("bad"), F.array_distinct("tokens").alias("tokens"))
    rows = rows.select("row", "bad", F.explode("tokens").alias("item"))  # apart, as a row's tokens share its number
    level, single, rules = settle(rows.withColumns({"prefix": F.lit(""), "over": F.lit(n).cast("long")})), None, None
    while True:
        met, kept = _told_apart(level, least)
        parts = F.filter(F.split("prefix", _AND), lambda t: t != "")
        own = met.where(F.col("hits") >= least).select(F.array_sort(F.array_append(parts, F.col("item"))).alias("items"), (F.col("hits") / F.col("n")).alias("confidence"), "hits")
        single = met.select("item", "n", "x", "y") if single is None else single
        rules = own if rules is None else rules.unionByName(own)
        sets = kept.groupBy("row", "bad", "prefix").agg(F.collect_list(F.struct("n", "item")).alias("s"))
        two = sets.select("row", "bad", "prefix", "s", F.explode("s").alias("a")).select("row", "bad", "prefix", "a", F.explode(F.filter("s", lambda b: b > F.col("a"))).alias("b"))
        two = settle(two.select("row", "bad", "prefix", F.col("a.item").alias("a"), F.col("a.n").alias("over"), F.col("b.item").alias("item")))
        nested = settle(two.groupBy("prefix", "a", "over", "item").agg(F.count(F.lit(1)).alias("n")).where("n = over").select("prefix").distinct())
        named = lambda t: F.concat(F.col("prefix"), F.lit(_OF), t)
        flat = sets.join(nested, "prefix", "left_anti").select(F.transform("s", lambda b: named(b["item"])).alias("held"), "bad", "prefix")
        bags = settle(flat.select(F.when(F.col("bad"), F.array_append("held", named(F.lit("=block")))).otherwise(F.col("held")).alias("items")))
        found = _grown(bags, least, min_confidence)
        rules = rules.unionByName(found) if found is not None else rules
        deeper = two.join(nested, "prefix", "left_semi")
        level = settle(deeper.select("row", "bad", F.concat_ws(_AND, F.nullif("prefix", F.lit("")), "a").alias("prefix"), "over", "item"))
        if level.isEmpty():
            break
    rules = rules.groupBy("items").agg(F.max("confidence").alias("confidence"), F.max("hits").alias("hits"))
    rules = settle(rules.where(F.col("confidence") >= min_confidence).where(_least_confidence(F.col("confidence"), F.col("hits") / F.col("confidence")) > bad / n))
    # The anchor is the rarest item of a rule; a rule is idle beside a shorter one of no less confidence, whose anchor is an item of it.
    least_named = single.groupBy("n", "x", "y").agg(F.min("item").alias("name"))
    same = settle(single.join(least_named, ["n", "x", "y"]).select(F.col("item").alias("t"), "n", "name"))
    each = rules.select("items", F.explode("items").alias("t")).join(same, "t")
    rarest = each.groupBy("items").agg(F.min_by("t", F.struct("n", "t")).alias("anchor"), F.array_sort(F.collect_list("name")).alias("names"))
    rules = settle(rules.join(rarest, "items").select(F.xxhash64("items").alias("rule_id"), "items", "names", "anchor", "confidence", (F.col("hits") / n).alias("support")))
    short = rules.join(same, F.col("anchor") == F.col("t")).select(F.col("names").alias("less"), F.col("confidence").alias("sure"), F.col("name").alias("at")).distinct()
    near = rules.where(F.size("items") > 1).select("items", "names", "confidence", F.explode("names").alias("at")).join(short, "at")
    idle = near.where((F.size("less") < F.size("items")) & (F.col("sure") >= F.col("confidence") - 1e-12) & (F.size(F.array_except("less", "names")) == 0)).select("items").distinct()
    return settle(rules.join(idle, "items", "left_anti").select("rule_id", "items", "anchor", "confidence", "support"))


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Of rows (url, tokens), distinct by url: the surest rule that holds, as (url, items, confidence)."""
    met = urls.select("url", "tokens", F.explode("tokens").alias("anchor")).join(rules, "anchor")
    held = met.where(F.size(F.array_except("items", "tokens")) == 0)
    best = held.groupBy("url").agg(F.max_by(F.struct("items", "confidence"), F.struct("confidence", "support", (-F.col("rule_id")).alias("rank"))).alias("b"))
    return best.select("url", "b.items", "b.confidence")


def judge(pages: DataFrame, rules: DataFrame, listed_rules=RULES, url_col: str = "url") -> DataFrame:
    """Adds host, path, rule, verdict, and of a mined rule that decided: mined_rule, confidence."""
    added = ("host", "path", "rule", "verdict", "mined_rule", "confidence")
    names = [c for c in pages.columns if c.lower() not in added]
    spot, same, salt = (free_name([*pages.columns, *added], c) for c in ("_row", "_url", "_salt"))
    host, path = split_url(F.col(f"`{url_col}`"))
    verdict, text = listed(host, path, listed_rules)
    rows = pages.select(*[F.col(f"`{c}`") for c in names], host.alias("host"), path.alias("path"), text.alias("rule"), verdict.alias("verdict"), F.when(text.isNull(), F.col(f"`{url_col}`")).alias(same))
    urls = rows.where(F.col(same).isNotNull()).select(F.col(same).alias("url"), "host", "path").distinct()
    found = matches(urls.select("url", tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")), rules)
    # The rows of one common URL meet its rule in several tasks, and so do rows whose listed rule decided.
    found = found.select(F.col("url").alias(same), F.concat_ws(" ", "items").alias("mined_rule"), "confidence", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias(salt))
    dealt = rows.withColumn(spot, F.monotonically_increasing_id()).withColumn(salt, F.pmod(F.xxhash64(spot), F.lit(_SALTS)).cast("int"))
    joined = dealt.join(found, [same, salt], "left").drop(same, salt, spot)
    decided = F.coalesce("verdict", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow"))
    return joined.withColumn("verdict", decided)


def labelled_pages(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """(tokens, bad) of the pages whose document has a label: the number in the path is its doc_id."""
    host, path = split_url(F.col(url_col))
    rows = pages.select(F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.select(tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), F.expr("try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})', 1), '') as bigint)").alias("doc_id"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))).alias("bad"))
    return rows.where("doc_id is not null").join(known, "doc_id").select("tokens", "bad")
