"""Edge cases of every operator, the thin queries, and the pipeline against a plain version."""

import hashlib
import json
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import brown, exact_dedup, langid, ngram_join, packing, pii, piece_sampling, quality_rules, queries, toxicity, url_filter
from tests.llm.test_copies import brute_components
from tests.llm.test_text_models import brute_spans

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CLASHES = ["language", "pii", "pieces", "decoded", "_lm", "_dd_key", "_dd_again", "_nj_id", "token", "id", "sid", "n", "h", "row", "part", "rank", "host", "Rule", "verdict", "word", "raw", "words"]


def labels_of(df):
    return df.sparkSession.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(60)] + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def score(df):
    counts = brown.word_counts(df.where(brown.learns()).select("text"))
    return brown.score(df, brown.fit(df.where(brown.learns()).select("text"), counts, seeds=20), counts).drop("perplexity", "base_score", "score")


def pages(df):
    urls = df.select("*", F.concat(F.lit("https://a.net/x?q="), F.col("doc_id").cast("string")).alias("url"))
    none = df.sparkSession.createDataFrame([], "rule_id long, items array<string>, anchor string, confidence double, support double")
    return url_filter.judge(urls, none).select("doc_id", "host", "path", "rule", "verdict")


OPERATORS = {
    "ngram_join": lambda df: ngram_join.components(df),
    "drop_near_duplicates": lambda df: ngram_join.drop_near_duplicates(df).select("doc_id", "text"),
    "pii": lambda df: pii.find(df, None).select("doc_id", F.to_json("pii")),
    "redacted": lambda df: pii.redacted(df, None).select("doc_id", "text"),
    "exact_dedup": lambda df: exact_dedup.duplicate_groups(df),
    "drop_duplicates": lambda df: exact_dedup.drop_duplicates(df).select("doc_id", "text"),
    "brown": score,
    "quality_rules": lambda df: quality_rules.judge(df, labels_of(df)).select("doc_id", "n_words", "base_failed", "kept"),
    "toxicity": lambda df: toxicity.classify(df, toxicity.train(df, labels_of(df))).select("doc_id", "toxic"),
    "packing": lambda df: packing.pack(df, WORDS).select("doc_id", "piece", "start", "length", "ids_crc32"),
    "url_filter": pages,
    "langid": lambda df: langid.identify(df, langid.train(df, F.col("lang"))).select("doc_id", "language.lang_pred", "language.rejected"),
    "piece_sampling": lambda df: piece_sampling.round_trip(df, PIECES).select("doc_id", F.to_json("pieces"), "decoded"),
}


def counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_and_maps_change_nothing_and_empty_stays_empty(docs, no_docs, name):
    wide = docs.withColumns({c: F.lit(7) for c in CLASHES}).withColumn("m", F.create_map(F.lit("a"), F.col("doc_id"))).withColumn("a.b", F.lit("dot"))
    assert counted(OPERATORS[name](wide)) == counted(OPERATORS[name](docs))
    assert OPERATORS[name](no_docs).count() == 0


@pytest.mark.parametrize("keep", [ngram_join.drop_near_duplicates, exact_dedup.drop_duplicates, lambda df: pii.redacted(df, None)])
def test_other_columns_pass_through(docs, keep):
    wide = docs.withColumns({c: F.col("doc_id") * 2 for c in CLASHES}).withColumn("m", F.create_map(F.lit("a"), F.col("doc_id")))
    got = keep(wide)
    assert got.dtypes == wide.dtypes
    assert all(r["_dd_key"] == 2 * r["doc_id"] and r["_lm"] == 2 * r["doc_id"] and r["m"] == {"a": r["doc_id"]} for r in got.where("doc_id is not null").collect())


COLUMNS = {
    "op1_ngram_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op2_pii": {"doc_id": "bigint", **{f"n_{k}": "bigint" for k in pii.KINDS}, "base_sha256": "string", "spans": "string"},
    "op3_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op4_lm_scoring": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op5_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op6_toxicity_chain": {"doc_id": "bigint", "p_toxic": "double", "toxic": "boolean"},
    "op7_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op8_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op9_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op10_piece_sampling": {"doc_id": "bigint", "n_pieces": "bigint", "lossless": "boolean"},
}


@pytest.fixture(scope="module")
def documents(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables here")
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.mark.parametrize("name", COLUMNS)
def test_queries_return_what_they_say(spark, documents, name):
    df = queries.QUERIES[name](spark, SMALL)
    kinds = dict(df.dtypes)
    assert all(kinds[c] == k for c, k in COLUMNS[name].items())
    rows = df.collect()
    crc = lambda k: zlib.crc32(str(k).encode())
    if "doc_id" in df.columns:
        assert {r["doc_id"] for r in rows} == set(documents)
    if name == "op1_ngram_jaccard_join":
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == brute_components([(k, r["text"]) for k, r in documents.items()])
    if name == "op2_pii":
        for r in rows:
            base = pii.joined(brute_spans(documents[r["doc_id"]]["text"]))
            assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and set(base.split(",")) <= set(r["spans"].split(",")) | {""}
    if name == "op4_lm_scoring":
        assert all(r["held_out"] == (crc(r["doc_id"]) % 7 == 2) and np.isfinite(r["score"]) for r in rows) and len({r["train_tokens"] for r in rows}) == 1
    if name == "op7_best_fit_packing":
        total = sum(r["length"] for r in rows)
        assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) + 1
    if name == "op8_url_filter":
        assert all(r["verdict"] in ("allow", "block") for r in rows) and any(r["rule"] for r in rows)
    if name == "op9_language_id":
        held = [r for r in rows if r["held_out"]]
        assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) for r in rows)
        assert sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held) >= 0.95 * len(held)
    if name == "op10_piece_sampling":
        assert all(r["lossless"] for r in rows)


def test_pipeline_equals_a_plain_version(spark, docs, tmp_path):
    """Models are trained by the library on what each stage gets; every decision, text and id is made again in plain Python."""
    extra = [(500 + k, f"write to eve{k}@mail.example.com or call +1 212 555 010{k} about the river and the stone {k}", "en", "src1", 1) for k in range(8)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema)).withColumn("_lm", F.lit("x"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = [r.asDict() for r in read.collect()]
    frame = lambda own: spark.createDataFrame([tuple(r.values()) for r in own], read.schema)
    model = langid.train(read, F.when(langid.learns(), F.col("lang")))
    rows = [r for r, bad in zip(rows, model.judge([r["text"] for r in rows])[3], strict=True) if not bad]
    best = {}
    for r in rows:
        have = best.get(r["text"])
        if have is None or (r["doc_id"] is not None and (have["doc_id"] is None or r["doc_id"] > have["doc_id"])):
            best[r["text"]] = r
    rows = list(best.values())
    group = dict(zip([(r["doc_id"], r["text"]) for r in rows], [None] * len(rows), strict=True))
    named = Counter()
    for r in rows:
        named[r["doc_id"]] += 1
    comp = {i: c for i, _, c in brute_components([(r["doc_id"], r["text"]) for r in rows])}
    assert max(named.values()) == 1 and group
    rows = [r for r in rows if comp[r["doc_id"]] == r["doc_id"]]
    tagger = pii.train(frame(rows))
    for r, (_, spans) in zip(rows, pii.find_batch([r["text"] for r in rows], tagger), strict=True):
        text = r["text"]
        done, out = 0, []
        for kind, a, b in spans:
            if a >= done:
                out += [text[done:a], f"<{kind}>"]
            done = max(done, b)
        r["text"] = "".join([*out, text[done:]])
    assert any("<email>" in r["text"] for r in rows)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORDS)
    want = {r["doc_id"]: [*plain.encode(r["text"], add_special_tokens=False).ids, 0] for r in rows}
    got, room = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r["doc_id"]].append((r["piece"], np.frombuffer(r["ids"], "<u4").tolist()))
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: [i for _, ids in sorted(v) for i in ids] for k, v in got.items()} == want, json.dumps(sorted(set(got) ^ set(want), key=str))
    for own in room.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:], strict=False)) and sum(n for _, n in own) <= 2048
