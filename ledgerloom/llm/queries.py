"""The thin queries over the operators of this subpackage, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import brown, cascade, exact_dedup, langid, merkle, ngram_join, packing, pii, piece_sampling, quality_rules, sharding, toxicity, url_filter
from ledgerloom.plans.scratch import settle


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.components(_table(spark, sf_dir, "documents"))


def op2_pii(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs)).select("doc_id", "pii.base", "pii.spans")
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [of(kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"), pii.spans_text(F.col("spans")).alias("spans"))


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    texts = docs.where(F.coalesce(brown.learns(), F.lit(False))).select("text")
    words = settle(brown.word_counts(texts))
    model = brown.fit(texts, words)
    scored = brown.score(docs, model, words)
    held = F.coalesce(~brown.learns(), F.lit(True))
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


def op5_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reason")


def op6_toxicity_chain(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op7_best_fit_packing(spark, sf_dir):
    packed = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), payload="crc32")
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_url_filter(spark, sf_dir):
    pages, labels = _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels")
    rules = url_filter.mine(url_filter.labelled_pages(pages, labels))
    return url_filter.judge(pages.select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict", "mined_rule")


def op9_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs, F.when(langid.learns(), F.col("lang")))
    judged = langid.identify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", (~langid.learns()).alias("held_out"), "language.lang_pred", "language.score", "language.rejected")


def op10_piece_sampling(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = piece_sampling.round_trip(docs, path)
    ids = F.array_join("pieces", ",")
    return both.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.sha2(ids, 256).alias("pieces_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op11_merkle_manifest(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(docs, altered={"n_chars": F.col("n_chars") + 1}, where=tampered)


def op12_cascading_release(spark, sf_dir):
    return cascade.release(_table(spark, sf_dir, "conversations"))


def op13_prefix_sharding(spark, sf_dir):
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = _table(spark, sf_dir, "documents").select("doc_id", sharding.text_size("text").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64("text").alias("tie"))
    placed = sharding.assign(settle(rows), F.col("size"), [F.col("doc_id"), F.col("tie")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_pii, op3_exact_dedup, op4_lm_scoring, op5_quality_rules, op6_toxicity_chain, op7_best_fit_packing, op8_url_filter, op9_language_id, op10_piece_sampling, op11_merkle_manifest, op12_cascading_release, op13_prefix_sharding)}

#: The table of CRC-32 by its rule, and the checksum of the bytes of a text.
_CRC_TABLE = """crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384::BIGINT, a >> 1) ELSE a >> 1 END) AS c
                                         FROM (SELECT unnest(range(256)) AS i)))"""


def _crc(text: str) -> str:
    """SQL of the unsigned CRC-32 of a text, beside ``crc_table``."""
    return f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda k: ('0x' || k)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])))"


_ENCODED = "coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"


def _leaf_sql(**other: str) -> str:
    return "sha256(" + " || ".join(_ENCODED.format(c=other.get(c, c)) for c in merkle.FIELDS) + ")"


ORACLES = {
    "op11_merkle_manifest": f"""
        WITH RECURSIVE {_CRC_TABLE},
        leaves AS (
            SELECT row_number() OVER () AS k, doc_id, lang AS g, {_leaf_sql()} AS leaf,
                   CASE WHEN {_crc("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf_sql(n_chars="(n_chars + 1)")} END AS altered FROM documents, crc_table),
        placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY g) AS n FROM leaves),
        up AS (
            SELECT g, 0 AS level, place, n, leaf AS d FROM placed
            UNION ALL
            SELECT g, level + 1, place // 2, any_value((n + 1) // 2), sha256(string_agg(d, '' ORDER BY place)) FROM up WHERE n > 1 GROUP BY g, level, place // 2),
        subroots AS (SELECT g, d AS subroot, level AS height, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM up WHERE n = 1),
        over AS (
            SELECT 0 AS level, place, n, subroot AS d FROM subroots
            UNION ALL
            SELECT level + 1, place // 2, any_value((n + 1) // 2), sha256(string_agg(d, '' ORDER BY place)) FROM over WHERE n > 1 GROUP BY level, place // 2),
        root AS (SELECT d AS root, level AS height FROM over WHERE n = 1),
        steps AS (
            SELECT k, l.level, (l.place >> l.level) & 1 AS right_one, up.d FROM (SELECT k, p.g, p.place, unnest(range(height)) AS level FROM placed p JOIN subroots s ON p.g IS NOT DISTINCT FROM s.g) l
            LEFT JOIN up ON up.g IS NOT DISTINCT FROM l.g AND up.level = l.level AND up.place = xor(l.place >> l.level, 1)
            UNION ALL
            SELECT k, l.height + l.level, (l.place >> l.level) & 1, over.d FROM (SELECT k, s.place, s.height, unnest(range(root.height)) AS level FROM placed p JOIN subroots s ON p.g IS NOT DISTINCT FROM s.g, root) l
            LEFT JOIN over ON over.level = l.level AND over.place = xor(l.place >> l.level, 1)),
        ways AS (SELECT k, list({{'r': right_one, 'd': coalesce(d, '')}} ORDER BY level) AS way, coalesce(string_agg(d, '' ORDER BY level), '') AS proof FROM steps GROUP BY k),
        folded AS (
            SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
                   list_reduce(list_prepend({{'r': 0::BIGINT, 'd': coalesce(altered, leaf)}}, coalesce(way, [])), lambda a, b: {{'r': 0::BIGINT, 'd': sha256(CASE WHEN b.r = 1 THEN b.d || a.d ELSE a.d || b.d END)}}).d AS folded_root
            FROM placed p JOIN subroots s ON p.g IS NOT DISTINCT FROM s.g LEFT JOIN ways USING (k), root)
        SELECT *, folded_root = root AS verified FROM folded
    """,
    "op12_cascading_release": f"""
        WITH RECURSIVE {_CRC_TABLE},
        named AS (SELECT conv_id, turn, text, coalesce(conv_id::VARCHAR, '') || ':' || coalesce(turn::VARCHAR, '') AS key,
                         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS p FROM conversations),
        drawn AS (SELECT *, list_transform(range(8), lambda k: {_crc("(k::VARCHAR || ':' || key)")}) AS h, {_crc("coalesce(text, '')")} AS crc FROM named, crc_table),
        turns AS (SELECT conv_id, turn, p, crc, CASE WHEN h[1] % 3 <= p THEN h[1] % 3 ELSE 0 END AS dist, h[2] % 101 < 35 AS faulty, 7 * p AS at, 7 * p + h[3] % 101 AS repaired,
                         list_transform(range(5), lambda a: h[a + 4] % 3 = 0) AS unlucky FROM drawn),
        -- The ends of the last two turns; null of a turn that is not delivered.
        walk AS (
            SELECT conv_id, NULL::BIGINT AS turn, -1::BIGINT AS p, NULL::VARCHAR AS status, 0::BIGINT AS attempts, NULL::BIGINT AS first_at, NULL::BIGINT AS last_at, NULL::BIGINT AS last1, NULL::BIGINT AS last2, 0::BIGINT AS crc FROM (SELECT DISTINCT conv_id FROM turns)
            UNION ALL
            SELECT conv_id, turn, p, CASE WHEN start IS NULL THEN 'blocked' WHEN good IS NULL THEN 'dead' ELSE 'delivered' END,
                   CASE WHEN start IS NULL THEN 0 ELSE coalesce(good, 5) END, start, start + 10 * (2 ** (coalesce(good, 5) - 1) - 1)::BIGINT,
                   start + 10 * (2 ** (good - 1) - 1)::BIGINT, last1, crc
            FROM (SELECT *, CASE WHEN NOT faulty THEN 1 ELSE list_min(list_filter(range(1, 6), lambda a: start + 10 * (2 ** (a - 1) - 1) >= repaired AND NOT unlucky[a])) END AS good
                  FROM (SELECT t.*, w.last1, CASE t.dist WHEN 0 THEN t.at WHEN 1 THEN CASE WHEN w.last1 IS NOT NULL THEN greatest(t.at, w.last1) END ELSE CASE WHEN w.last2 IS NOT NULL THEN greatest(t.at, w.last2) END END AS start
                        FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.p = w.p + 1))),
        numbered AS (SELECT *, CASE WHEN status = 'delivered' THEN row_number() OVER (PARTITION BY conv_id, status ORDER BY last_at, turn NULLS FIRST, crc) END AS release_no FROM walk WHERE p >= 0)
        SELECT conv_id, turn, status, attempts::INT AS attempts, first_at, last_at, release_no,
               CASE WHEN release_no IS NOT NULL THEN sum(release_no * crc) OVER (PARTITION BY conv_id, status ORDER BY release_no)::BIGINT END AS state FROM numbered
    """,
    "op13_prefix_sharding": f"""
        WITH {_CRC_TABLE},
        sized AS (SELECT doc_id, text, coalesce(octet_length(encode(text)), 0) + 1 AS size FROM documents),
        summed AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text ROWS UNBOUNDED PRECEDING) AS through, sum(size) OVER () AS total, row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS n FROM sized),
        dealt AS (SELECT *, least(((2 * through - size) * 8 // (2 * total)), 7)::INT AS shard FROM summed)
        SELECT doc_id, size::BIGINT AS size, {_crc("coalesce(text, '')")} AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY n) - 1 AS slot, NULL::INT AS grown_shard FROM dealt, crc_table
    """,
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
}
