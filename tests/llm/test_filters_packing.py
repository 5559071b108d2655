import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import packing, quality_rules, url_filter

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_measures_equal_plain_python(spark, docs):
    extra = spark.createDataFrame([(500, "a b c a b c a b\na b\n\n a b\na b"), (501, "x x x x"), (502, "x x x"), (503, "#1 $2 | <b>\r\n\tq\x0b\x0cq"), (504, "\n\n")], "doc_id long, text string")
    df = docs.select("doc_id", "text").union(extra)
    want = Counter()
    for i, t in ((r["doc_id"], r["text"] or "") for r in df.collect()):
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        n = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        want[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)] += 1
    got = Counter((r["id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality_rules.measures(df).collect())
    assert got == want


def labelled(spark, n=900):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(n):
        w = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 120))]
        bad = k % 5 == 0
        if bad:
            w = [x + "###" if rng.random() < 0.6 else x for x in w] if k % 2 else [x.upper() for x in w]
        rows.append((k, " ".join(w)))
        labels.append((k, int(not bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_learned_list_rejects_bad_and_keeps_clean(spark, no_docs):
    docs, labels = labelled(spark)
    got = {r["doc_id"]: r for r in quality_rules.judge(docs, labels.where("doc_id < 600")).collect()}
    later = [got[k] for k in range(600, 900)]
    assert sum(r["kept"] == (r["doc_id"] % 5 != 0) for r in later) >= 0.98 * len(later)
    assert all(r["kept"] for r in later if r["doc_id"] % 5)
    assert quality_rules.train(quality_rules.measures(docs), labels.where("false")) == []
    assert quality_rules.judge(no_docs, labels).count() == 0


def plain_covering(rows):
    """The decision list by counting rows one by one, and the rules as grown, before pruning."""
    names, quality = quality_rules.FEATURES, quality_rules
    cuts = {}
    for f in names:
        own = sorted(r[f] for r in rows)
        cuts[f] = sorted({own[max(0, math.ceil(k / quality.BINS * len(own)) - 1)] for k in range(1, quality.BINS)})
    holds = lambda rule, r: all((r[f] > c) == above for f, above, c in rule)
    count = lambda own, bad: sum(r["bad"] == bad for r in own)
    n_prune = sum(r["prune"] for r in rows)
    rules, grown = [], []
    while len(rules) < quality.MAX_RULES:
        left = [r for r in rows if not any(holds(x, r) for x in rules)]
        rule = []
        while len(rule) < quality.MAX_CONDITIONS:
            own = [r for r in left if not r["prune"] and holds(rule, r)]
            p0, n0 = count(own, True), count(own, False)
            if p0 < quality.MIN_COVER or not n0:
                break
            best, found = 1e-9, None
            for f in names:
                for cut in cuts[f]:
                    for above in (True, False):
                        hit = [r for r in own if (r[f] > cut) == above]
                        p, n = count(hit, True), count(hit, False)
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p >= quality.MIN_COVER else -1
                        if gain > best * (1 + 1e-12):
                            best, found = gain, (f, above, cut)
            if found is None:
                break
            f, above, cut = found
            outside = [r[f] for r in own if (r[f] > cut) != above]
            inside = [r[f] for r in own if (r[f] > cut) == above and r["bad"]]
            if outside:
                cut = (max(outside) + min(inside)) / 2 if above else (min(outside) + max(inside)) / 2
            rule.append((f, above, cut))
        if not rule:
            break
        scored = []
        for k in range(1, len(rule) + 1):
            own = [r for r in left if r["prune"] and holds(rule[:k], r)]
            p, n = count(own, True), count(own, False)
            if p + n >= max(3, quality.MIN_SHARE * n_prune) and p / (p + n) >= quality.MIN_PRECISION:
                scored.append(((p - n) / (p + n) * math.sqrt(p), -k))
        if not scored:
            break
        rules.append(tuple(rule[: -max(scored)[1]]))
        grown.append(tuple(rule))
    return rules, grown


def test_learned_list_equals_plain_covering(spark):
    """Conjunctions and single thresholds in the data, with wrong labels: rules grow, are pruned, and follow each other."""
    longest = pruned = 0
    for seed in (3, 4, 5):
        rng = random.Random(seed)
        rows = []
        for k in range(1201):  # a prime: no quantile falls between two rows
            r = {f: round(rng.random(), 6) for f in quality_rules.FEATURES}
            bad = r["symbol_rate"] > 0.55 and r["upper_rate"] > 0.5 or r["dup_line_rate"] > 0.85
            rows.append(r | {"bad": bad if rng.random() > 0.01 else not bad, "prune": k % 3 == 0})
        want, grown = plain_covering(rows)
        df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{f} double" for f in quality_rules.FEATURES) + ", bad boolean, prune boolean")
        got = quality_rules.learn(df.repartition(3))
        assert [[(c.feature, c.above) for c in rule] for rule in got] == [[x[:2] for x in rule] for rule in want]
        assert np.allclose([c.cut for rule in got for c in rule], [x[2] for rule in want for x in rule])
        longest = max([longest, *map(len, want)])
        pruned += sum(len(a) < len(b) for a, b in zip(want, grown, strict=True))
    assert longest > 1 and pruned


def test_urls_follow_the_rules(spark):
    urls = ["http://A.Example.NET/en/x?y#z", "https://example.com/de/1", "http://sub.org/fr/", "http://net/", "http://net", "http://subnet/en/", None, "no scheme", "x://h?q", "x://h#f", "http://example.com/DE/", "http://u.example.net/fr/9", "a://b://c/d"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate([*urls, urls[0]])], "page_id long, url string")
    none = url_filter.mine(spark.createDataFrame([], "tokens array<string>, bad boolean"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(df, none).collect()}
    assert got[0] == got[13] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("example.com", "/de/1", "example.com/de/", "block") and got[2] == ("sub.org", "/fr/", "org/fr/", "allow")
    assert got[3] == ("net", "/", "net/", "block") and got[4] == ("net", "", None, "allow") and got[5][2] is None
    assert got[6] == got[7] == ("", "", None, "allow") and got[8] == ("h", "", None, "allow") and got[9] == ("h", "", None, "allow")
    assert got[10][2] is None and got[11] == ("u.example.net", "/fr/9", "net/", "block") and got[12] == ("b:", "//c/d", None, "allow")
    assert len(got) == 14


def test_mined_rules_match_like_plain_subsets(spark):
    rng = random.Random(8)
    rows = []
    for k in range(2000):
        host = rng.choice(["spam", "blog", "news"])
        path = rng.choice(["ads", "read"])
        bad = host == "spam" and path == "ads"
        rows.append((k, f"http://{host}.site{rng.randrange(4)}.io/{path}/x{rng.randrange(999)}", bad if rng.random() > 0.02 else not bad))
    df = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    host, path = url_filter.split_url(F.col("url"))
    marked = df.select("url", "bad", host.alias("host"), path.alias("path")).select("url", "bad", url_filter.tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    rules = url_filter.mine(marked.select("tokens", "bad"))
    kept = [frozenset(r["items"]) for r in rules.collect()]
    assert frozenset(["h:spam", "p:ads"]) in kept and not any(frozenset(["h:spam", "p:ads"]) < r and len(r) > 2 and "d:" not in str(r) and "h:" + "site" not in str(r) and "h:io" not in r for r in kept)
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(df.select("page_id", "url"), rules, listed_rules=()).collect()}
    tokens = {r["url"]: set(r["tokens"]) for r in marked.collect()}
    assert all(got[k] == ("block" if any(r <= tokens[u] for r in kept) else "allow") for k, u, _ in rows)
    assert sum(got[k] == "block" for k, u, _ in rows) == sum("spam" in u and "/ads/" in u for _, u, _ in rows)


def test_rules_need_pages_and_may_be_long(spark):
    nine, ten = [["h:x", "p:one"]] * 9, [["h:y", "p:two"]] * 10
    need = [f"p:{k}" for k in range(5)]
    lacking = [[x for x in need if x != k] for k in need for _ in range(10)]
    rows = [(t, True) for t in nine + ten + [need] * 10] + [(t, False) for t in lacking]
    got = {frozenset(r["items"]): r["anchor"] for r in url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()}
    assert set(got) == {frozenset(["h:y"]), frozenset(["p:two"]), frozenset(need)}
    assert all(a in r for r, a in got.items())


def plain_covers(rows):
    """By all subsets of tokens: the rows that each rule holds for, of rules that no shorter one makes idle."""
    n, bad = len(rows), sum(b for _, b in rows)
    z2 = 1.96**2

    def judged(items):
        held = frozenset(k for k, (t, _) in enumerate(rows) if items <= t)
        hits = sum(rows[k][1] for k in held)
        if hits < 10:
            return None
        c, m = hits / len(held), len(held)
        sure = (c + z2 / (2 * m) - 1.96 * (c * (1 - c) / m + z2 / (4 * m * m)) ** 0.5) / (1 + z2 / m)
        return (c, held) if c >= 0.8 and sure > bad / n else None

    tokens = sorted({t for own, _ in rows for t in own})
    found = {frozenset(c): r for k in range(1, len(tokens) + 1) for c in combinations(tokens, k) if (r := judged(frozenset(c)))}
    return {held for items, (c, held) in found.items() if not any(less < items and found[less][0] >= c for less in found)}


@pytest.mark.parametrize("seed", [0, 2])
def test_mined_rules_cover_what_all_subsets_cover(spark, seed):
    """Tokens that come together, that imply each other, that do so beside a third only, and others."""
    rng = random.Random(seed)
    rows = []
    for _ in range(500):
        depth = rng.randrange(5)
        own = {f"p{k}" for k in range(depth)} | ({"twin1", "twin2"} if rng.random() < 0.4 else set()) | {t for t in ("a", "b") if rng.random() < 0.5}
        own |= {"c"} if "a" in own else set()
        rows.append((own, rng.random() < (0.95 if ("a" in own and depth > 2) or {"b", "twin1"} <= own else 0.2)))
    mined = url_filter.mine(spark.createDataFrame([(sorted(t), b) for t, b in rows], "tokens array<string>, bad boolean")).collect()
    covers = {frozenset(k for k, (t, _) in enumerate(rows) if set(r["items"]) <= t) for r in mined}
    assert covers == plain_covers(rows) and covers
    for r in mined:
        held = [b for t, b in rows if set(r["items"]) <= t]
        assert r["confidence"] == pytest.approx(sum(held) / len(held)) and r["support"] == pytest.approx(sum(held) / 500) and r["anchor"] in r["items"]


def test_long_common_paths_are_mined_in_seconds(spark):
    """Thirty segments that all pages of a site share, and prefixes of them of any length; all subsets would be 2^30 sets."""
    path = [f"p:{k:02}" for k in range(30)]
    rows = [(["s:https", "h:site", *path, f"h:{k % 2}"], k % 20 > 0) for k in range(600)] + [(["s:https", "h:other", *path[: k % 31]], k % 31 > 25) for k in range(620)]
    began = time.monotonic()
    got = {frozenset(r["items"]) for r in url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()}
    assert time.monotonic() - began < 90
    assert frozenset(["h:site"]) in got and frozenset(["p:29"]) in got


def test_labels_that_do_not_depend_on_the_url_give_no_rule(spark):
    rng = random.Random(13)
    rows = [([f"h:{rng.randrange(8)}", f"p:{rng.randrange(8)}", "s:https"], rng.random() < 0.3) for _ in range(3000)]
    assert url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).count() == 0
    mostly = [(["s:https", f"p:{k % 3}"], k % 20 > 0) for k in range(400)]  # 95 % are bad whatever the URL: no better than the base rate
    assert url_filter.mine(spark.createDataFrame(mostly, "tokens array<string>, bad boolean")).count() == 0


def plain_best_fit(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            rooms.append(capacity - x)
    return len(rooms)


def test_plans_hold_everything_and_are_tight():
    rng = random.Random(7)
    for _ in range(200):
        capacity = rng.choice([10, 30, 100])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randrange(60)))
        plan = packing.plan(counts, capacity)
        bins = defaultdict(list)
        for length, n in counts.items():
            for s, o in zip(*plan.place(length, np.arange(n)), strict=True):
                bins[s].append((o, length))
        assert len(bins) == plan.bins <= plain_best_fit(counts.elements(), capacity)
        for own in bins.values():
            at = 0
            for o, length in sorted(own):
                assert o == at
                at += length
            assert at <= capacity


def test_reduction_keeps_an_optimum():
    def best(items, capacity):
        items = sorted(items, reverse=True)
        least = len(items)

        def go(k, rooms):
            nonlocal least
            if len(rooms) >= least:
                return
            if k == len(items):
                least = len(rooms)
                return
            for r in sorted({r for r in rooms if r >= items[k]}):
                rest = list(rooms)
                rest.remove(r)
                go(k + 1, [*rest, r - items[k]])
            go(k + 1, [*rooms, capacity - items[k]])

        go(0, [])
        return least

    rng = random.Random(11)
    for _ in range(150):
        items = [rng.randint(1, 12) for _ in range(rng.randrange(9))]
        fixed, rest = packing.reduce_dominated(Counter(items), 12)
        assert sum(n for _, n in fixed) + best(list(Counter(rest).elements()), 12) == best(items, 12), items


def test_pack_documents(spark, docs, no_docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, capacity=256).collect()
    sequences, own = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        own[r["doc_id"]].append((r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())))
    for spans in sequences.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 256
    want = defaultdict(list)
    for r in docs.collect():
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want[r["doc_id"]] += [(k, s, tuple(ids[s : s + 256])) for k, s in enumerate(range(0, len(ids), 256))]
    assert {k: Counter(v) for k, v in own.items()} == {k: Counter(v) for k, v in want.items()}
    total = sum(n for s in sequences.values() for _, n in s)
    assert len(sequences) <= 1.05 * -(-total // 256) + 1
    assert packing.pack(no_docs, path).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = now.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "pii", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == columns, name
    kept = {r["doc_id"] for r in now.collect()}
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == kept


def test_ids_equal_the_plain_tokenizer():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(path), packing.WordTokenizer(path)
    assert own.by_chunk and own.added == ["<|startoftext|>", "<|endoftext|>"]
    rng = random.Random(12)
    parts = ["<|startoftext|>", "<|STARTOFTEXT|>", "<|endoftext|>", "x<|EndOfText|>y", "<|", "|>", "It's", "WE'LL", "it’s", "Größe", "ŒUVRE", "İstanbul", "ŉ", "été", "中文", " ", "\t", "\r\n", "\x0b", "a,b", "end.", "(x)!", "3.14", "n°5", "ß", "µ", "́", "≠", "🎉", "word", " ", "  ", "\n\n", "ﬁn", "ÀÉ", "<b>", "l'année", "x" * 50]
    texts = ["", *parts, *["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(1, 30))) for _ in range(1500)]]
    want = [[*plain.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    for k in range(0, len(texts), 97):
        assert [x.tolist() for x in own.batch(texts[k : k + 97])] == want[k : k + 97]
    own.size = packing._MEMO_BYTES + 1  # forgets, and learns again
    assert own(texts[-1]).tolist() == want[-1] and own.size < 1 << 20 and own.batch([]) == []


def test_other_tokenizer_files_get_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, text = packing.WordTokenizer(path), "Two  Words,\n<|endoftext|> É"
    assert not own.by_chunk and own(text).tolist() == [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 0]
