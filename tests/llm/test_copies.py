import hashlib
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import bloom, exact_dedup, ngram_join, words
from tests.llm.conftest import prose


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows, num=75, den=100):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * both >= num * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    members = defaultdict(list)
    for k in range(len(rows)):
        members[root(k)].append(k)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in members[root(k)] if rows[m][0] is not None]
        out.append((i, len(sets[k]), (min(ids) if ids else None) if sets[k] else i))
    return Counter(out)


def test_words_and_shingles_match_plain_python(docs):
    texts = [r["text"] for r in docs.select("text").collect()]
    data, offsets = words.text_bytes(pa.array(texts, pa.string()))
    hashes, rows = words.word_hashes(data, offsets)
    plain = [(t or "").encode().lower().split() for t in texts]
    assert np.bincount(rows, minlength=len(texts)).tolist() == [len(p) for p in plain]
    named = {}
    assert all(named.setdefault(h, w) == w for h, w in zip(hashes.tolist(), (w for p in plain for w in p), strict=True))
    assert [len(s) for s in words.shingles(hashes, rows, len(texts))] == [len(shingle_set(t)) for t in texts]


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    text = pa.array(["a bb ccc dddd " * 50, None, "e" * 700, "f g"])
    whole = words.word_hashes(*words.text_bytes(text))
    monkeypatch.setattr(words, "_STEP", 64)
    monkeypatch.setattr(words, "_POWERS", [])
    for x, y in zip(whole, words.word_hashes(*words.text_bytes(text)), strict=True):
        assert (x == y).all()


def test_bloom_never_misses_a_repeated_key(spark):
    keys = list(range(3000)) + list(range(0, 3000, 7))
    df = spark.createDataFrame([(k * 977,) for k in keys], "key long").repartition(6)
    filled = bloom.build(df, len(keys), 1 << 20)
    again = bloom.repeated(np.arange(3000) * 977, filled)
    assert again[::7].all() and again.mean() < 0.35
    assert bloom.member(np.arange(3000) * 977, filled).all()
    small = bloom.build(df, len(keys), 1 << 10)
    assert bloom.repeated(np.arange(3000) * 977, small)[::7].all()


@pytest.mark.parametrize("max_bytes", [1 << 20, 1 << 8])
def test_duplicate_groups(docs, max_bytes):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    got = exact_dedup.duplicate_groups(docs, max_filter_bytes=max_bytes).collect()
    own = defaultdict(list)
    for i, t in rows:
        own[t].append(i)
    want = Counter((i, max((x for x in own[t] if x is not None), default=None), len(own[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(own)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_drop_duplicates_keeps_one_whole_row(docs):
    got = exact_dedup.drop_duplicates(docs)
    assert got.columns == docs.columns
    assert Counter(r["text"] or "" for r in got.collect()) == Counter({r["text"] or "": 1 for r in docs.collect()})


def test_join_equals_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.components(docs).collect())
    assert got == brute_components(rows)


def test_join_at_low_threshold_goes_across_components(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "_CHUNK", 3)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.components(docs, num=40, den=100).collect())
    assert got == brute_components(rows, 40)


def brute_links(rows, num, den):
    sets = [shingle_set(t) for _, t in rows]
    n = [0] * len(rows)
    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * both >= num * len(sets[a] | sets[b]):
            n[a] += 1
            n[b] += 1
    return Counter((i, k) for (i, _), k in zip(rows, n, strict=True))


@pytest.mark.parametrize("num", [75, 40])
def test_every_link_within_a_component_is_counted(docs, monkeypatch, num):
    monkeypatch.setattr(ngram_join, "_CHUNK", 3)
    monkeypatch.setattr(ngram_join, "_COLUMNS", 50)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = Counter((r["doc_id"], r["n_links"]) for r in ngram_join.components(docs, num=num, den=100).collect())
    assert got == brute_links(rows, num, 100)
    assert max(k for _, k in got) >= 3


def test_filters_lose_no_link():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    sets = [np.sort(np.concatenate([rng.choice(base, k, replace=False), rng.integers(0, 2**63, j).astype(np.uint64)])) for k in (50, 120, 300, 390) for j in (0, 5, 30, 90) for _ in range(3)]
    a, b = (np.array(x) for x in zip(*combinations(range(len(sets)), 2), strict=True))
    maps = [np.frombuffer(ngram_join._bitmap(s), np.uint64) for s in sets]
    n = np.array([len(s) for s in sets])
    ok = ngram_join._may_link(n, n, maps, a, b, 75, 100)
    sketch = np.zeros(1 << 10, np.uint32)
    for x, y, may in zip(a, b, ok, strict=True):
        both = len(np.intersect1d(sets[x], sets[y]))
        if 100 * both >= 75 * (n[x] + n[y] - both):
            assert may
            for o in range(3):
                assert np.isin(ngram_join._prefix(sets[x], o, sketch, 75, 100), ngram_join._prefix(sets[y], o, sketch, 75, 100)).any()


def test_sets_that_share_a_name_get_another(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.components(docs, sid_bits=5).collect())
    assert got == brute_components(rows)


def test_orders_are_three(spark):
    s = np.sort(np.random.default_rng(2).integers(0, 2**63, 400).astype(np.uint64))
    sketch = np.zeros(1 << 10, np.uint32)
    first = [set(ngram_join._prefix(s, o, sketch, 75, 100).tolist()) for o in range(3)]
    assert all(len(x & y) < 0.5 * len(x) for x, y in combinations(first, 2))


def test_hot_lists_are_dealt_to_several_parts():
    sketch = np.ones(1 << 10, np.uint32)
    sketch[7] = 6000
    assert ngram_join._splits(np.array([7, 8, 7 + (1 << 10)], np.uint64), sketch).tolist() == [12, 1, 12]


def test_repeated_ids_are_decided_by_row(spark):
    text, other = prose(random.Random(1), 60), prose(random.Random(2), 60)
    rows = [(0, text, "x"), (1, text, "y"), (1, other, "z"), (2, "", "e"), (2, "", "e"), (5, other + " end", "w"), (7, prose(random.Random(3), 30), "r"), (7, prose(random.Random(3), 30), "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _nj_id string").repartition(3)
    got = sorted((r["doc_id"], r["_nj_id"]) for r in ngram_join.drop_near_duplicates(df).collect())
    assert got == [(0, "x"), (1, "z"), (2, "e"), (2, "e"), (7, "r")]


def test_drop_near_duplicates_and_empty(docs, no_docs):
    got = ngram_join.drop_near_duplicates(docs)
    comp = {r["component_id"] for r in ngram_join.components(docs).collect()}
    kept = [r["doc_id"] for r in got.collect()]
    assert set(kept) == comp and len([k for k in kept if k is not None]) == len(comp - {None})
    assert ngram_join.components(no_docs).count() == 0
    assert exact_dedup.duplicate_groups(no_docs).count() == 0
    assert exact_dedup.drop_duplicates(no_docs).count() == 0
