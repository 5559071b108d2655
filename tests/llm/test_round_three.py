"""The manifest, the cascade and the shards against plain versions, over edge cases and hot keys."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from tests.llm.conftest import SCHEMA, corpus
from pyspark.sql import functions as F

from ledgerloom.llm import cascade, merkle, ordered, sharding

TURNS = "conv_id long, turn long, role string, text string"


def plain_cascade(rows):
    """Turn by turn, attempt by attempt."""
    convs, out = defaultdict(list), []
    for r in rows:
        convs[r[0]].append(r)
    text = lambda v: "" if v is None else str(v)
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        ended, found = [], []
        for p, (_, turn, _, said) in enumerate(own):
            h = lambda k: crc32(f"{k}:{text(conv)}:{text(turn)}".encode())  # noqa: B023, E731
            at, parent = 7 * p, p - h(0) % 3
            start = at
            if 0 <= parent < p:
                start = None if ended[parent] is None else max(at, ended[parent])
            if start is None:
                ended.append(None)
                found.append((conv, turn, "blocked", 0, None, None, said))
                continue
            repaired = at + h(2) % 101 if h(1) % 101 < 35 else None
            now, end = start, None
            for a in range(1, 6):
                if repaired is None or not (now < repaired or h(a + 2) % 3 == 0):
                    end = now
                    break
                if a < 5:
                    now += 10 * 2 ** (a - 1)
            ended.append(end)
            found.append((conv, turn, "dead" if end is None else "delivered", a, start, now, said))
        state, n = 0, 0
        for f in sorted((f for f in found if f[2] == "delivered"), key=lambda f: (f[5], f[1] is not None, f[1] or 0)):
            n += 1
            state += n * crc32((f[6] or "").encode())
            out.append((*f[:6], n, (state + 2**63) % 2**64 - 2**63))
        out += [(*f[:6], None, None) for f in found if f[2] != "delivered"]
    return out


def turns_of(seed, long_one=0):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice([None, "", f"said {c} {t}", "ñandú " * rng.randrange(40)])) for c in range(40) for t in range(rng.randrange(1, 14))]
    rows += [(7000, t, "user", f"t{t}") for t in range(long_one)]
    return [*rows, (None, 0, "user", "no conversation"), (None, None, "bot", None), (50, None, None, "no turn"), (50, 3, None, "x"), (51, -4, "user", "x"), (51, 9_000_000_000, "user", "y")]


def key(r):
    return tuple((v is not None, v) for v in r)


@pytest.mark.parametrize(("long_one", "parts"), [(0, 3), (1500, 11), (300, 120)])
def test_cascade_equals_plain_loops(spark, long_one, parts):
    """A conversation with most of the rows lies in many partitions; in the last case most of these hold a few rows only, so stretches cross several."""
    rows = turns_of(5, long_one)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = cascade.release(spark.createDataFrame(rows, TURNS).repartition(4)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, got), key=key) == sorted(plain_cascade(rows), key=key)


def test_cascade_of_long_conversations_wraps_and_repeats_are_kept(spark):
    rows = turns_of(6) * 2
    got = cascade.release(spark.createDataFrame(rows, TURNS)).collect()
    assert len(got) == len(rows) and sorted((r["conv_id"] or -1, r["turn"] or -1) for r in got) == sorted((r[0] or -1, r[1] or -1) for r in rows)
    big = spark.range(3).select(F.expr("cast('9223372036854775808' as decimal(38,0)) * 3 + id").alias("x")).select(cascade._long(F.col("x"))).collect()
    assert [r[0] for r in big] == [-(2**63), -(2**63) + 1, -(2**63) + 2]


def test_attempts_table_is_the_loop():
    policy = cascade.Policy()
    table = cascade.attempts_table(policy)
    for remaining in range(policy.modulus):
        for mask in range(32):
            now, want = 0, 0
            for a in range(5):
                if now >= remaining and not mask >> a & 1:
                    want = a + 1
                    break
                now += 10 * 2**a
            assert table[remaining, mask] == want


def test_other_policies(spark):
    """Parents up to six turns back, and another number of attempts: chains of any reach stay whole."""
    policy = cascade.Policy(reach=7, attempts=3, first_wait=4, gap=2)
    rows = [(c, t, "u", f"{c} {t}") for c in (1, 2) for t in range(300)]
    h = lambda k, c, t: crc32(f"{k}:{c}:{t}".encode())
    want = {}
    for c in (1, 2):
        ended = {}
        for t in range(300):
            parent = t - h(0, c, t) % 7
            start = 2 * t if not 0 <= parent < t else None if ended[parent] is None else max(2 * t, ended[parent])
            ended[t] = None
            if start is None:
                want[c, t] = "blocked"
                continue
            repair = h(2, c, t) % 101 if h(1, c, t) % 101 < 35 else None
            times = [start, start + 4, start + 12]
            ended[t] = next((s for a, s in enumerate(times, 1) if repair is None or not (s < 2 * t + repair or h(a + 2, c, t) % 3 == 0)), None)
            want[c, t] = "dead" if ended[t] is None else "delivered"
    got = {(r["conv_id"], r["turn"]): r["status"] for r in cascade.release(spark.createDataFrame(rows, TURNS).repartition(3), policy).collect()}
    assert got == want and len(set(want.values())) == 3


def hexed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([hexed(*now[i : i + 2]) for i in range(0, len(now), 2)])
    return levels


def plain_way(levels, k):
    out = []
    for nodes in levels[:-1]:
        run = nodes[k // 2 * 2 : k // 2 * 2 + 2]
        out.append((run[: k % 2], run[k % 2 + 1 :]))
        k //= 2
    return out


def plain_manifest(rows):
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: hexed(text(r[0]), text(r[3]), text(r[2]), text(None if r[4] is None else r[4] + more), text(r[1]))
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = plain_tree([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for k, (known, doc_id, own, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            way = plain_way(trees[g], k) + plain_way(top, at)
            d = leaf(r, 1) if known and crc32(str(doc_id).encode()) % 7 == 0 else own
            for left, right in way:
                d = hexed(*left, d, *right)
            out.append((r[0], own, trees[g][-1][0], top[-1][0], hexed(*[x for left, right in way for x in (*left, *right)]), d, d == top[-1][0]))
    return out


def manifest(df, **more):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(df, altered={"n_chars": F.col("n_chars") + 1}, where=tampered, **more)


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_manifest_equals_plain_trees(spark, bits):
    rows = corpus()
    got = manifest(spark.createDataFrame(rows, SCHEMA).repartition(5), bits=bits).collect()
    want = plain_manifest(rows)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert {False, True} == {r["verified"] for r in got}


def test_manifest_of_one_group_over_many_partitions_and_of_nothing(spark, no_docs):
    rows = [(k, f"text {k}", "en", "s", 6) for k in range(700)] + [(9000, "y", "de", None, None)] + [(k, f"lone {k}", f"l{k}", None, 1) for k in range(20)]
    got = manifest(spark.createDataFrame(rows, SCHEMA).repartition(7), bits=3).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain_manifest(rows), key=key)
    assert manifest(no_docs).collect() == [] and len(manifest(spark.createDataFrame(rows[:1], SCHEMA)).collect()) == 1


def test_manifest_shows_any_change(spark):
    rows = [(k, f"t{k}", "en" if k % 3 else "fr", "s", 2) for k in range(40)]
    root = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).first()["root"]
    assert merkle.manifest(spark.createDataFrame(rows[::-1], SCHEMA).repartition(9)).first()["root"] == root
    assert all(r["verified"] for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect())
    for k, field, value in ((3, 1, "T3"), (7, 2, "de"), (0, 3, None)):
        other = [*rows]
        other[k] = (*rows[k][:field], value, *rows[k][field + 1 :])
        assert merkle.manifest(spark.createDataFrame(other, SCHEMA)).first()["root"] != root


def plain_shards(rows, n=8):
    """By the middle byte of each row in the order of ids; rows of equal ids in any order, so as (id, shard, slot) without these."""
    sizes = [(r[0], len((r[1] or "").encode()) + 1) for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    total, at, slots, out = sum(s for _, s in sizes), 0, defaultdict(int), []
    for doc_id, s in sizes:
        shard = min(n - 1, (2 * at + s) * n // (2 * total))
        out.append((doc_id, s, shard, slots[shard]))
        slots[shard] += 1
        at += s
    return out


def shard_rows(df, n=8):
    placed = sharding.shards(df, n).withColumn("size", sharding.text_size("text"))
    return [(r["doc_id"], r["size"], r["shard"], r["slot"]) for r in placed.collect()]


@pytest.mark.parametrize("parts", [1, 4, 37])
def test_shards_equal_plain_prefix_sums(spark, parts):
    rows = [r for r in {r[0]: r for r in corpus()}.values()]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = shard_rows(spark.createDataFrame(rows, SCHEMA).repartition(5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(got, key=key) == sorted(plain_shards(rows), key=key)


def test_shards_of_a_hot_id_and_of_equal_rows_stay_even(spark):
    rows = [(1, "same text", "en", "s", 9)] * 900 + [(k, "other " * (k % 5), "en", "s", 1) for k in range(2, 902)]
    got = shard_rows(spark.createDataFrame(rows, SCHEMA).repartition(6))
    sizes, slots = defaultdict(int), defaultdict(list)
    for _, size, shard, slot in got:
        sizes[shard] += size
        slots[shard].append(slot)
    assert len(got) == len(rows) and set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 2 * 26
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    ids = defaultdict(list)
    for doc_id, _, shard, _ in got:
        ids[shard].append(doc_id)
    assert all(max(ids[s]) <= min(ids[s + 1]) for s in range(7))


def test_shards_carry_columns_of_any_name(spark, no_docs):
    df = spark.createDataFrame([(1, "a b", 5, 7, {"k": 1}), (2, None, 6, 8, None)], "doc_id long, text string, `Shard` int, `_p.x` int, _number map<string,int>")
    got = sharding.shards(df, 2)
    assert got.columns == [*df.columns, "shard_", "slot"]
    assert sorted((r["doc_id"], r["Shard"], r["_p.x"], r["shard_"], r["slot"]) for r in got.collect()) == [(1, 5, 7, 0, 0), (2, 6, 8, 1, 0)]
    assert sharding.shards(no_docs).collect() == []


def test_written_shards_are_whole(spark, docs, tmp_path):
    sharding.write_shards(docs, f"{tmp_path}/out", 3)
    back = spark.read.parquet(f"{tmp_path}/out")
    want = {(r["shard"], r["slot"]): r["text"] for r in sharding.shards(docs, 3).collect()}
    assert {(r["shard"], r["slot"]): r["text"] for r in back.collect()} == want and len(want) == docs.count()


def test_places_in_groups_over_partitions(spark):
    rows = [(g, k) for g, n in ((None, 5), ("a", 900), ("b", 1), ("c", 300)) for k in range(n)]
    spark.conf.set("spark.sql.shuffle.partitions", 13)
    try:
        local = ordered.numbered(spark.createDataFrame(rows, "g string, k long").repartition(4), "g", "k")
        both = ordered.joined(local, ordered.carried(local, "g"), "g", "_before", "_more").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert all(r["_place"] + (r["_before"] or 0) == r["k"] for r in both) and len(both) == len(rows)
    ends = {(r["g"], r["k"]) for r in both if r["_ends"] and not (r["_edge"] & ordered.TAIL and r["_more"])}
    assert ends == {(None, 4), ("a", 899), ("b", 0), ("c", 299)}
