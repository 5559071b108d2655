"""N-gram Jaccard join under several global token orders.

Two documents link when their sets of distinct 5-word shingles have a Jaccard similarity of at least
``num / den`` (75 / 100). Under any total order of the shingles, two such sets share a shingle among the
first ``n - ceil(t * n) + 1`` of each; that holds for every order at once. So:

1. One pass gives every document its set's size and a 128-bit digest, and a count sketch of all shingles,
   whose size goes with the number of documents up to a bound. Equal sets are one node from here on.
2. Order A is rare-first by the sketch. Its prefixes are an inverted index: shingles met in one set
   only go at once; of those met in one input partition by many sets, one entry leaves the partition.
   Shingles whose lists of sets are equal are one list. The sketch also says which lists are long: their
   rows are dealt by shingle and a salt, so that no list lies in one task.
3. Every set is paired, in each of its lists and each band of sizes near its own, with the set
   whose prefix shingles are the most frequent (a star around the most typical set, not all pairs). A pair must have fitting
   sizes, enough shingles from the first shared one on, and pass a parity bitmap whose Hamming distance bounds the
   symmetric difference. Then it must share a prefix shingle under the orders B and C too, two orders by
   unrelated hashes: their prefixes alone are joined to the pairs, and only what the three filters
   leave meets the whole sets, for exact verification. Connected sets become one component.
4. Then the pairs that a list holds between *different* components, in blocks, pass the same filters
   and verification. Pairs within a component cannot change it, so no link that joins texts is lost.
5. Every link lies within a component. ``components`` counts them there, over all pairs of each
   component's sets in blocks of bounded size: exact intersections, each pair in one block.

Defined cases: null or wordless text has size 0 and no link; its component is its own id. Rows that
repeat an id each give a row; a null id is the least of a component only where all are null. An empty table gives an
empty result. Very long texts are processed whole. Needed columns are id and text; others are not read, and
``drop_near_duplicates`` passes them through: of a component it keeps one row, that of the least id (of equal ids
that of the least text hash, of equal rows any one).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blocks, bloom
from ledgerloom.llm.words import free_name, mix, shingles, text_bytes, word_hashes
from ledgerloom.operators.components import connected_components
from ledgerloom.plans.scratch import settle

#: Cells of the sketch, as powers of two: 16 a document between these bounds.
SKETCH_BITS = 20, 23
_HOT = 512
_SKETCH_BLOCKS = 64
_FLUSH = 1 << 20
_BUCKET = 400_000
_CHUNK = 256
_BLOCK_GRAMS = 1 << 20
_COLUMNS = 4096
_ORDER_SEEDS = (0x51, 0xB2, 0xC3)
MAX_FILTER_BYTES = 16 << 20


def prefix_len(n, num: int, den: int):
    """n - ceil(t * n) + 1 for t = num / den."""
    return n - (n * num + den - 1) // den + 1


def _sets(batch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and shingle set of each row of a batch of (id, text), in slices of bounded size."""
    data, offsets = text_bytes(batch.column(1))
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (4 << 20), "right")) - 1)
        base = offsets[at : to + 1] - offsets[at]
        hashes, rows = word_hashes(data[offsets[at] : offsets[to]], base)
        for k, s in enumerate(shingles(hashes, rows, to - at, width)):
            yield at + k, s
        at = to


def _digests(s: np.ndarray, bits: int) -> tuple[int, int]:
    """Two numbers of 64 bits that name a set; fewer ``bits`` of the first serve tests."""
    one, two = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64).tolist()
    return (one if bits == 64 else one & ((1 << bits) - 1)), two


def _digest(s: np.ndarray, named: tuple[int, frozenset]) -> int:
    """The set's name: the first number, unless different sets were found to share it, then the second."""
    one, two = _digests(s, named[0])
    return two if one in named[1] else one


def _bitmap(s: np.ndarray) -> bytes:
    """Parity of the shingles in each of 2n to 4n bits (a power of two): folding halves keeps parity."""
    bits = max(64, 1 << int(2 * len(s) - 1).bit_length()) if len(s) else 64
    spots = (mix(s ^ np.uint64(0xD1)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(spots, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _may_link(n: np.ndarray, cap: np.ndarray, maps: list[np.ndarray], a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which of the pairs (a[k], b[k]) may link; lossless: False only where a bound rules the link out.

    ``n``: sizes; ``cap``: shingles that can be common to a linked set; ``maps``: parity bitmaps as 64-bit words.
    """
    n = n.astype(np.int64)
    both = n[a] + n[b]
    least = -(-num * both // (num + den))  # the overlap that a link needs
    ok = np.flatnonzero((np.minimum(n[a], n[b]) * den >= np.maximum(n[a], n[b]) * num) & (np.minimum(cap[a], cap[b]) >= least))
    out = np.zeros(len(a), bool)
    if not len(ok):
        return out
    size = np.array([len(m) for m in maps])
    width = np.minimum(size[a[ok]], size[b[ok]])
    for w in np.unique(width).tolist():
        own = ok[width == w]
        used, at = np.unique(np.concatenate([a[own], b[own]]), return_inverse=True)
        folded = np.empty((len(used), w), np.uint64)
        for k, i in enumerate(used.tolist()):
            m = maps[i]
            while len(m) > w:
                m = m[: len(m) // 2] ^ m[len(m) // 2 :]
            folded[k] = m
        x, y = at[: len(own)], at[len(own) :]
        step = max(1, (1 << 21) // w)
        for k in range(0, len(own), step):
            apart = np.bitwise_count(folded[x[k : k + step]] ^ folded[y[k : k + step]]).sum(1, dtype=np.int64)
            part = own[k : k + step]
            out[part] = (both[part] - apart) // 2 >= least[part]
    return out


def _keys(s: np.ndarray, order: int, sketch: np.ndarray | None) -> np.ndarray:
    """Rank of shingles in an order: A (0) has rare ones by the sketch first, B and C go by a hash of their own."""
    ranks = mix(s ^ np.uint64(_ORDER_SEEDS[order]))
    if order:
        return ranks
    count = np.minimum(sketch[(s & np.uint64(len(sketch) - 1)).astype(np.int64)], (1 << 24) - 1).astype(np.uint64)
    return (count << np.uint64(40)) | (ranks >> np.uint64(24))


def _splits(tokens: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Of each shingle, into how many parts its list is dealt: by its count in the sketch beyond the mean of all cells."""
    count = sketch[(tokens & np.uint64(len(sketch) - 1)).astype(np.int64)].astype(np.float64)
    return (1 + np.maximum(0.0, count - sketch.mean()) // _HOT).clip(1, 4096).astype(np.int32)


def _prefix(s: np.ndarray, order: int, sketch: np.ndarray | None, num: int, den: int) -> np.ndarray:
    """The first shingles of a sorted set in an order; equal ranks keep the sorted sequence."""
    return s[np.argsort(_keys(s, order, sketch), kind="stable")[: prefix_len(len(s), num, den)]]


def _scan(docs: DataFrame, width: int, bits: int, named: tuple[int, frozenset]) -> tuple[DataFrame, np.ndarray]:
    """Pass 1: per document (id, mark, n, sid, other, bitmap), and the sketch of all shingles."""

    def run(batches):
        sketch = np.zeros(1 << bits, np.int64)
        held = 0
        grams: list[np.ndarray] = []
        for b in batches:
            n, sid, other, maps = [], [], [], []
            for _, s in _sets(b, width):
                n.append(len(s))
                sid.append(_digest(s, named) if len(s) else None)
                other.append(_digests(s, 64)[1] if len(s) else None)
                maps.append(_bitmap(s))
                grams.append(s)
                held += len(s)
                if held > _FLUSH:
                    sketch += np.bincount((np.concatenate(grams) & np.uint64(len(sketch) - 1)).astype(np.int64), minlength=len(sketch))
                    grams, held = [], 0
            empty = pa.nulls(len(n), pa.int32())
            yield pa.record_batch([b.column(0).cast(pa.int64()), b.column(2), pa.array(n, pa.int32()), pa.array(sid, pa.int64()), pa.array(other, pa.int64()), pa.array(maps, pa.binary()), empty, empty, pa.nulls(len(n), pa.binary())], names=names)
        if grams:
            sketch += np.bincount((np.concatenate(grams) & np.uint64(len(sketch) - 1)).astype(np.int64), minlength=len(sketch))
        own = blocks.batch(np.minimum(sketch, 65535).astype(np.uint32), _SKETCH_BLOCKS)
        k = own.num_rows
        yield pa.record_batch([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), *own.columns], names=names)

    names = ["id", "mark", "n", "sid", "other", "bitmap", "block", "part", "payload"]
    both = settle(docs.mapInArrow(run, f"id long, mark long, n int, sid long, other long, bitmap binary, {blocks.SCHEMA}"))
    add = lambda x, y: np.minimum(x.astype(np.int64) + y, 0xFFFFFFFF).astype(np.uint32)
    sketch = blocks.merged(both.where("block is not null").select("block", "part", "payload"), _SKETCH_BLOCKS, (1 << bits) // _SKETCH_BLOCKS, "uint32", add, docs.rdd.getNumPartitions())
    return both.where("block is null").select("id", "mark", "n", "sid", "other", "bitmap"), sketch


def _index(docs: DataFrame, sketch, n_buckets: int, width: int, num: int, den: int, named: tuple[int, frozenset]) -> tuple[DataFrame, DataFrame]:
    """Pass 2: distinct (token, sid, split, salt) of order A's prefixes, for tokens met in two sets at least, one
    token for each distinct list; and by set how many tokens of its prefix come before the first such,
    and the sum of the logarithms of its lists' lengths.
    """

    def ranked(t, s, p):
        """Distinct entries by token, then set; where a token begins; and whether it has several sets."""
        order = np.lexsort((s, t))
        t, s, p = t[order], s[order], p[order]
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
        t, s, p = t[fresh], s[fresh], p[fresh]
        first = np.ones(len(t), bool)
        first[1:] = t[1:] != t[:-1]
        sizes = np.diff(np.append(np.flatnonzero(first), len(t)))
        return t, s, p, first, np.repeat(sizes > 1, sizes)

    def flush(parts):
        """Shared here: all entries go out as rows; to the buckets, one entry of each token."""
        t, s, p, first, shared = ranked(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        k = int(shared.sum())
        yield pa.record_batch([pa.array(t[shared].view(np.int64)), pa.array(s[shared]), pa.array(p[shared].astype(np.int32)), pa.array(_splits(t[shared], sketch.value)), pa.nulls(k, pa.int32()), *[pa.nulls(k, pa.binary())] * 3], names=names)
        t, s, p = t[first], s[first], p[first]
        cuts = np.searchsorted(t, np.array([(j << 64) // n_buckets for j in range(n_buckets)], np.uint64)).tolist() + [len(t)]
        own = [j for j in range(n_buckets) if cuts[j + 1] > cuts[j]]
        k = len(own)
        blobs = [pa.array([x[cuts[j] : cuts[j + 1]].tobytes() for j in own], pa.binary()) for x in (t, s, p)]
        yield pa.record_batch([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), pa.array(own, pa.int32()), *blobs], names=names)

    def run(batches):
        parts, held = [], 0
        for b in batches:
            for _, s in _sets(b, width):
                if len(s):
                    t = _prefix(s, 0, sketch.value, num, den)
                    parts.append((t, np.full(len(t), _digest(s, named), np.int64), np.minimum(np.arange(len(t)), 65535).astype(np.uint16)))
                    held += len(t)
                if held > 2 * _FLUSH:
                    yield from flush(parts)
                    parts, held = [], 0
        if parts:
            yield from flush(parts)

    def meet(table: pa.Table) -> pa.Table:
        """Of a bucket: the entries of tokens that came from two sets at least."""
        read = lambda c, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(c)])
        t, s, p, _, shared = ranked(read("tokens", np.uint64), read("sids", np.int64), read("places", np.uint16))
        return pa.table({"token": t[shared].view(np.int64), "sid": s[shared], "pos": p[shared].astype(np.int32), "split": _splits(t[shared], sketch.value)})

    names = ["token", "sid", "pos", "split", "bucket", "tokens", "sids", "places"]
    parts = settle(docs.mapInArrow(run, "token long, sid long, pos int, split int, bucket int, tokens binary, sids binary, places binary"))
    here = parts.where("bucket is null").select("token", "sid", "pos", "split")
    there = parts.where("bucket is not null").groupBy("bucket").applyInArrow(meet, "token long, sid long, pos int, split int")
    live = settle(here.union(there).distinct())
    lists = live.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.first("split").alias("split"), F.bit_xor(F.xxhash64("sid")).alias("x"), F.bit_xor(F.xxhash64("sid", F.lit(7))).alias("y"))
    one = lists.groupBy("k", "x", "y").agg(F.min("token").alias("token")).select("token", F.lit(True).alias("stands"))
    placed = settle(_salted(live).join(_dealt(lists.select("token", "k", "split").join(one, "token", "left")).drop("split"), ["token", "salt"]))
    of_set = placed.groupBy("sid").agg(F.min("pos").alias("leading"), F.sum(F.log("k")).alias("mass"))
    return placed.where("stands").select("token", "sid", "split", "salt"), of_set


def _salted(rows: DataFrame) -> DataFrame:
    """Rows of lists, each in one of its list's parts."""
    return rows.withColumn("salt", F.pmod(F.xxhash64("sid"), F.col("split")).cast("int"))


def _dealt(lists: DataFrame) -> DataFrame:
    """What is said of a list, once for each of its parts."""
    return lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("split") - 1)))


def _checked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of pairs (a, b), those that share prefixes under the orders B and C and then really link."""

    def share(batches):
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            for o in ("p1", "p2"):
                for k in np.flatnonzero(keep).tolist():
                    x, y = (np.frombuffer(b.column(c + o)[k].as_buffer(), np.uint32) for c in "xy")
                    keep[k] = len(np.intersect1d(x, y, assume_unique=False)) > 0
            yield pa.record_batch([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep))

    def verify(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("xs"), b.column("ys"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.record_batch([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def joined(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
        for end, of in (("a", "x"), ("b", "y")):
            rows = rows.join(sets.select(F.col("sid").alias(end), *[F.col(c).alias(of + name) for c, name in columns.items()]), end)
        return rows.select("a", "b", *[of + name for name in columns.values() for of in "xy"])

    near = joined(pairs, {"p1": "p1", "p2": "p2"}).mapInArrow(share, "a long, b long")
    return joined(near, {"grams": "s"}).mapInArrow(verify, "a long, b long")


def _set_table(docs: DataFrame, wanted: DataFrame, n_wanted: int, width: int, named: tuple[int, frozenset], num: int = 0, den: int = 1) -> DataFrame:
    """Pass 3: the shingle sets of the wanted (id, sid); a Bloom filter of bounded size passes over other ids.

    With a threshold also the prefixes under the orders B and C, as the lower 32 bits of their shingles:
    two prefixes that share a shingle share these.
    """
    ids = wanted.select(F.coalesce("id", F.lit(0)).alias("id"))
    filled = docs.sparkSession.sparkContext.broadcast(bloom.build(ids, n_wanted, MAX_FILTER_BYTES))

    def run(batches):
        for b in batches:
            keys = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            b = b.filter(pa.array(bloom.member(keys, filled.value)))
            found = [s for _, s in _sets(b, width) if len(s)]
            columns = [pa.array([_digest(s, named) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())]
            for o in (1, 2) if num else ():
                columns.append(pa.array([_prefix(s, o, None, num, den).astype(np.uint32).tobytes() for s in found], pa.binary()))
            yield pa.record_batch(columns, names=names)

    names = ["sid", "grams", *(["p1", "p2"] if num else [])]
    sets = docs.mapInArrow(run, "sid long, " + ", ".join(f"{c} binary" for c in names[1:])).join(wanted.select("sid"), "sid")
    return settle(sets.groupBy("sid").agg(*[F.first(c).alias(c) for c in names[1:]]))


def _across(live: DataFrame, comp: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that a list holds between different components and that may link, in blocks of bounded size."""
    seen = live.join(comp, "sid", "left").select("token", "sid", "split", "salt", F.coalesce("component", "sid").alias("c"))
    mixed = seen.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m"), F.first("split").alias("split")).where("lo < hi")
    parts = F.greatest(F.lit(1), F.ceil(F.col("m") / _CHUNK)).cast("int")
    part = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")
    rows = seen.drop("split").join(_dealt(mixed.select("token", "split", parts.alias("parts"))), ["token", "salt"]).join(nodes.select("sid", "n", "cap", "bitmap"), "sid")
    rows = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("token", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "sid", "c", "n", "cap", "bitmap")

    def pair(block: pa.Table):
        """Within a block of a list: all pairs across components (and across parts, where it has two)."""
        n, cap, c, sid, part = (block.column(k).to_numpy() for k in ("n", "cap", "c", "sid", "part"))
        order = np.argsort(n, kind="stable")
        maps = [np.frombuffer(x.as_buffer(), np.uint64) for x in block.column("bitmap")]
        apart = block.column("i")[0].as_py() != block.column("j")[0].as_py()
        own, most = n[order].astype(np.int64), cap[order].astype(np.int64)
        low = np.searchsorted(own, -(-own * num // den), "left")  # the larger of a pair looks back so far
        found = []
        for y in range(len(own)):
            x = order[low[y] : y]
            near = (c[x] != c[order[y]]) & (most[low[y] : y] * (num + den) >= num * (own[low[y] : y] + own[y])) & (most[y] * (num + den) >= num * (own[low[y] : y] + own[y]))
            x = x[near & (part[x] != part[order[y]]) if apart else near]
            if len(x):
                found.append((x, np.full(len(x), order[y])))
        if not found:
            return
        a, b = (np.concatenate(z) for z in zip(*found, strict=True))
        ok = _may_link(n, cap, maps, a, b, num, den)
        a, b = sid[a[ok]], sid[b[ok]]
        yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches):
        """Rows come sorted by block; a block may reach over batches."""
        open_rows: list = []
        for b in batches:
            keys = np.stack([b.column(k).to_numpy() for k in ("token", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            edges = [0, *cuts.tolist(), b.num_rows]
            if open_rows and b.num_rows and tuple(keys[:, 0]) != tuple(open_rows[0].column(k)[0].as_py() for k in ("token", "i", "j")):
                yield from pair(pa.Table.from_batches(open_rows))
                open_rows = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo:
                    yield from pair(pa.Table.from_batches(open_rows))
                    open_rows = []
                open_rows.append(b.slice(lo, hi - lo))
        if open_rows:
            yield from pair(pa.Table.from_batches(open_rows))

    blocks_of = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return blocks_of.mapInArrow(run, "a long, b long").distinct()


@dataclass(frozen=True)
class Found:
    """What ``links`` finds: per document (id, mark, n, sid), per set with a link (sid, component), how sets are named, and the documents read."""

    rows: DataFrame
    components: DataFrame
    named: tuple[int, frozenset]
    docs: DataFrame


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 75, den: int = 100, sid_bits: int = 64) -> Found:
    """The components of linked sets."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    bits = min(max(SKETCH_BITS[0], (16 * docs.count()).bit_length()), SKETCH_BITS[1])
    named = (sid_bits, frozenset())
    while True:
        rows, sketch = _scan(docs, width, bits, named)
        nodes = settle(rows.where("n > 0").groupBy("sid").agg(F.first("n").alias("n"), F.first("bitmap").alias("bitmap"), F.min("id").alias("id"), (F.min("other") != F.max("other")).alias("clash")))
        # Of 64-bit names some 10^10 sets share a few: those sets go by their other name.
        clash = frozenset(r["sid"] for r in nodes.where("clash").select("sid").collect())
        if not clash:
            break
        named = (sid_bits, named[1] | clash)
    sketch = spark.sparkContext.broadcast(sketch)
    total = rows.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(8, int(total * (den - num) / den / _BUCKET))
    live, of_set = _index(docs, sketch, n_buckets, width, num, den, named)
    # Two sets' first common token in order A lies in both prefixes, so it is met twice: what comes before it is in no common part.
    nodes = settle(nodes.join(of_set, "sid").select("sid", "id", "n", "bitmap", "mass", (F.col("n") - F.col("leading")).alias("cap")))
    typical = F.struct((-F.col("mass") / F.col("n")).alias("rare"), "sid")
    # Linked sets lie in the same band of sizes or in neighbouring ones.
    band = F.floor(F.log("n") / F.lit(math.log(den / num) if num < den else 1.0)).cast("int")
    placed = live.join(nodes.select("sid", "mass", "n", band.alias("band")), "sid")
    pivots = _dealt(placed.groupBy("token", "band").agg(F.min_by("sid", typical).alias("pivot"), F.first("split").alias("split")))

    def passing(batches):
        for b in batches:
            n, cap = (np.concatenate([b.column(f"{k}a").to_numpy(), b.column(f"{k}b").to_numpy()]) for k in ("n", "c"))
            maps = [np.frombuffer(x.as_buffer(), np.uint64) for k in ("ma", "mb") for x in b.column(k)]
            ok = _may_link(n, cap, maps, np.arange(b.num_rows), np.arange(b.num_rows) + b.num_rows, num, den)
            yield pa.record_batch([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    near = placed.select("token", "sid", "salt", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    star = near.join(pivots.drop("split"), ["token", "band", "salt"]).where("sid <> pivot").select(F.least("sid", "pivot").alias("a"), F.greatest("sid", "pivot").alias("b")).distinct()
    left = nodes.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("cap").alias("ca"), F.col("bitmap").alias("ma"))
    right = nodes.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("cap").alias("cb"), F.col("bitmap").alias("mb"))
    star = settle(star.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ca", "cb", "ma", "mb").mapInArrow(passing, "a long, b long"))

    def linked(pairs: DataFrame) -> DataFrame:
        wanted = settle(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct().join(nodes.select("sid", "id"), "sid"))
        return settle(_checked(pairs, _set_table(docs, wanted, wanted.count(), width, named, num, den), num, den))

    edges = linked(star)
    comp = settle(connected_components(edges, "a", "b").withColumnRenamed("node", "sid"))
    rest = settle(_across(live, comp, nodes, num, den).join(star, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        more = linked(rest)
        if not more.isEmpty():
            comp = settle(connected_components(edges.union(more), "a", "b").withColumnRenamed("node", "sid"))
    return Found(rows.select("id", "mark", "n", "sid"), comp, named, docs)


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets: products of slices of the membership matrix."""
    grams, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    met = times[at] > 1
    column = (np.cumsum(times > 1) - 1)[at[met]]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[met][order]
    both = np.zeros((len(sets), len(sets)), np.int64)
    edges = [*range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS), int(column[-1]) + 1 if len(column) else 0]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        x, y = np.searchsorted(column, (lo, hi))
        held = np.zeros((len(sets), hi - lo), np.float32)
        held[owner[x:y], column[x:y] - lo] = 1
        both += np.rint(held @ held.T).astype(np.int64)
    return both


def _link_counts(found: Found, width: int, num: int, den: int) -> DataFrame:
    """Per set with a link to another set: (sid, far), the number of documents with a different set that it links to."""
    rows = found.rows.where("n > 0").groupBy("sid").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"), F.first("n").alias("n"))
    of_set = settle(rows.join(found.components, "sid"))
    wanted = settle(of_set.select("sid", "id"))
    sizes = of_set.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    split = F.greatest(F.lit(1), F.ceil(F.col("m") / _CHUNK), F.ceil(F.col("total") / _BLOCK_GRAMS)).cast("int")
    placed = of_set.join(sizes.select("component", split.alias("split")), "component")
    placed = placed.withColumn("part", F.pmod(F.xxhash64("sid"), F.col("split")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("split") - 1)))
    placed = placed.select("component", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "sid", "copies")
    blocks_of = placed.join(_set_table(found.docs, wanted, wanted.count(), width, found.named), "sid")

    def count(block: pa.Table) -> pa.Table:
        """Within a block: of each set, the copies of the sets it links to (of the other part, where it has two)."""
        sid, part, copies = (block.column(k).to_numpy() for k in ("sid", "part", "copies"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in block.column("grams").chunks for x in c]
        n = np.array([len(s) for s in sets])
        both = _overlaps(sets)
        linked = den * both >= num * (n[:, None] + n[None, :] - both)
        np.fill_diagonal(linked, False)
        if block.column("i")[0].as_py() != block.column("j")[0].as_py():
            linked &= part[:, None] != part[None, :]
        return pa.table({"sid": sid, "far": linked @ copies})

    counted = blocks_of.groupBy("component", "i", "j").applyInArrow(count, "sid long, far long")
    return settle(counted.groupBy("sid").agg(F.sum("far").alias("far")))


def _named(found: Found) -> DataFrame:
    """Per document (id, mark, n, sid, c), c its component."""
    return found.rows.join(found.components, "sid", "left").select("id", "mark", "n", "sid", F.coalesce("component", "sid").alias("c"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 75, den: int = 100, sid_bits: int = 64) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id`` (least id reachable by links, itself included)
    and ``n_links``, the number of other documents that it links to.
    """
    found = links(docs, id_col, text_col, width, num, den, sid_bits)
    named = _named(found)
    far = _link_counts(found, width, num, den)
    near = found.rows.where("n > 0").groupBy("sid").agg((F.count(F.lit(1)) - 1).alias("near"))
    # Written first: a join with an aggregate of the same stage cannot be split where one group is large.
    links_of = settle(near.join(far, "sid", "left").select("sid", (F.col("near") + F.coalesce("far", F.lit(0))).alias("n_links")))
    least = settle(named.where("n > 0").groupBy("c").agg(F.min("id").alias("least")))
    members = named.where("n > 0").join(least, "c").select("id", "n", "sid", "least").union(named.where("n = 0").select("id", "n", "sid", "id"))
    members = members.join(links_of, "sid", "left")
    return members.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("least").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each component, with all columns; documents without a word all stay."""
    found = links(docs, id_col, text_col, **how)
    named = _named(found)
    alike = named.where("n > 0").groupBy("c", "id", "mark").agg(F.count(F.lit(1)).alias("rows"))
    best = alike.groupBy("c").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "mark", "rows")).alias("b"))
    i, m, n = (free_name(docs.columns, c) for c in ("_nj_id", "_nj_mark", "_nj_rows"))
    wordless = named.where("n = 0").select("id", "mark", F.lit(1).cast("long").alias("rows")).distinct()
    keep = settle(best.select("b.id", "b.mark", "b.rows").union(wordless).toDF(i, m, n))
    here = docs.withColumns({i: F.col(f"`{id_col}`").cast("long"), m: F.xxhash64(F.col(f"`{text_col}`"))})
    on = lambda k: here[i].eqNullSafe(k[i]) & (here[m] == k[m])
    once, more = keep.where(f"{n} = 1"), keep.where(f"{n} > 1")
    out = here.join(once, on(once), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
    if more.isEmpty():
        return out
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = here.join(more, on(more), "left_semi").groupBy(i, m).agg(F.first(whole).alias(n))
    return out.unionByName(one.select(F.col(f"{n}.*")))
