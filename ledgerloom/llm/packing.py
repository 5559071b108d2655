"""Packing token sequences: Martello-Toth dominance reduction, then best-fit, on the histogram of lengths.

A bin's contents depend on lengths only, and lengths are whole numbers up to the capacity, so the
histogram (at most ``capacity`` counts, whatever the corpus) says all that packing needs. The driver
plans *patterns*: a multiset of lengths and how many bins hold it. Executors then deal pieces to the
plan by their rank among the pieces of their length, which needs per partition counts, no sort and no
group in one task.

The reduction fixes bins that some optimal packing holds: with the longest piece j,
``{j}`` where nothing fits beside it; ``{j, i}`` where i fills the bin exactly, or where no two pieces fit
beside j and i is the longest that fits; and where i, the longest that fits, is no shorter than
any two that fit together. It goes on past pieces that no rule fixes, and repeats until none applies.

Defined cases: a null text is empty; an empty document is its end token alone; a document longer than
the capacity is cut into pieces of it; ties in length are dealt in partition order; rows that repeat are packed each; a null
id gives rows like any other; an empty table gives an empty result. Texts are read whole; only the id and the text are read.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain, compress, repeat
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.words import Rows
from ledgerloom.plans.scratch import settle

CAPACITY = 2048
END = 0
#: Bytes that a worker process remembers at most, each chunk counted with its entry.
_MEMO_BYTES = 64 << 20
_ENTRY = 150
_BATCH_CHARS = 1 << 20
_JOINT = re.compile("(?<=[a-z])(?=[.,;:!?])")


class _Lengths:
    """Counts by length, with the greatest present length up to a bound."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in counts.items() if n}
        self.order = sorted(self.counts)

    def take(self, length: int, n: int = 1) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.order.pop(bisect.bisect_left(self.order, length))

    def upto(self, bound: int) -> int | None:
        k = bisect.bisect_right(self.order, bound)
        return self.order[k - 1] if k else None

    def two_least(self) -> int | None:
        """Sum of the two least pieces."""
        if not self.order:
            return None
        a = self.order[0]
        if self.counts[a] > 1:
            return 2 * a
        return a + self.order[1] if len(self.order) > 1 else None

    def best_two(self, bound: int) -> int | None:
        """Greatest sum of two pieces within ``bound``."""
        best, lo, hi = None, 0, bisect.bisect_right(self.order, bound) - 1
        while lo <= hi:
            a, b = self.order[lo], self.order[hi]
            if a + b > bound or (lo == hi and self.counts[a] < 2):
                hi -= 1
            else:
                best = a + b if best is None else max(best, a + b)
                lo += 1
        return best


def reduce_dominated(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fixed patterns (lengths, number of bins), and the counts that remain."""
    left, fixed = _Lengths(counts), []

    def fix(pattern: tuple[int, ...], n: int) -> None:
        for length in pattern:
            left.take(length, n)
        fixed.append((pattern, n))

    changed = True
    while changed:
        changed, bound = False, capacity
        while (j := left.upto(bound)) is not None:
            n, room = left.counts[j], capacity - j
            left.take(j, n)  # what else is there besides the pieces of this length
            spare = _Lengths.__new__(_Lengths)
            spare.counts, spare.order = dict(left.counts) if 2 * j <= capacity and n > 1 else left.counts, left.order
            if 2 * j <= capacity and n > 1:
                spare.order = list(left.order)
                spare.counts[j] = n - 1
                bisect.insort(spare.order, j)
            i, two = spare.upto(room), spare.two_least()
            single = i is None
            pair = not single and (i == room or two is None or two > room or (spare.best_two(room) or 0) <= i)
            left.counts[j] = n
            bisect.insort(left.order, j)
            if single:
                fix((j,), n)
            elif pair:
                if i == j:
                    fix((j, j), max(1, n // 2) if i == room or n % 2 == 0 or n > 2 else 1)
                else:
                    exact = i == room or two is None or two > room
                    fix((j, i), min(n, left.counts[i]) if exact else 1)
            if single or pair:
                changed = True
            bound = j if j in left.counts and (single or pair) else j - 1
    return fixed, left.counts


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit, longest first; bins of equal room and contents move together."""
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    order: list[int] = []

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room not in rooms:
            rooms[room] = []
            bisect.insort(order, room)
        rooms[room].append((pattern, n))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            k = bisect.bisect_left(order, length)
            if k == len(order):
                each = capacity // length
                if n >= each:
                    put(capacity - each * length, (length,) * each, n // each)
                if n % each:
                    put(capacity - (n % each) * length, (length,) * (n % each), 1)
                break
            room = order[k]
            pattern, bins = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                order.pop(k)
            each = min(room // length, n)
            full = min(bins, n // each)
            if full < bins:
                put(room, pattern, bins - full)
            put(room - each * length, pattern + (length,) * each, full)
            n -= full * each
    return [p for own in rooms.values() for p in own]


@dataclass
class Plan:
    """By length: from which rank on, in which pattern, how many of it a bin holds, and where."""

    capacity: int
    bins: int
    fixed_bins: int
    starts: dict[int, np.ndarray]
    slots: dict[int, np.ndarray]  # rows of: first sequence id, pieces a bin, offset in the bin

    def place(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.starts[length], ranks, "right") - 1
        first, each, offset = self.slots[length][k].T
        at = ranks - self.starts[length][k]
        return first + at // each, offset + at % each * length


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    fixed, rest = reduce_dominated(counts, capacity)
    patterns: Counter = Counter()
    for pattern, n in [*fixed, *best_fit(rest, capacity)]:
        patterns[tuple(sorted(pattern, reverse=True))] += n
    used: Counter = Counter()
    starts: dict[int, list] = {}
    slots: dict[int, list] = {}
    first = 0
    for pattern, n in sorted(patterns.items()):
        offset = 0
        for length, each in sorted(Counter(pattern).items(), reverse=True):
            starts.setdefault(length, []).append(used[length])
            slots.setdefault(length, []).append((first, each, offset))
            used[length] += n * each
            offset += each * length
        first += n
    return Plan(capacity, first, sum(n for _, n in fixed), {k: np.array(v, np.int64) for k, v in starts.items()}, {k: np.array(v, np.int64) for k, v in slots.items()})


#: What a file must say for its ids to be those of its chunks (fixed values).
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLITTER = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Chunks that are one word of the splitter and that the normaliser leaves alone.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


class WordTokenizer:
    """A tokenizers file: ids of whole texts, from what was remembered of their blank-separated chunks.

    Where the file's normaliser turns white space into blanks and lower-cases, and its splitter drops blanks and
    parts letters from marks, the ids of a text are those of its chunks in order; A-Z may be lowered
    before, and a blank may go between a letter and a stop, so that fewer chunks differ. The file is read for that; with
    any other file, and for a text that holds one of the file's added tokens in any case, the whole text goes
    to the tokenizer as it is. Remembered ids lie in one flat array of bounded size.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        splits = (said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_chunk = said.get("normalizer") == _NORMALIZER and splits[0].get("pattern") == {"Regex": _SPLITTER} and splits[0].get("behavior") == "Removed" and not said.get("truncation")
        self.added = [t["content"].lower() for t in said.get("added_tokens", [])]
        suffix = said["model"].get("end_of_word_suffix")
        self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        if suffix:
            for piece, k in self.tokenizer.get_vocab().items():
                self.ends[k] = piece.endswith(suffix)
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {"": 0}
        self.size = 0
        self.sizes, self.starts, self.ids = Rows(np.int32), Rows(np.int64), Rows(np.uint32)
        self.sizes.add([0])
        self.starts.add([0])

    def _remember(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.memo.update(zip(chunks, range(self.sizes.n, self.sizes.n + len(chunks)), strict=True))
        self.starts.add(self.ids.n + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.ids.add(ids)
        self.size += sum(map(len, chunks)) + 4 * len(ids) + _ENTRY * len(chunks)

    def _learn(self, chunks: list[str]) -> None:
        """Plain words go to the tokenizer many at once: each ends with the one id that ends a word."""
        word = list(map(bool, map(_PLAIN.fullmatch, chunks)))
        words, rest = list(compress(chunks, word)), list(compress(chunks, map(not_, word)))
        for k in range(0, len(words), 2000):
            own = words[k : k + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(own)], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(own) and cuts[-1] == len(ids):
                self._remember(own, ids, np.diff(cuts, prepend=0))
            else:  # a vocabulary without such ids
                rest += own
        found = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._remember(rest, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes)

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, with the end token."""
        if not texts:
            return []
        low = [t.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass") for t in texts]
        whole = [not self.by_chunk or any(a in t for a in self.added) for t in low]
        own = [[] if w else _JOINT.sub(" ", t.replace("\n", " ")).split(" ") for t, w in zip(low, whole, strict=True)]
        flat = list(chain.from_iterable(own))
        if self.size > _MEMO_BYTES:
            self._forget()
        chunk = np.fromiter(map(self.memo.get, flat, repeat(-1)), np.int64, len(flat))
        new = np.flatnonzero(chunk < 0).tolist()
        if new:
            missing = [flat[k] for k in new]
            self._learn(list(dict.fromkeys(missing)))
            chunk[new] = list(map(self.memo.__getitem__, missing))
        n = self.sizes.all()[chunk].astype(np.int64)
        ends = np.cumsum(n)
        out = self.ids.all()[np.repeat(self.starts.all()[chunk] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        totals = np.concatenate([[0], ends])[np.cumsum([len(c) for c in own])]
        found = np.split(out, totals[:-1])
        for k in compress(range(len(texts)), whole):
            found[k] = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, np.uint32)
        return [np.append(x, np.uint32(END)) for x in found]

    def __call__(self, text: str) -> np.ndarray:
        return self.batch([text])[0]


_OPEN: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One for each worker process, with what it remembers, for all its tasks."""
    if path not in _OPEN:
        _OPEN[path] = WordTokenizer(path)
    return _OPEN[path]


def _spans(texts: pa.Array):
    """(first, count) of runs of rows with about ``_BATCH_CHARS`` bytes each."""
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _BATCH_CHARS, "right")))
        yield at, to - at
        at = to


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, payload: str = "ids") -> DataFrame:
    """One row per piece, written once: id, piece, start, length, payload, part, rank in the part by length.

    ``payload`` "ids" carries the token ids (little-endian unsigned 32-bit), "crc32" their checksum.
    """
    fields = [("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank", pa.int64())]
    schema = pa.schema(fields)

    def cut(batches):
        encode, met, part = _tokenizer(tokenizer_path), Counter(), TaskContext.get().partitionId()
        for b in batches:
            for at, n in _spans(b.column(1)):
                rows: list[tuple] = []
                own = b.slice(at, n)
                for key, ids in zip(own.column(0).to_pylist(), encode.batch([t or "" for t in own.column(1).to_pylist()]), strict=True):
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        raw = ids[start : start + capacity].astype("<u4").tobytes()
                        length = len(raw) // 4
                        rows.append((key, k, start, length, raw if payload == "ids" else None, zlib.crc32(raw), part, met[length]))
                        met[length] += 1
                yield pa.record_batch([pa.array(c, f[1]) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=schema)

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return settle(read.mapInArrow(cut, "id long, piece int, start long, length long, ids binary, ids_crc32 long, part int, rank long"))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, payload: str = "ids") -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: id, piece, start, length, ids, ids_crc32, sequence_id, offset."""
    cut = pieces(docs, tokenizer_path, id_col, text_col, capacity, payload)
    met = settle(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    planned = plan({r["length"]: r["n"] for r in met.groupBy("length").agg(F.sum("n").alias("n")).toLocalIterator()}, capacity)
    shared = docs.sparkSession.sparkContext.broadcast(planned)
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    # A row for each part, however many lengths it has; the row's arrays never leave the join's projection.
    by_length = met.select("part", F.struct("length", F.coalesce(before, F.lit(0)).alias("shift")).alias("s")).groupBy("part").agg(F.array_sort(F.collect_list("s")).alias("s"))
    shifts = settle(by_length.select("part", F.col("s.length").alias("lengths"), F.col("s.shift").alias("shifts")))
    shift = F.get("shifts", (F.array_position("lengths", F.col("length")) - 1).cast("int"))
    ranked = cut.join(shifts, "part").select("id", "piece", "start", "length", "ids", "ids_crc32", (F.col("rank") + shift).alias("rank"))

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                sequence[own], offset[own] = shared.value.place(int(length[own[0]]), rank[own])
            columns = [b.column(c) for c in ("id", "piece", "start", "length", "ids", "ids_crc32")]
            yield pa.record_batch([*columns, pa.array(sequence), pa.array(offset)], names=["id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset"])

    out = ranked.mapInArrow(place, "id long, piece int, start long, length long, ids binary, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
