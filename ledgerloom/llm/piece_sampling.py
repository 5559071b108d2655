"""Sampled segmentation into pieces: forward filtering, backward sampling over the piece lattice.

A model file gives pieces and scores; a piece weighs ``-ALPHA * log(1 + |score|)`` (in a file made by
merges the score is a rank, so that is a Zipf law). No piece reaches over the start of a run of blanks
or past a line break, so the lattice of a text falls apart into chunks, and equal chunks have equal
lattices: each distinct chunk is filtered forward once a worker (all new chunks of a slice at once, in
numpy), and every occurrence is sampled backward with random numbers that are hashes of seed, row
key, place in the text and step. The same row gives the same pieces whatever the partitions.

A character without a piece of its own becomes its UTF-8 bytes' pieces; so does a literal U+2581, which
otherwise stands for the blank. Decoding therefore gives back the exact text. Defined cases: null
encodes to null; the empty text to no piece; rows that repeat an id and text encode equally; a null id
counts as -1; long texts are cut into slices at chunk borders; an empty table gives an empty result; other
columns pass through, but a column named like a new one gives way to it. Between two pieces of equal
weight the draw decides like between any others.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.words import Rows, mix

ALPHA = 1.0
BYTE_WEIGHT = -12.0
_CHUNK = re.compile(r" +[^ \n]*|\n|[^ \n]+")
#: The same, with a border between a small letter and what follows it of these marks, for models without a piece that holds both.
_SPLIT = re.compile(r" +[^ \n.,;:!?]*(?:(?<![a-z])[.,;:!?][^ \n.,;:!?]*)*|\n|[^ \n]+")
#: Bytes that a worker process remembers at most, chunks counted with ``_ENTRY`` bytes each.
_MEMO_BYTES = 192 << 20
_ENTRY = 150
_LEARN = 20_000
_MAYBE = 1 << 20
_SLICE = 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Sampler:
    """Encodes and decodes with one model file."""

    def __init__(self, path: str, seed: int = 0, alpha: float = ALPHA):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.seed, self.byte_id = mix(np.array([seed], np.uint64)), np.full(256, -1, np.int64)
        raw: list[bytes] = [b""] * n
        own: list[tuple[str, int, float]] = []
        for k in range(n):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte_id[int(piece[1:-1], 16)] = k
                raw[k] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
                text = piece.replace("▁", " ")
                if re.search(r"[^ ] |\n", text):
                    raise ValueError(f"piece {k} reaches over a chunk border")
                raw[k] = text.encode()
                own.append((text, k, -alpha * float(np.log1p(abs(model.get_score(k))))))
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces")
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.array([len(r) for r in raw])
        self.raw_at = np.concatenate([[0], np.cumsum(self.raw_len)[:-1]])
        self.chunk = _CHUNK if any(re.search("[a-z][.,;:!?]", t) for t, _, _ in own) else _SPLIT
        self.longest = max((len(t) for t, _, _ in own), default=1)
        keys = np.array([self._key(np.frombuffer(t.encode("utf-32-le"), np.uint32)) for t, _, _ in own], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([i for _, i, _ in own])[order]
        self.weights = np.array([w for _, _, w in own])[order]
        self.maybe = np.zeros(_MAYBE, bool)  # most strings that are no piece end here
        self.maybe[(self.keys & np.uint64(_MAYBE - 1)).astype(np.int64)] = True
        self._reset()

    def _key(self, points: np.ndarray) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for p in points:
            h = h * _MIX + mix(np.array([p], np.uint64))
        return mix(h + np.uint64(len(points)))[0]

    def _reset(self) -> None:
        self.memo: dict[str, int] = {}
        self.length = Rows(np.int32)  # of each chunk
        self.base = Rows(np.int32)  # its state at 0; position e is base + e
        self.first = Rows(np.int32)  # of each state, its first edge
        self.edges = Rows(np.float32), Rows(np.int16), Rows(np.int32)  # cumulative share, characters, piece or -1 - code point

    def _held(self) -> int:
        """Bytes of what is remembered, the chunks' dictionary entries included."""
        return 10 * self.edges[0].n + 4 * self.first.n + _ENTRY * len(self.memo)

    def _learn(self, chunks: list[str]) -> None:
        """Forward filtering of new chunks, all at once."""
        lens = np.array([len(c) for c in chunks])
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.concatenate([[0], np.cumsum(lens)[:-1]])
        end_of, chunk_of = np.repeat(at + lens, lens), np.repeat(np.arange(len(chunks)), lens)
        mixed = mix(points.astype(np.uint64))
        h = np.zeros(len(points), np.uint64)
        tails, heads, pieces, weights = [], [], [], []
        alive = np.arange(len(points))
        single = np.zeros(len(points), bool)
        for n in range(1, self.longest + 1):
            alive = alive[alive + n <= end_of[alive]]
            if not len(alive):
                break
            h[alive] = h[alive] * _MIX + mixed[alive + n - 1]
            keys = mix(h[alive] + np.uint64(n))
            some = np.flatnonzero(self.maybe[(keys & np.uint64(_MAYBE - 1)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.keys, keys[some]), len(self.keys) - 1)
            hit = self.keys[k] == keys[some]
            own, k = alive[some[hit]], k[hit]
            tails.append(own)
            heads.append(own + n)
            pieces.append(self.ids[k])
            weights.append(self.weights[k])
            if n == 1:
                single[own] = True
        bare = np.flatnonzero(~single)
        p = points[bare].astype(np.int64)
        tails.append(bare)
        heads.append(bare + 1)
        pieces.append(-1 - p)
        weights.append(BYTE_WEIGHT * (1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF)))
        tail, head, piece, weight = (np.concatenate(x) for x in (tails, heads, pieces, weights))
        # A chunk of n characters has states 0..n; all edges are laid out by position, then by the state they lead to.
        chunk = chunk_of[tail]
        position, to = head - at[chunk], head + chunk
        order = np.argsort(position * (len(points) + len(chunks) + 1) + to, kind="stable")
        tail, head, piece, weight, chunk, position, to = (x[order] for x in (tail, head, piece, weight, chunk, position, to))
        came = tail + chunk
        forward = np.full(len(points) + len(chunks), -np.inf)
        forward[at + np.arange(len(chunks))] = 0.0
        starts_of = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        size_of = np.diff(np.append(starts_of, len(to)))
        share = np.zeros(len(tail))
        cuts = np.append(np.searchsorted(position, np.arange(1, int(position[-1]) + 1)), len(position))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            z = forward[came[lo:hi]] + weight[lo:hi]
            k0, k1 = np.searchsorted(starts_of, [lo, hi])
            starts, sizes = starts_of[k0:k1] - lo, size_of[k0:k1]
            top = np.maximum.reduceat(z, starts)
            e = np.exp(z - np.repeat(top, sizes))
            total = np.add.reduceat(e, starts)
            forward[to[lo + starts]] = top + np.log(total)
            running = np.cumsum(e)
            running -= np.repeat(running[starts] - e[starts], sizes)
            share[lo:hi] = running / np.repeat(total, sizes)
        last = np.append(to[1:] != to[:-1], True)
        share[last] = 2.0  # rounding never runs past a state's last edge
        first = np.zeros(len(points) + len(chunks), np.int64)
        first[to[starts_of]] = starts_of + self.edges[0].n
        self.base.add(at + np.arange(len(chunks)) + self.first.n)
        self.first.add(first)
        for rows, values in zip(self.edges, (share, head - tail, piece), strict=True):
            rows.add(values)
        self.length.add(lens)
        known = len(self.memo)
        self.memo.update(zip(chunks, range(known, known + len(chunks)), strict=True))

    def _chunks(self, text: str):
        """(chunks, characters) of slices at borders; a blank goes before the text."""
        text, at = " " + text, 0
        border = lambda p: text[p] == "\n" or text[p - 1] == "\n" or (text[p] == " " and text[p - 1] != " ")
        while at < len(text):
            to = min(at + _SLICE, len(text))
            if to < len(text):
                while to > at and not border(to):
                    to -= 1
                if to == at:  # one chunk longer than a slice: up to its end
                    to += _SLICE
                    while to < len(text) and not border(to):
                        to += 1
            yield self.chunk.findall(text[at:to]), to - at
            at = to

    def encode(self, texts: list[str | None], keys: np.ndarray) -> list[np.ndarray | None]:
        """Piece ids of each text; ``keys`` seed them."""
        out: list[list[np.ndarray] | None] = [None if t is None else [] for t in texts]
        held: list[tuple[int, int, list[str]]] = []
        size = 0

        def flush():
            if self._held() > _MEMO_BYTES:
                self._reset()
            flat = list(chain.from_iterable(own for _, _, own in held))
            chunk = np.fromiter(map(self.memo.get, flat, repeat(-1)), np.int64, len(flat))
            new = np.flatnonzero(chunk < 0).tolist()
            if new:
                missing = [flat[k] for k in new]
                fresh = list(dict.fromkeys(missing))
                for k in range(0, len(fresh), _LEARN):
                    self._learn(fresh[k : k + _LEARN])
                chunk[new] = list(map(self.memo.__getitem__, missing))
            n = np.array([len(own) for _, _, own in held])
            place = np.concatenate([np.arange(a, a + k) for (_, a, _), k in zip(held, n, strict=True)]).astype(np.uint64)
            key = np.repeat(mix(np.array([keys[i] for i, _, _ in held], np.int64).view(np.uint64) + self.seed), n)
            ids, counts = self._sample(chunk, mix(key + place))
            totals = np.add.reduceat(counts, np.cumsum(n) - n)
            for (i, _, _), part in zip(held, np.split(ids, np.cumsum(totals)[:-1]), strict=True):
                out[i].append(part)
            held.clear()

        for i, text in enumerate(texts):
            if text:
                done = 0
                for own, length in self._chunks(text):
                    held.append((i, done, own))
                    done += len(own)
                    size += length
                    if size > _SLICE:
                        flush()
                        size = 0
        if held:
            flush()
        return [None if o is None else np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]

    def _sample(self, chunk: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling of every occurrence at once: ids, and number of ids of each occurrence."""
        share, width, piece = (e.all() for e in self.edges)
        first, who, left = self.first.all(), np.arange(len(chunk)), self.length.all()[chunk]
        base, steps = self.base.all()[chunk], np.zeros(len(chunk), np.int64)
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        while len(who):
            u = (mix(salt[who] + np.uint64(len(taken) + 1)) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
            k = first[base[who] + left]
            late = np.flatnonzero(share[k] <= u)
            while len(late):
                k[late] += 1
                late = late[share[k[late]] <= u[late]]
            taken.append((who, piece[k].astype(np.int64)))
            steps[who] += 1
            left = left - width[k]
            more = left > 0
            who, left = who[more], left[more]
        start = np.cumsum(steps) - steps
        flat = np.zeros(int(steps.sum()), np.int64)
        for step, (own, got) in enumerate(taken):
            flat[start[own] + steps[own] - 1 - step] = got
        bare = np.flatnonzero(flat < 0)
        if not len(bare):
            return flat, steps
        owner = np.repeat(np.arange(len(chunk)), steps)
        spelled = [self.byte_id[np.frombuffer(chr(-1 - c).encode("utf-8", "surrogatepass"), np.uint8)] for c in flat[bare].tolist()]
        sizes = np.ones(len(flat), np.int64)
        sizes[bare] = [len(s) for s in spelled]
        wide = np.repeat(flat, sizes)
        at = np.cumsum(sizes) - sizes
        for k, s in zip(at[bare].tolist(), spelled, strict=True):
            wide[k : k + len(s)] = s
        return wide, np.bincount(owner, sizes, len(chunk)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The exact text that was encoded."""
        ids = np.asarray(ids)
        if not len(ids):
            return ""
        sizes = self.raw_len[ids]
        at = np.repeat(self.raw_at[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return self.raw[at].tobytes().decode("utf-8", "surrogatepass")[1:]


_OPEN: dict[tuple[str, int], Sampler] = {}


def _sampler(path: str, seed: int) -> Sampler:
    """One for each worker process, with what it has learned."""
    if (path, seed) not in _OPEN:
        _OPEN[path, seed] = Sampler(path, seed)
    return _OPEN[path, seed]


def _added(docs: DataFrame, more: dict[str, T.DataType], values, n_rows: int = 256) -> DataFrame:
    """``docs`` with the columns ``more``, made from small runs of rows, so that a worker holds little at once.

    A column of ``docs`` with the name of a new one gives way to it.
    """
    taken = {c.lower() for c in more}
    names = [c for c in docs.columns if c.lower() not in taken]
    # Plain names on the way: a name with a dot in it does not get into mapInArrow.
    kept = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    schema = T.StructType([*kept.schema, *[T.StructField(f"n{k}", kind) for k, kind in enumerate(more.values())]])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, n_rows):
                part = pa.record_batch(b.slice(at, n_rows).columns, names=names)
                yield pa.record_batch([*part.columns, *values(part)], names=schema.names)

    return kept.mapInArrow(run, schema).toDF(*names, *more)


def _ids(path: str, seed: int, id_col: str, text_col: str, part: pa.RecordBatch) -> list[np.ndarray | None]:
    keys = part.column(id_col).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
    return _sampler(path, seed).encode(part.column(text_col).to_pylist(), keys)


def _listed(rows: list[np.ndarray | None]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([0 if r is None else len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate([r for r in rows if r is not None] or [np.zeros(0)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array([r is None for r in rows], pa.bool_()))


def encode(docs: DataFrame, model_path: str, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", out: str = "pieces") -> DataFrame:
    """Adds the array column ``out`` of sampled piece ids."""
    return _added(docs, {out: T.ArrayType(T.IntegerType())}, lambda part: [_listed(_ids(model_path, seed, id_col, text_col, part))])


def decode(docs: DataFrame, model_path: str, pieces_col: str = "pieces", out: str = "decoded") -> DataFrame:
    """Adds the text column ``out`` of piece ids."""

    def spelled(part: pa.RecordBatch) -> list[pa.Array]:
        sampler = _sampler(model_path, 0)
        return [pa.array([None if not p.is_valid else sampler.decode(p.values.to_numpy()) for p in part.column(pieces_col)], pa.string())]

    return _added(docs, {out: T.StringType()}, spelled)


def round_trip(docs: DataFrame, model_path: str, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", pieces: str = "pieces", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows, so a task has one worker and one model."""

    def both(part: pa.RecordBatch) -> list[pa.Array]:
        rows, sampler = _ids(model_path, seed, id_col, text_col, part), _sampler(model_path, seed)
        return [_listed(rows), pa.array([None if r is None else sampler.decode(r) for r in rows], pa.string())]

    return _added(docs, {pieces: T.ArrayType(T.IntegerType()), decoded: T.StringType()}, both)
