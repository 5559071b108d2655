"""Language identification by interpolated Kneser-Ney character models, one per language.

Text is lower-cased; letters are symbols, every run of other characters is one gap. A language's model
holds, per order, the discounted probabilities of its grams and the back-off weights of its contexts in
arrays sorted by hash. A text goes to the language of the lowest cross-entropy per symbol; it is
rejected when that cross-entropy lies nearer to that of random letters than to the greatest one of the
calibration texts, with an allowance for short texts that shrinks with the square root of the length.

Training uses a bounded sample of every label: at most ``MAX_DOCS_PER_LANG`` documents a language, the first by a
hash of the id, none over ``MAX_TRAIN_CHARS`` characters, and ``MAX_SAMPLE_CHARS`` characters shared evenly among the
languages; every fifth document calibrates the rejection. Every letter of the sample has a symbol of its own
(up to 65,533 of them, the most frequent ones). Prediction covers every whole text.

The score is the softmax of the languages' log-probabilities as if the text had ``SCORE_SYMBOLS`` symbols at
most, so that long texts do not all score 1.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; so is every
text where nothing is labelled, and in an empty table there is nothing to judge. Ties go to the language first by name.
Rows that repeat an id repeat their result; rows without id or label are not learned from. Very long texts are
scored in slices whose sums are those of the whole. Other columns pass through; one named like ``out`` gives way to it.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from ledgerloom.llm.words import mix
from ledgerloom.plans.scratch import settle

ORDER = 4
MAX_DOCS_PER_LANG = 400
MAX_TRAIN_CHARS = 200_000
MAX_SAMPLE_CHARS = 64_000_000
SCORE_SYMBOLS = 100
SHORT_ALLOWANCE = 3.0
_SLICE = 1 << 20
_CACHE = 1 << 20
_BITS = 16  # of a symbol; a gram of ORDER symbols is one 64-bit number
_UNKNOWN = (1 << _BITS) - 1
RESULT = "lang_pred string, score double, cross_entropy double, rejected boolean"


def _letter_table() -> np.ndarray:
    """1 for every code point that is a letter."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            table[c] = 1
    return table


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class _Lm:
    """One language: per order the sorted hashes of grams and contexts with their values."""

    grams: list = field(default_factory=list)
    contexts: list = field(default_factory=list)

    def prob(self, packed: np.ndarray, n_symbols: int) -> np.ndarray:
        p = np.full(len(packed), 1.0 / n_symbols)
        for k in range(1, ORDER + 1):
            gram = packed & np.uint64((1 << (_BITS * k)) - 1)
            back = _lookup(self.contexts[k - 1], mix(gram >> np.uint64(_BITS)), 1.0)
            p = _lookup(self.grams[k - 1], mix(gram), 0.0) + back * p
        return p


def _lookup(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
    hashes, values = table
    if not len(hashes):
        return np.full(len(keys), missing)
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return np.where(hashes[at] == keys, values[at], missing)


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = mix(keys)
    order = np.argsort(hashes)
    return hashes[order], values[order]


def _pack(codes: np.ndarray) -> np.ndarray:
    """The gram that ends at each symbol; the newest symbol takes the lowest bits."""
    out = codes.astype(np.uint64)
    for k in range(1, ORDER):
        out[k:] |= codes[:-k].astype(np.uint64) << np.uint64(_BITS * k)
    return out


def _fit_lm(texts: list[np.ndarray]) -> _Lm:
    full, counts = np.unique(np.concatenate([_pack(c)[ORDER - 1 :] for c in texts if len(c) >= ORDER] or [np.zeros(0, np.uint64)]), return_counts=True)
    levels = [(full, counts)]
    for k in range(ORDER - 1, 0, -1):  # continuation counts: in how many contexts a shorter gram was met
        levels.insert(0, np.unique(levels[0][0] & np.uint64((1 << (_BITS * k)) - 1), return_counts=True))
    lm = _Lm()
    for grams, counts in levels:
        ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
        discount = ones / (ones + 2 * twos) if ones + twos else 0.5
        contexts, inverse = np.unique(grams >> np.uint64(_BITS), return_inverse=True)
        total = np.bincount(inverse, counts, len(contexts)) if len(grams) else np.zeros(0)
        kinds = np.bincount(inverse, minlength=len(contexts)) if len(grams) else np.zeros(0)
        lm.grams.append(_sorted(grams, (counts - discount) / total[inverse] if len(grams) else np.zeros(0)))
        lm.contexts.append(_sorted(contexts, discount * kinds / total if len(grams) else np.zeros(0)))
    return lm


@dataclass
class Model:
    langs: list[str]
    symbols: np.ndarray  # code points that have a symbol of their own
    lms: list[_Lm]
    limit: float = np.inf
    _table: np.ndarray | None = None
    _cache: tuple | None = None

    def __getstate__(self):
        return self.__dict__ | {"_table": None, "_cache": None}

    @property
    def n_symbols(self) -> int:
        return len(self.symbols) + 2

    def codes(self, points: np.ndarray, before: int = _UNKNOWN) -> np.ndarray:
        """0: gap, ``_UNKNOWN``: a letter not met in training; runs of gaps are one, also with a gap ``before``."""
        if self._table is None:
            table = _letter_table().astype(np.uint16) * np.uint16(_UNKNOWN)
            table[self.symbols] = np.arange(1, len(self.symbols) + 1)
            self._table = table
        c = self._table[points]
        keep = c != 0
        keep[1:] |= c[:-1] != 0
        keep[:1] |= before != 0
        return c[keep]

    def _log_probs(self, grams: np.ndarray) -> np.ndarray:
        """Of sorted distinct grams, -log P by language; a cache keeps those already met."""
        if self._cache is None or len(self._cache[0]) > _CACHE:
            self._cache = np.zeros(0, np.uint64), np.zeros((0, len(self.langs)))
        keys, values = self._cache
        at = np.searchsorted(keys, grams)
        known = keys[np.minimum(at, len(keys) - 1)] == grams if len(keys) else np.zeros(len(grams), bool)
        if not known.all():
            new = grams[~known]
            fresh = -np.log(np.stack([np.maximum(lm.prob(new, self.n_symbols), 1e-12) for lm in self.lms], 1))
            keys, values = np.concatenate([keys, new]), np.concatenate([values, fresh])
            order = np.argsort(keys)
            self._cache = keys, values = keys[order], values[order]
            at = np.searchsorted(keys, grams)
        return values[at]

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropies (text x language), symbols scored, and whether there is a letter."""
        bits = np.zeros((len(texts), len(self.langs)))
        n, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush():
            grams, inverse = np.unique(np.concatenate([g for _, g in held]), return_inverse=True)
            own = self._log_probs(grams)[inverse]
            lens = np.array([len(g) for _, g in held])
            rows = np.array([i for i, _ in held])[lens > 0]
            starts = (np.cumsum(lens) - lens)[lens > 0]
            if len(rows):
                np.add.at(bits, rows, np.add.reduceat(own, starts))
                np.add.at(n, rows, lens[lens > 0])

        for i, text in enumerate(texts):
            low = (text or "").lower()
            context = np.zeros(ORDER - 1, np.uint16)
            for at in range(0, len(low), _SLICE):
                codes = self.codes(_points(low[at : at + _SLICE]), int(context[-1]) if at else _UNKNOWN)
                letters[i] |= bool((codes != 0).any())
                end = np.zeros(int(at + _SLICE >= len(low)), np.uint16)
                context = np.concatenate([context, codes, end])
                held.append((i, _pack(context)[ORDER - 1 :]))
                size += len(held[-1][1])
                context = context[-(ORDER - 1) :]
                if size >= _SLICE:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        return bits / np.maximum(n, 1)[:, None], n, letters

    def judge(self, texts: list[str | None]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        if not self.langs:
            k = len(texts)
            return ["und"] * k, np.zeros(k), np.zeros(k), np.ones(k, bool)
        entropy, n, letters = self.entropies(texts)
        first = entropy.argmin(1) if len(texts) else np.zeros(0, int)
        best = entropy.min(1) if len(texts) else np.zeros(0)
        gaps = (entropy - best[:, None]) * np.minimum(n, SCORE_SYMBOLS)[:, None]
        score = np.where(letters, 1 / np.exp(-gaps).sum(1), 0.0)
        rejected = ~letters | (best > self.limit + SHORT_ALLOWANCE / np.sqrt(np.maximum(n, 1)))
        return [self.langs[k] if ok else "und" for k, ok in zip(first.tolist(), letters.tolist(), strict=True)], score, best, rejected


def fit(labelled: dict[str, list[str]], calibrate: dict[str, list[str]] | None = None) -> Model:
    """Models from texts by language; ``calibrate`` sets the rejection."""
    labelled = {k: v for k, v in sorted(labelled.items()) if v}
    letters = _letter_table()
    met = np.zeros(len(letters), np.int64)
    for t in (t for v in labelled.values() for t in v):
        points, counts = np.unique(_points(t.lower()), return_counts=True)
        met[points] += counts
    points = np.flatnonzero((met > 0) & (letters == 1))
    symbols = points[np.argsort(-met[points], kind="stable")[: _UNKNOWN - 2]]
    model = Model(list(labelled), symbols, [])
    pad = lambda c: np.concatenate([np.zeros(ORDER - 1, np.uint16), c, np.zeros(1, np.uint16)])
    model.lms = [_fit_lm([pad(model.codes(_points(t.lower()))) for t in v]) for v in labelled.values()]
    held = [t for v in (calibrate or {}).values() for t in v] or [t for v in labelled.values() for t in v]
    if held and model.langs:
        rng = np.random.default_rng(5)
        noise = ["".join(map(chr, rng.choice(symbols, 500))) for _ in range(8)] if len(symbols) else []
        far = model.entropies(noise)[0].min(1).mean() if noise else 0.0
        entropy, n, _ = model.entropies(held)
        seen = entropy.min(1)[n >= 100]
        near = float(seen.max()) if len(seen) else 0.0
        model.limit = max(near, (near + far) / 2)
    return model


def train(docs: DataFrame, label: Column, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS_PER_LANG) -> Model:
    """Fit on the bounded sample of rows whose ``label`` is not null."""
    spark = docs.sparkSession
    spread = F.pmod(F.xxhash64(id_col), F.lit(1 << 40))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), label.cast("string").alias("lang"), spread.alias("h")).where("lang is not null and id is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().toLocalIterator()}
    if not counts:
        return fit({})
    # A language of the model is a row here; the model itself holds far more than that of each.
    limits = F.broadcast(spark.createDataFrame([(k, int(min(1.0, 4 * max_docs / n) * (1 << 40))) for k, n in sorted(counts.items())], "lang string, least long"))
    usable = F.col("text").isNotNull() & (F.length("text") <= MAX_TRAIN_CHARS)
    sizes = rows.join(limits, "lang").where((F.col("h") < F.col("least")) & usable).select("lang", "h", "id", F.length("text").alias("chars"))
    by = W.partitionBy("lang").orderBy("h", "id")
    before = F.coalesce(F.sum("chars").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    chosen = sizes.select("lang", "h", "id", F.row_number().over(by).alias("k"), before.alias("before")).where((F.col("k") <= max_docs) & (F.col("before") < MAX_SAMPLE_CHARS // len(counts)))
    keys = F.broadcast(settle(chosen.select("lang", "id").distinct()))
    found = rows.where(usable).join(keys, ["lang", "id"], "left_semi").select("lang", "h", "id", "text")
    sample = sorted(((r["lang"], r["h"], r["id"], r["text"]) for r in found.toLocalIterator()))
    fit_on: dict[str, list[str]] = {}
    held: dict[str, list[str]] = {}
    for lang, own in groupby(sample, lambda r: r[0]):
        for k, row in enumerate(islice(own, max_docs)):
            (held if k % 5 == 4 else fit_on).setdefault(lang, []).append(row[3])
    return fit(fit_on, held)


def identify(docs: DataFrame, model: Model, text_col: str = "text", out: str = "language") -> DataFrame:
    """Adds a struct column (``RESULT``) named ``out``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf(RESULT)
    def judged(texts: pa.Array) -> pa.Array:
        lang, score, entropy, rejected = shared.value.judge(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)], names=["lang_pred", "score", "cross_entropy", "rejected"])

    return docs.withColumn(out, judged(text_col))


def learns(id_col: str = "doc_id") -> Column:
    """Rows that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0
