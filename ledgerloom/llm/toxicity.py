"""Toxicity by a classifier chain: a linear model per category, each fed the probabilities of those before.

Labels say ``toxic`` only; the kinds of toxicity before it in the chain come from the labelled data: toxic documents are
clustered by the words that mark toxicity (spherical k-means, ``KINDS`` clusters), and a category ``kind1``,
``kind2``.. holds for the toxic documents of its cluster, the largest first. The labelled category is the last of the
chain. While training, a later model sees out-of-fold probabilities of the earlier categories, so what it
learns to trust is what it gets when scoring new text. Features are the presence of words (A-Z lower-cased,
without the marks around them) that divide the labels best.

Fitting uses a bounded sample of labelled documents: at most ``MAX_TOXIC`` and ``MAX_CLEAN``, the
first by a hash of the id; every whole text is scored.

Defined cases: a null text, or one without a word, has probability 0; one without any feature has the models'
intercepts. Without labels of both classes nothing is learned and every probability is 0. Documents labelled both
ways count as toxic; rows with a null id are scored, not learned from; of rows that repeat an id one is learned
from, and all get their result. Equally good words go by their hash. An empty table gives an empty result. Only
the id and the text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import MARKS, text_bytes, word_hashes
from ledgerloom.plans.scratch import settle

KINDS = 2
MAX_TOXIC = 2500
MAX_CLEAN = 5000
MAX_FEATURES = 400
MIN_DOCS = 4
FOLDS = 4
THRESHOLD = 0.5
_SLICE = 4 << 20


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 120, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression, classes weighted evenly; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, m1, m2 = (np.zeros(x.shape[1], np.float32) for _ in range(3))
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())).astype(np.float32)
    for k in range(1, steps + 1):
        g = x.T @ (share * (_sigmoid(x @ w) - y)) + decay * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        w = w - 0.15 * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.99**k)) + 1e-7)
    return w.astype(np.float64)


@dataclass
class Chain:
    categories: list[str]
    words: np.ndarray  # sorted hashes of the features
    weights: list[np.ndarray]  # of each category: features, earlier categories, intercept

    def probabilities(self, rows: np.ndarray, features: np.ndarray, worded: np.ndarray) -> np.ndarray:
        """From distinct (row, feature) entries, and which rows hold a word; a column per category."""
        out = np.zeros((len(worded), len(self.categories)))
        k = len(self.words)
        for j, w in enumerate(self.weights):
            z = np.bincount(rows, w[features], len(worded)) + out[:, :j] @ w[k : k + j] + w[-1]
            out[:, j] = np.where(worded, _sigmoid(z), 0.0)
        return out


def clusters(x: np.ndarray, k: int, rounds: int = 30) -> np.ndarray:
    """Spherical k-means of the rows of ``x``, the largest cluster first; centres begin as far apart as rows can be."""
    if not len(x):
        return np.zeros(0, np.int64)
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    centres = unit[[int(np.linalg.norm(x, axis=1).argmax())]]
    while len(centres) < k:
        centres = np.vstack([centres, unit[int((unit @ centres.T).max(1).argmin())]])
    own = np.full(len(x), -1)
    for _ in range(rounds):
        now = (unit @ centres.T).argmax(1)
        if (now == own).all():
            break
        own = now
        sums = np.stack([unit[own == j].sum(0) for j in range(k)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    rank = np.argsort(np.argsort(-np.bincount(own, minlength=k), kind="stable"))
    return rank[own]


def fit_chain(categories: list[str], words: np.ndarray, x: np.ndarray, y: np.ndarray, folds: int = FOLDS) -> Chain:
    """``x``: documents by features; ``y``: documents by categories, in the chain's order."""
    own = np.arange(len(x)) % folds
    seen, weights = np.zeros((len(x), 0), np.float32), []
    for j in range(len(categories)):
        full = np.hstack([x, seen]).astype(np.float32)
        weights.append(fit_linear(full, y[:, j]))
        out_of_fold = np.zeros((len(x), 1), np.float32)
        for f in range(folds):
            rest = own != f
            if rest.any() and not rest.all():
                w = fit_linear(full[rest], y[rest, j])
                out_of_fold[~rest, 0] = _sigmoid(full[~rest] @ w[:-1] + w[-1])
        seen = np.hstack([seen, out_of_fold])
    return Chain(categories, words, weights)


def _entries(batch, column: int):
    """First row, number of rows, and row and hash of every word, in slices of whole rows."""
    data, offsets = text_bytes(batch.column(column))
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE, "right")) - 1)
        hashes, rows = word_hashes(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], gaps=MARKS)
        yield at, to - at, hashes, rows
        at = to


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: int = KINDS) -> Chain | None:
    """Fit on a bounded sample of the labelled documents."""
    spark = docs.sparkSession
    spread = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    known = settle(labels.where(f"{id_col} is not null and toxic is not null").groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic")).withColumn("h", spread))
    size = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked: dict[int, int] = {}
    for value, most in ((1, MAX_TOXIC), (0, MAX_CLEAN)):
        own = known.where((F.col("toxic") == value) & (F.col("h") < int(min(1.0, 4 * most / max(1, size.get(value, 0))) * (1 << 40))))
        picked |= {r["id"]: value for r in own.orderBy("h", "id").limit(most).collect()}
    if len(set(picked.values())) < 2:
        return None
    wanted = spark.sparkContext.broadcast(np.array(sorted(picked)))

    def read(batches):
        for b in batches:
            ids = b.column(0).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(wanted.value, ids), len(wanted.value) - 1)
            b = b.filter(pa.array(wanted.value[at] == ids))
            for first, n, hashes, rows in _entries(b, 1):
                cut = np.searchsorted(rows, np.arange(n + 1))
                sets = [np.unique(hashes[i:j]).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.record_batch([b.column(0).cast(pa.int64()).slice(first, n), pa.array(sets, pa.binary())], names=["id", "words"])

    sample = settle(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(read, "id long, words binary"))
    rows = [(picked[r["id"]], np.frombuffer(r["words"], np.uint64)) for r in sample.dropDuplicates(["id"]).orderBy("id").toLocalIterator()]
    toxic = np.array([t for t, _ in rows], np.float32)
    if len(set(toxic.tolist())) < 2:
        return None
    words, inverse = np.unique(np.concatenate([w for _, w in rows]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(w) for _, w in rows])
    met_bad, met = np.bincount(inverse, toxic[owner], len(words)), np.bincount(inverse, minlength=len(words))
    rate_bad, rate_good = (met_bad + 0.5) / (toxic.sum() + 1), (met - met_bad + 0.5) / (len(rows) - toxic.sum() + 1)
    gain = np.where(met >= MIN_DOCS, np.abs(np.log(rate_bad / rate_good)) * np.sqrt(met), 0)
    best = np.sort(np.argsort(-gain, kind="stable")[:MAX_FEATURES])
    best = best[gain[best] > 0]
    place = np.full(len(words), -1)
    place[best] = np.arange(len(best))
    hit = place[inverse] >= 0
    x = np.zeros((len(rows), len(best)), np.float32)
    x[owner[hit], place[inverse[hit]]] = 1
    marks = rate_bad[best] > rate_good[best]
    kind = np.full(len(rows), -1)
    kind[toxic > 0] = clusters(x[toxic > 0][:, marks], kinds)
    y = np.stack([*[(kind == j).astype(np.float32) for j in range(kinds)], toxic], 1)
    return fit_chain([*categories(kinds)], words[best], x, y)


def categories(kinds: int = KINDS) -> list[str]:
    """Names of the categories in the chain's order."""
    return [*[f"kind{j + 1}" for j in range(kinds)], "toxic"]


def classify(docs: DataFrame, chain: Chain | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, ``p_<category>`` in the chain's order, ``p_toxic``, ``toxic``."""
    names = chain.categories if chain else categories()
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        for b in batches:
            for first, n, hashes, rows in _entries(b, 1):
                p = np.zeros((n, len(names)))
                if shared.value is not None:
                    words = shared.value.words
                    at = np.minimum(np.searchsorted(words, hashes), max(0, len(words) - 1))
                    hit = words[at] == hashes if len(words) else np.zeros(len(hashes), bool)
                    pairs = np.unique(rows[hit] * max(1, len(words)) + at[hit])
                    p = shared.value.probabilities(pairs // max(1, len(words)), pairs % max(1, len(words)), np.bincount(rows, minlength=n) > 0)
                yield pa.record_batch([b.column(0).slice(first, n), *[pa.array(p[:, j]) for j in range(len(names))]], names=["id", *names])

    kind = dict(docs.dtypes)[id_col]
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, " + ", ".join(f"{c} double" for c in names))
    return out.select(F.col("id").alias(id_col), *[F.col(c).alias(f"p_{c}") for c in names], (F.col("toxic") >= threshold).alias("toxic"))
