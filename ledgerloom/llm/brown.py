"""Brown class-based bigrams: exchange clustering gives words classes; texts get smoothed log-probabilities.

Exact counts of every word (by 64-bit hash, spelling-free) come from all training documents. Clustering
takes three steps. The ``SEEDS`` most frequent words, and ``TAILS`` groups of all others by their last two bytes, go
through exchange on the driver: each in turn moves to the class that raises the likelihood of the class bigrams
most, until none moves. Then every one of the ``SHARED`` most frequent words is placed by itself: one pass counts,
for each word, the classes before and after it, and executors move it to the class of the greatest likelihood, all words
of a round against the same table. Rounds go on while the corpus' likelihood under the classes rises, ``ROUNDS`` at most. Words
beyond ``SHARED``, and words that training has not met, have the class of their group. The end token is a class of its own.
A text's probability is the product over its tokens of P(class | class before), interpolated with
P(class), times P(word | class) with additive smoothing that leaves room for one unseen word a class.

Scoring joins no token with the vocabulary as a whole: the counts and classes of the ``SHARED`` words are broadcast,
and only the rest of a document's words, one row for each distinct one, meet their counts in a join.

Defined cases: a null or wordless text is the end token alone. With no training document, or an empty table, all
counts are 0 and the model is uniform over classes. Rows that repeat repeat their score; a null id gives a row and is
not learned from. Equally frequent words go by their hash, equally good classes by their number. Very long texts are
read whole, in slices. Only the id and the text are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import mix, text_bytes, word_hashes
from ledgerloom.plans.scratch import settle

CLASSES = 32
SEEDS = 900
TAILS = 256
ROUNDS = 1
SHARED = 400_000
_SLICE = 4 << 20


def _tail(last_two: np.ndarray) -> np.ndarray:
    """Group of a word, by its last two bytes."""
    return (mix(last_two.astype(np.uint64)) % np.uint64(TAILS)).astype(np.int64)


def _slices(batch):
    """Of a batch (.., text): first row, and hash, row and tail of each word, in slices of whole rows."""
    data, offsets = text_bytes(batch.column(batch.num_columns - 1))
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE, "right")) - 1)
        hashes, rows, last = word_hashes(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], tails=True)
        yield at, to, hashes, rows, _tail(last)
        at = to


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, tail, n) over one text column: the exact count of every distinct word."""

    def count(batches):
        held: list[tuple] = []
        size = 0

        def merged():
            words, tails, n = (np.concatenate(c) for c in zip(*held, strict=True))
            keys, first, inverse = np.unique(words, return_index=True, return_inverse=True)
            return keys, tails[first], np.bincount(inverse, n, len(keys)).astype(np.int64)

        def out():
            keys, tails, n = merged()
            return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(tails.astype(np.int32)), pa.array(n)], names=["word", "tail", "n"])

        for b in batches:
            for _, _, hashes, _, tails in _slices(b):
                keys, first, n = np.unique(hashes, return_index=True, return_counts=True)
                held.append((keys, tails[first], n))
                size += len(keys)
                if size > 2_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return texts.mapInArrow(count, "word long, tail int, n long").groupBy("word").agg(F.first("tail").alias("tail"), F.sum("n").alias("n"))


def _frequent(words: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (sorted), counts and tails of the ``most`` most frequent; of the last level that fits in part, those of the least hash."""
    level = F.floor(F.log2("n") * 8).cast("int")
    levels = sorted(((r["level"], r["count"]) for r in words.groupBy(level.alias("level")).count().collect()), reverse=True)
    total, wanted = 0, F.lit(True)
    for k, n in levels:
        if total + n >= most:
            share = (most - total) / n
            wanted = (level > k) | ((level == k) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))))
            break
        total += n
    got = words.where(wanted).select("word", "n", "tail").toArrow()
    keys, n, tails = (got.column(c).to_numpy() for c in ("word", "n", "tail"))
    order = np.argsort(keys)
    return keys[order], n[order], tails[order].astype(np.int64)


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place in a sorted table, -1 where absent."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _units(hashes: np.ndarray, tails: np.ndarray, clustered: np.ndarray) -> np.ndarray:
    at = _find(clustered, hashes.view(np.int64))
    return np.where(at >= 0, at, len(clustered) + tails)


def _with_ends(units: np.ndarray, rows: np.ndarray, n_rows: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit before each token (``end`` at a text's start) and at it; each row gets its end token."""
    at = np.searchsorted(rows, np.arange(1, n_rows + 1))
    here = np.insert(units, at, end)
    before = np.empty_like(here)
    before[1:] = here[:-1]
    before[:1] = end
    return before, here


def bigrams(texts: DataFrame, clustered: np.ndarray) -> np.ndarray:
    """Counts of unit bigrams over all training texts; at most (SEEDS + TAILS + 1)^2 numbers."""
    n_units = len(clustered) + TAILS + 1
    shared = texts.sparkSession.sparkContext.broadcast(clustered)

    def count(batches):
        total = np.zeros(n_units * n_units, np.int64)
        for b in batches:
            for at, to, hashes, rows, tails in _slices(b):
                before, here = _with_ends(_units(hashes, tails, shared.value), rows, to - at, n_units - 1)
                total += np.bincount(before * n_units + here, minlength=len(total))
        own = np.flatnonzero(total)
        yield pa.record_batch([pa.array(own.astype(np.int32)), pa.array(total[own])], names=["pair", "n"])

    got = texts.mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_units * n_units, np.int64)
    out[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(n_units, n_units)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int | None = None) -> np.ndarray:
    """Class of each unit; the last unit (end) stays alone in the last class.

    Moves are judged by the class bigram log-likelihood, sum N(a,b) log N(a,b) - sum N(a) log N(a) over
    left and right margins. Without ``rounds`` it ends when no unit moves; each move raises the likelihood, so it does end.
    """
    n = len(pairs) - 1
    counts = pairs.astype(float)
    k = max(1, min(classes, n)) if n else 0
    order = np.argsort(-counts[:n].sum(1), kind="stable")
    label = np.empty(n + 1, np.int64)
    label[order] = np.arange(n) % max(k, 1)
    label[n] = k
    hot = np.eye(k + 1)[label]
    rows, cols = counts @ hot, counts.T @ hot  # of each unit: what follows it, what precedes it, by class
    table = hot.T @ rows
    for _ in count() if rounds is None else range(rounds):
        moved = 0
        for u in order.tolist():
            a, own = label[u], counts[u, u]
            out, into = rows[u].copy(), cols[u].copy()
            out[a] -= own
            into[a] -= own
            if not out.any() and not into.any() and not own:
                continue
            base = table.copy()
            base[a] -= out
            base[:, a] -= into
            base[a, a] -= own
            left, right = base.sum(1) + into, base.sum(0) + out  # whatever its class, the unit follows and precedes the others
            f_base = _xlogx(base)
            gain = np.full(k + 1, -np.inf)
            with_row, with_col = _xlogx(base + out[None, :]), _xlogx(base + into[:, None])
            diag = np.arange(k + 1)
            row_gain = (with_row - f_base).sum(1) - (with_row - f_base)[diag, diag]
            col_gain = (with_col - f_base).sum(0) - (with_col - f_base)[diag, diag]
            both = _xlogx(base[diag, diag] + out + into + own) - f_base[diag, diag]
            s_out, s_in = out.sum() + own, into.sum() + own
            margin = _xlogx(left + s_out) - _xlogx(left) + _xlogx(right + s_in) - _xlogx(right)
            gain[:k] = (row_gain + col_gain + both - margin)[:k]
            b = int(gain.argmax()) if gain.max() > gain[a] + 1e-9 else a
            table = base
            table[b] += out
            table[:, b] += into
            table[b, b] += own
            if b != a:
                moved += 1
                label[u] = b
                rows[:, a] -= counts[:, u]
                rows[:, b] += counts[:, u]
                cols[:, a] -= counts[u]
                cols[:, b] += counts[u]
        if not moved:
            break
    return label


def likelihood(table: np.ndarray) -> float:
    """Of the corpus under its class bigrams, up to what does not depend on the classes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(1)).sum() - _xlogx(table.sum(0)).sum())


def gains(table: np.ndarray, out: np.ndarray, into: np.ndarray, own: np.ndarray, now: np.ndarray) -> np.ndarray:
    """Of each word and class but the last, the likelihood once the word has that class.

    ``out`` and ``into``: words by classes after and before, without the word beside itself (``own``); ``now``:
    its class in ``table``. Up to a term of the word's own.
    """
    n, k = out.shape
    row, each = np.arange(n), np.arange(k)
    base = np.repeat(table[None], n, 0).astype(float)
    base[row, now] -= out
    base[row, :, now] -= into
    base[row, now, now] -= own
    left, right, f = base.sum(2) + into, base.sum(1) + out, _xlogx(base)
    rows, cols = _xlogx(base + out[:, None, :]) - f, _xlogx(base + into[:, :, None]) - f
    both = _xlogx(base[:, each, each] + out + into + own[:, None]) - f[:, each, each]
    s_out, s_in = (out.sum(1) + own)[:, None], (into.sum(1) + own)[:, None]
    margins = _xlogx(left + s_out) - _xlogx(left) + _xlogx(right + s_in) - _xlogx(right)
    return (rows.sum(2) - rows[:, each, each] + cols.sum(1) - cols[:, each, each] + both - margins)[:, : k - 1]


def _contexts(texts: DataFrame, shared: np.ndarray, classes: np.ndarray, tail_class: np.ndarray, k: int, of_words: bool) -> DataFrame:
    """One pass under the classes: rows (word, context, n) of shared words, by index; or of word -1 the class bigrams.

    Contexts of a word: the class after it, k + the class before it, 2 k for itself before it.
    """
    model = texts.sparkSession.sparkContext.broadcast((shared, classes, tail_class))

    def count(batches):
        words, own_class, tails_class = model.value
        table, held, size = np.zeros(k * k, np.int64), [], 0

        def out():
            keys, inverse = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([h[1] for h in held]), len(keys)).astype(np.int64)
            return pa.record_batch([pa.array((keys // (2 * k + 1)).astype(np.int32)), pa.array((keys % (2 * k + 1)).astype(np.int32)), pa.array(n)], names=["word", "context", "n"])

        for b in batches:
            for at, to, hashes, rows, tails in _slices(b):
                place = _find(words, hashes.view(np.int64))
                c = np.where(place >= 0, own_class[place], tails_class[tails]) if len(words) else tails_class[tails]
                before, here = _with_ends(c, rows, to - at, k - 1)
                if not of_words:
                    table += np.bincount(before * k + here, minlength=k * k)
                else:
                    # Ends and words beyond the shared ones have no place.
                    _, spot = _with_ends(place, rows, to - at, -1)
                    _, name = _with_ends(hashes, rows, to - at, 0)
                    after = np.append(here[1:], k - 1)
                    first = np.append(True, here[:-1] == k - 1)
                    twice = np.append(False, (name[1:] == name[:-1]) & (spot[1:] >= 0)) & ~first
                    known = spot >= 0
                    next_twice = np.append(twice[1:], False)
                    keys = spot * (2 * k + 1)
                    parts = [(keys + after)[known & ~next_twice], (keys + k + before)[known & ~twice], (keys + 2 * k)[twice]]
                    found, n = np.unique(np.concatenate(parts), return_counts=True)
                    held.append((found, n))
                    size += len(found)
                    if size > 4_000_000:
                        yield out()
                        held, size = [], 0
        if held:
            yield out()
        met = np.flatnonzero(table)
        yield pa.record_batch([pa.array(np.full(len(met), -1, np.int32)), pa.array(met.astype(np.int32)), pa.array(table[met])], names=["word", "context", "n"])

    return texts.mapInArrow(count, "word int, context int, n long")


def _table(counted: DataFrame, k: int) -> np.ndarray:
    out = np.zeros(k * k)
    for r in counted.groupBy("context").agg(F.sum("n").alias("n")).collect():
        out[r["context"]] = r["n"]
    return out.reshape(k, k)


def _moved(counted: DataFrame, table: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The classes after every shared word has moved, by itself, to where the likelihood is greatest."""
    k = len(table)
    model = counted.sparkSession.sparkContext.broadcast((table, classes))

    def choose(batches):
        whole, now = model.value
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                word = part.column("word").to_numpy()
                lists = part.column("l")
                owner = np.repeat(np.arange(len(word)), lists.value_lengths().to_numpy())
                flat = lists.flatten()
                vectors = np.zeros((len(word), 2 * k + 1))
                vectors[owner, flat.field("context").to_numpy()] = flat.field("n").to_numpy()
                gain = gains(whole, vectors[:, :k], vectors[:, k : 2 * k], vectors[:, 2 * k], now[word])
                best = gain.argmax(1)
                stay = gain[np.arange(len(word)), now[word]]
                best = np.where(gain.max(1) > stay + 1e-9 * np.abs(stay) + 1e-9, best, now[word])
                yield pa.record_batch([pa.array(word), pa.array(best.astype(np.int32))], names=["word", "class"])

    # One shuffle, by word, serves both sums; a word has 2 k + 1 contexts at most.
    sums = counted.repartition("word").groupBy("word", "context").agg(F.sum("n").alias("n"))
    lists = sums.groupBy("word").agg(F.collect_list(F.struct("context", "n")).alias("l"))
    got = lists.mapInArrow(choose, "word int, class int").toArrow()
    out = classes.copy()
    out[got.column("word").to_numpy()] = got.column("class").to_numpy()
    return out


@dataclass
class Model:
    shared: np.ndarray  # frequent words, sorted, their counts and classes
    counts: np.ndarray
    classes: np.ndarray
    tail_class: np.ndarray  # class of the other words, by tail
    step: np.ndarray  # log10 P(class | class before)
    class_tokens: np.ndarray  # tokens and distinct words of each class
    class_words: np.ndarray
    n_tokens: int
    n_distinct: int
    n_texts: int
    add: float = 0.5

    def emit(self, counts, classes):
        """log10 P(word | class) for a word's count."""
        return np.log10((counts + self.add) / (self.class_tokens[classes] + self.add * (self.class_words[classes] + 1)))

    def base(self, counts):
        return np.log10((counts + 1) / (self.n_tokens + self.n_distinct + 1))


def smoothed(table: np.ndarray) -> np.ndarray:
    """P(class | class before) from class bigrams: Witten-Bell weights, interpolated with P(class)."""
    alone = (table.sum(0) + 0.1) / (table.sum() + 0.1 * len(table))
    seen, kinds = table.sum(1, keepdims=True), (table > 0).sum(1, keepdims=True)
    return (table + np.maximum(kinds, 1) * alone) / (seen + np.maximum(kinds, 1))


def fit(texts: DataFrame, words: DataFrame, shared_words: int = SHARED, classes: int = CLASSES, seeds: int = SEEDS, rounds: int = ROUNDS) -> Model:
    """From the training texts (one column) and their ``word_counts``."""
    n_texts = texts.count()
    shared, counts, tails = _frequent(words, shared_words)
    chosen = np.sort(np.argsort(-counts, kind="stable")[:seeds])
    pairs = bigrams(texts, shared[chosen])
    label = exchange(pairs, classes)
    k = int(label[-1]) + 1
    hot = np.eye(k)[label]
    table = hot.T @ pairs @ hot
    tail_class = label[len(chosen) : len(chosen) + TAILS]
    of_word = tail_class[tails] if len(shared) else np.zeros(0, np.int64)
    of_word[chosen] = label[: len(chosen)]
    for _ in range(rounds if len(shared) and k > 2 else 0):
        next_class = _moved(_contexts(texts, shared, of_word, tail_class, k, True), table, of_word)
        next_table = _table(_contexts(texts, shared, next_class, tail_class, k, False), k)
        if likelihood(next_table) <= likelihood(table):
            break
        of_word, table = next_class, next_table
    tokens, distinct = np.zeros(k), np.zeros(k)
    np.add.at(tokens, of_word, counts)
    np.add.at(distinct, of_word, 1)
    all_n, all_kinds = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
    for r in words.groupBy("tail").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect():
        all_n[r["tail"]], all_kinds[r["tail"]] = r["n"], r["kinds"]
    np.add.at(tokens, tail_class, all_n - np.bincount(tails, counts, TAILS).astype(np.int64))
    np.add.at(distinct, tail_class, all_kinds - np.bincount(tails, minlength=TAILS))
    tokens[k - 1], distinct[k - 1] = n_texts, 0  # the end token is its class's only word
    n_tokens, n_distinct = int(all_n.sum()) + n_texts, int(all_kinds.sum()) + (n_texts > 0)
    return Model(shared, counts, of_word, tail_class, np.log10(smoothed(table)), tokens, distinct, n_tokens, n_distinct, n_texts)


def score(docs: DataFrame, model: Model, words: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_known, base_score, score (log10), perplexity."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = ["row", "id", "n_tokens", "n_known", "base", "own", "word", "class", "times"]

    def run(batches):
        from pyspark import TaskContext

        m: Model = shared.value
        row = TaskContext.get().partitionId() << 36
        end = len(m.step) - 1
        end_base = float(m.base(m.n_texts))
        for b in batches:
            ids = b.column(0).cast(pa.int64())
            for at, to, hashes, rows, tails in _slices(b):
                k = to - at
                place = _find(m.shared, hashes.view(np.int64))
                known = place >= 0
                classes = m.tail_class[tails]
                classes[known] = m.classes[place[known]]
                before, here = _with_ends(classes, rows, k, end)
                each = np.bincount(rows, minlength=k)
                token_row = np.repeat(np.arange(k), each + 1)
                own = np.bincount(token_row, m.step[before, here], k)
                n = m.counts[place[known]] if known.any() else np.zeros(0, np.int64)
                base = np.bincount(rows[known], m.base(n), k) + end_base
                own += np.bincount(rows[known], m.emit(n, classes[known]), k)
                n_known = np.bincount(rows[known], minlength=k) + (m.n_texts > 0)
                keys = [pa.array(np.arange(row, row + k)), ids.slice(at, k), pa.array(each + 1), pa.array(n_known), pa.array(base), pa.array(own)]
                yield pa.record_batch([*keys, pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64())], names=names)
                rare = np.stack([rows[~known].astype(np.uint64), hashes[~known], classes[~known].astype(np.uint64)])
                if rare.shape[1]:
                    order = np.lexsort((rare[1], rare[0]))
                    rare = rare[:, order]
                    first = np.ones(rare.shape[1], bool)
                    first[1:] = (rare[:2, 1:] != rare[:2, :-1]).any(0)
                    times = np.diff(np.append(np.flatnonzero(first), rare.shape[1]))
                    rare = rare[:, first]
                    g = rare.shape[1]
                    yield pa.record_batch([pa.array(rare[0].astype(np.int64) + row), pa.nulls(g, pa.int64()), *[pa.nulls(g, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())], pa.array(rare[1].view(np.int64)), pa.array(rare[2].astype(np.int32)), pa.array(times)], names=names)
                row += k

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = settle(read.mapInArrow(run, "row long, id long, n_tokens long, n_known long, base double, own double, word long, class int, times long"))
    rare = parts.where("word is not null").select("row", "word", "class", "times")
    room = [float(x) for x in model.class_tokens + model.add * (model.class_words + 1)]
    n = F.coalesce(F.col("n"), F.lit(0))
    base = F.log10((n + 1) / F.lit(float(model.n_tokens + model.n_distinct + 1)))
    own = F.log10((n + model.add) / F.element_at(F.array(*[F.lit(x) for x in room]), F.col("class") + 1))
    met = rare.join(words.select("word", "n"), "word", "left")
    met = met.select("row", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("n_tokens"), F.when(n > 0, F.col("times")).otherwise(0).alias("n_known"), (F.col("times") * base).alias("base"), (F.col("times") * own).alias("own"))
    whole = parts.where("word is null").select("row", "id", "n_tokens", "n_known", "base", "own").union(met)
    total = whole.groupBy("row").agg(F.max("id").alias("id"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("own").alias("score"))
    perplexity = F.exp(F.least(-F.col("score") / F.col("n_tokens") * math.log(10), F.lit(700.0)))
    return total.select(F.col("id").alias(id_col), "n_tokens", "n_known", "base_score", "score", perplexity.alias("perplexity"))


def learns(id_col: str = "doc_id"):
    """Training rows: crc32 of the id as text, modulo 7, is not 2."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 != 2
