"""String similarity over whole Arrow batches or grids of texts, bit-parallel in numpy, and a native upper bound that saves most calls.

``jaro_winkler`` and ``token_sort_ratio`` say what is computed, for one pair; the batch and grid kernels give the same numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

_NOT_WORD = re.compile(r"\W")


def jaro_winkler(a: str | None, b: str | None) -> float:
    """0 where either side is empty; prefix bonus 0.1 for up to four characters, above 0.7 only."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = [True] * len(b)
    from_a, at = [], []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                from_a.append(c)
                at.append(j)
                break
    m = len(from_a)
    if not m:
        return 0.0
    swaps = sum(c != b[j] for c, j in zip(from_a, sorted(at), strict=True)) // 2
    score = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if score > 0.7:
        same = 0
        for x, y in zip(a[:4], b[:4], strict=False):
            if x != y:
                break
            same += 1
        score += same * 0.1 * (1 - score)
    return score


def _common(x: str, y: str) -> int:
    """Length of the longest common subsequence, by bit rows."""
    at: dict[str, int] = {}
    for k, c in enumerate(x):
        at[c] = at.get(c, 0) | 1 << k
    row, full = (1 << len(x)) - 1, (1 << len(x)) - 1
    for c in y:
        hit = row & at.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(x) - row.bit_count()


@lru_cache(maxsize=1 << 15)
def sorted_tokens(text: str) -> str:
    return " ".join(sorted(_NOT_WORD.sub(" ", text.lower()).split()))


def token_sort_ratio(a: str | None, b: str | None) -> float:
    """Similarity of the sorted tokens, in hundredths; 0 where either side is empty."""
    if not a or not b:
        return 0.0
    x, y = sorted_tokens(a), sorted_tokens(b)
    if not x and not y:
        return 0.0
    return round(100 * 2 * _common(x, y) / (len(x) + len(y))) / 100


#: Texts up to so many characters are compared in one machine word; longer ones by the plain functions above.
WORD = 64
#: Pairs compared at once, so that their bit tables stay in a core's cache.
_BLOCK = 1 << 13
#: Cells of a grid computed at once.
_CELLS = 1 << 14


class Texts:
    """Texts as rows of code points, padded with -1, and their lengths."""

    def __init__(self, texts: list[str]):
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.flat = flat.astype(np.int8 if flat.max(initial=0) < 128 else np.int32)

    def rows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[which]
        col = np.arange(max(1, int(size.max(initial=0))))
        inside = col < size[:, None]
        out = np.full(inside.shape, -1, self.flat.dtype)
        out[inside] = self.flat[(self.at[which][:, None] + col)[inside]]
        return out, size


def _hits(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Of each pair the places of ``b`` that hold a's k-th character, as bits of a word."""
    packed = np.packbits(a[:, k : k + 1] == b, axis=1, bitorder="little")
    out = np.zeros((len(b), WORD // 8), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)[:, 0]


_LOW = np.array([(1 << n) - 1 for n in range(WORD + 1)], np.uint64)


def _low(n: np.ndarray) -> np.ndarray:
    """Words whose lowest n bits are set, n taken as 0 to 64."""
    return _LOW[np.clip(n, 0, WORD)]


def _while(k: int, size: np.ndarray) -> np.ndarray:
    """All bits where a text has a k-th character, else none."""
    return -(k < size).astype(np.uint64)


def _in_order(rows: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen characters of each row, moved to its front; -1 behind them."""
    out = np.full(rows.shape, -1, rows.dtype)
    y, x = np.nonzero(chosen)
    out[y, (np.cumsum(chosen, axis=1) - 1)[y, x]] = rows[y, x]
    return out


def jaro_winkler_words(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Of pairs of rows of code points: each character of ``a`` takes the first free equal one of ``b`` within reach, all pairs at once."""
    one = np.uint64(1)
    reach = np.maximum(0, np.maximum(na, nb) // 2 - 1)
    free = _low(nb)
    taken = np.zeros(a.shape, bool)
    for k in range(a.shape[1]):
        window = _low(k + reach + 1) & ~_low(k - reach)
        open_ = _hits(a, b, k) & free & window & _while(k, na)
        first = open_ & (~open_ + one)
        free ^= first
        taken[:, k] = first != 0
    used = (free ^ _low(nb)).view(np.uint8).reshape(-1, 8)
    of_b = np.unpackbits(used, axis=1, bitorder="little")[:, : b.shape[1]].astype(bool)
    m = taken.sum(axis=1)
    x, y = _in_order(a, taken), _in_order(b, of_b)
    w = min(x.shape[1], y.shape[1])
    swaps = (x[:, :w] != y[:, :w]).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (m / na + m / nb + (m - swaps) / m) / 3
    score[m == 0] = 0.0
    w = min(4, a.shape[1], b.shape[1])
    same = np.cumprod((a[:, :w] == b[:, :w]) & (a[:, :w] >= 0), axis=1).sum(axis=1)
    return np.where(score > 0.7, score + same * 0.1 * (1 - score), score)


def common_words(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs of rows, one word a pair."""
    full = _low(nx)
    row = full.copy()
    for k in range(y.shape[1]):
        hit = row & _hits(y, x, k) & _while(k, ny)
        row = ((row + hit) | (row - hit)) & full
    return nx - np.bitwise_count(row).astype(np.int64)


def distinct(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Of each row the number of its text, -1 for null; the texts."""
    coded = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).dictionary_encode()
    return pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def _in_words(plain, kernel, one: list[str], two: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``kernel`` over the pairs (i, j) of texts of one word at most, sorted by length and in blocks; ``plain`` over the others."""
    out = np.zeros(len(i))
    a, b = Texts(one), Texts(two)
    short = (a.size[i] <= WORD) & (b.size[j] <= WORD)
    at = np.flatnonzero(short)
    at = at[np.argsort(a.size[i[at]] * (WORD + 1) + b.size[j[at]], kind="stable")]
    for k in range(0, len(at), _BLOCK):
        own = at[k : k + _BLOCK]
        out[own] = kernel(*a.rows(i[own]), *b.rows(j[own]))
    for k in np.flatnonzero(~short).tolist():
        out[k] = plain(one[i[k]], two[j[k]])
    return out


def jaro_winkler_batch(a: pa.Array, b: pa.Array) -> np.ndarray:
    """``jaro_winkler`` of all pairs of a batch."""
    (i, one), (j, two) = distinct(a), distinct(b)
    out = np.zeros(len(i))
    sizes = [np.append(np.fromiter(map(len, t), np.int64, len(t)), 0) for t in (one, two)]
    both = np.flatnonzero((sizes[0][i] > 0) & (sizes[1][j] > 0))
    out[both] = _in_words(jaro_winkler, jaro_winkler_words, one, two, i[both], j[both])
    return out


def token_sort_batch(a: pa.Array, b: pa.Array) -> np.ndarray:
    """``token_sort_ratio`` of all pairs of a batch; the tokens of each distinct text are sorted once."""
    (i, one), (j, two) = distinct(a), distinct(b)
    there = [np.append(np.fromiter((bool(t) for t in own), bool, len(own)), False) for own in (one, two)]
    one, two = ([sorted_tokens(s) for s in own] for own in (one, two))
    out = np.zeros(len(i))
    both = np.flatnonzero(there[0][i] & there[1][j])
    na, nb = (np.fromiter(map(len, own), np.int64, len(own)) for own in (one, two))
    total = na[i[both]] + nb[j[both]] if len(both) else np.zeros(0, np.int64)
    both, total = both[total > 0], total[total > 0]
    common = _in_words(_common, common_words, one, two, i[both], j[both])
    out[both] = np.round(100 * 2 * common / total) / 100
    return out


def _columns(size: np.ndarray) -> Iterator[tuple[type | None, np.ndarray]]:
    """(word, texts) of a grid's columns by the least word that holds their characters; None for texts longer than any."""
    for word, least, most in ((np.uint32, 1, 32), (np.uint64, 33, WORD), (None, WORD + 1, np.inf)):
        if len(own := np.flatnonzero((size >= least) & (size <= most))):
            yield word, own


def _places(alphabet: np.ndarray, rows: np.ndarray, word: type) -> np.ndarray:
    """Of each character of the alphabet, and last of none, its places in each text as bits."""
    at = np.minimum(np.searchsorted(alphabet, rows), len(alphabet) - 1)
    at[alphabet[at] != rows] = len(alphabet)
    out, every = np.zeros((len(alphabet) + 1, len(rows)), word), np.arange(len(rows))
    for k in range(rows.shape[1]):
        out[at[:, k], every] |= word(1 << k)
    out[-1] = 0
    return out


def _jaro_winkler_cells(chars: np.ndarray, na: np.ndarray, places: np.ndarray, full: np.ndarray, nb: np.ndarray, windows: np.ndarray, of: np.ndarray) -> np.ndarray:
    """``jaro_winkler`` of texts, given by their characters' rows of ``places`` and the number ``of`` their windows, with the texts of ``places``."""
    free = np.repeat(full[None], len(chars), axis=0)
    one = slice(of[0], of[0] + 1) if of[0] == of[-1] else of
    hits, firsts = [], []
    for k, c in enumerate(chars.T):
        hit = places[c]
        first = hit & free
        first &= windows[k, one]
        first &= np.negative(first)
        free ^= first
        hits.append(hit)
        firsts.append(first)
    left = free ^ full
    m = np.bitwise_count(left)
    wrong = np.zeros(left.shape, np.uint8)
    for hit, first in zip(hits, firsts, strict=True):
        taken = first != 0
        lowest = np.negative(left)
        lowest &= left
        hit &= lowest
        wrong += ((hit == 0) & taken).view(np.uint8)
        lowest &= np.negative(taken.astype(left.dtype))
        left ^= lowest
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (m / na[:, None] + m / nb + (m - (wrong >> 1)) / m.astype(np.float64)) / 3
    score[m == 0] = 0.0
    run = np.ones(left.shape, left.dtype)
    same = np.zeros(left.shape, left.dtype)
    for k, c in enumerate(chars.T[:4]):
        run &= places[c] >> left.dtype.type(k)
        same += run
    return np.where(score > 0.7, score + same * 0.1 * (1 - score), score)


def jaro_winkler_grid(one: list[str], two: list[str]) -> np.ndarray:
    """``jaro_winkler`` of each text of ``one``, a row, with each of ``two``, a column."""
    out = np.zeros((len(one), len(two)))
    a, b = Texts(one), Texts(two)
    of_a = np.argsort(a.size, kind="stable")
    of_a = of_a[a.size[of_a] > 0]
    for word, own in _columns(b.size) if len(of_a) else ():
        if word is None:
            out[:, own] = [[jaro_winkler(x, two[j]) for j in own.tolist()] for x in one]
            continue
        alphabet = np.unique(a.flat)
        rows, nb = b.rows(own)
        places, full = _places(alphabet, rows, word), _low(nb).astype(word)
        step = max(1, _CELLS // len(own))
        for k in range(0, len(of_a), step):
            some = of_a[k : k + step]
            chars, na = a.rows(some)
            at = np.where(np.arange(chars.shape[1]) < na[:, None], np.searchsorted(alphabet, chars), len(alphabet))
            lengths, of = np.unique(na, return_inverse=True)
            reach = np.maximum(0, np.maximum(lengths[:, None], nb) // 2 - 1)
            place = np.arange(chars.shape[1])[:, None, None]
            windows = (_low(place + reach + 1) & ~_low(place - reach)).astype(word)
            out[np.ix_(some, own)] = _jaro_winkler_cells(at, na, places, full, nb, windows, of)
    return out


def _common_grid(one: list[str], two: list[str]) -> np.ndarray:
    """``_common`` of each text of ``one`` with each of ``two``."""
    out = np.zeros((len(one), len(two)), np.int64)
    a, b = Texts(one), Texts(two)
    by_size = np.argsort(a.size, kind="stable")
    by_size = by_size[a.size[by_size] > 0]
    for word, own in _columns(b.size) if len(by_size) else ():
        if word is None:
            out[:, own] = [[_common(x, two[j]) for j in own.tolist()] for x in one]
            continue
        alphabet = np.unique(a.flat)
        rows, nb = b.rows(own)
        places, full = _places(alphabet, rows, word), _low(nb).astype(word)
        step = max(1, _CELLS // len(own))
        for k in range(0, len(by_size), step):
            some = by_size[k : k + step]
            chars, size = a.rows(some)
            at = np.where(np.arange(chars.shape[1]) < size[:, None], np.searchsorted(alphabet, chars), len(alphabet))
            row = np.repeat(full[None], len(some), axis=0)
            for c in at.T:
                hit = places[c]
                hit &= row
                more = row + hit
                row ^= hit
                row |= more
            out[np.ix_(some, own)] = nb - np.bitwise_count(row & full)
    return out


def token_sort_grid(one: list[str], two: list[str]) -> np.ndarray:
    """``token_sort_ratio`` of each text of ``one``, a row, with each of ``two``, a column."""
    x, y = ([sorted_tokens(s) for s in own] for own in (one, two))
    common = _common_grid(x, y)
    total = np.add.outer(*(np.fromiter(map(len, own), np.int64, len(own)) for own in (x, y)))
    return np.round(100 * 2 * common / np.maximum(total, 1)) / 100


def round_half_up(x: np.ndarray, digits: int) -> np.ndarray:
    """As Spark's ``round``: halves of the printed number go up; only what lies next to a half is looked at one by one."""
    scaled = x * 10.0**digits
    whole = np.floor(scaled + 0.5)
    out = whole / 10.0**digits
    near = np.flatnonzero(np.abs(scaled + 0.5 - np.rint(scaled + 0.5)) < 1e-6)
    if len(near):
        values, at = np.unique(x[near], return_inverse=True)
        unit = Decimal(1).scaleb(-digits)
        out[near] = np.array([float(Decimal(repr(v)).quantize(unit, ROUND_HALF_UP)) for v in values.tolist()])[at]
    return out


def _udf(kernel):
    @arrow_udf("double")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(kernel(a, b), pa.float64())

    # Spark would compute a deterministic one again for each filter that it moves below it.
    return run.asNondeterministic()


def jaro_winkler_col(a: Column, b: Column) -> Column:
    return _udf(jaro_winkler_batch)(a, b)


def token_sort_col(a: Column, b: Column) -> Column:
    return _udf(token_sort_batch)(a, b)


def jaro_winkler_bound(a: Column, b: Column) -> Column:
    """Never less than the score: from the lengths, with the full prefix bonus."""
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    jaro = (2 + short / long) / 3
    return F.when((F.coalesce(short, F.lit(0)) == 0), 0.0).when(a == b, 1.0).otherwise(jaro + 0.4 * (1 - jaro))
