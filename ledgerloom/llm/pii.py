"""Personal data: fixed rules, and spans that a character BiLSTM-CRF adds to them.

Rules (``base_spans``) find, leftmost and non-overlapping within a kind, emails, IPv4 addresses,
payment cards that pass the Luhn check, and phones. The tagger adds what the rules can't say: phones without a
plus, addresses with ``(at)`` or letters beyond ASCII, IPs with ``[.]``, cards with other marks between the digits.

It learns from labelled spans of a bounded sample of documents: the rules' spans as they stand, rewritten into
such forms with their label, and rewritten into forms that are no personal data (a part over 255,
dates, five-part versions) without one; the Luhn check is left to the shape. It reads windows of ``WINDOW`` characters that overlap by half, so
an added span of up to ``LONGEST`` characters lies whole within a window wherever it begins; longer ones are not added.
Every span holds a digit, an at sign or ``(at)``, so a window without any can't hold one; all other windows of the
whole text are read. Around what is decoded,
a span is what has a kind's shape (``shaped``), with a mean probability of ``SURE`` over its characters. The spans of all
windows of a document are reconciled at once: base spans stay, and of the others the set of non-overlapping spans
of greatest total confidence joins them (weighted interval scheduling).

Defined cases: a null text is empty and has no span; an empty table gives an empty result. Texts of any length are read
whole. Rows that repeat give repeated results; of rows with equal hash and id the sample takes any, as their texts' order
says. Where no document has a base span there is nothing to learn from, and the base spans are the result. Other
columns pass through; one named like ``out`` gives way to it.
"""

from __future__ import annotations

import bisect
import random
import re
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from ledgerloom.llm.bilstm_crf import Tagger

KINDS = ("email", "ip", "card", "phone")
WINDOW = 96
LONGEST = WINDOW // 2 - 1
MAX_TRAIN_DOCS = 900
MAX_TRAIN_WINDOWS = 3200
TRAIN_WINDOW = 48
MAX_DOC_WINDOWS = 24
MAX_TRAIN_CHARS = 200_000
SURE = 0.6
SPAN = "array<struct<kind:string,start:int,stop:int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can begin within a run of digits only where one began at its start, so the look-behind changes nothing but the time.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_WIDE_HINT = re.compile(r"[0-9@\uff10-\uff19\uff20]|[(\[]at[)\]]")
#: Of a document that likely holds a base span.
_LIKELY = r"@[A-Za-z0-9-]+[.]|[+][0-9]|[0-9][.][0-9]+[.][0-9]+[.][0-9]|[0-9]([ -]?[0-9]){13}"
_FOLD = {0xFF01 + k: 0x21 + k for k in range(94)}  # full-width forms
_AT, _DOT = r"(?:@|[ ]?[(\[]at[)\]][ ]?)", r"(?:\.|[ ]?[(\[]dot[)\]][ ]?)"
_SHAPES = {
    "email": re.compile(rf"[\w.%+-]+{_AT}[\w-]+(?:{_DOT}[\w-]+)+"),
    "ip": re.compile(r"([0-9]{1,3})(?:(?:\.|\[\.\]|\(\.\)|\[dot\])([0-9]{1,3})){3}"),
    "card": re.compile(r"[0-9](?:[ ./-]{0,2}[0-9]){13,18}"),
    "phone": re.compile(r"(?:00|[+(])?[0-9][0-9 ()./-]*[0-9]"),
}
_DATE = re.compile(r"[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2,4}")
_DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def _emails(text: str):
    """Each at sign once: a local part can't hold one, so the match around it is the leftmost."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", at + 1)


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, stop) in code points, by start, then kind as listed."""
    if not text or not _HINT.search(text):
        return []
    found = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(int(g.lstrip("0")[:4] or "0") <= 255 for g in m.groups()):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40 and 14 <= len(d := _DIGITS.sub("", m[0])) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def symbols(text: str) -> np.ndarray:
    """0 pads; printable ASCII has its own symbols, with one for each of: white space, other letters, the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where((points > 0xFF00) & (points < 0xFF5F), points - 0xFEE0, points)  # full-width forms
    out = np.where((points > 32) & (points < 127), points - 32 + 3, np.where(points > 127, 2, 3))
    return np.where((points == 32) | ((points >= 9) & (points <= 13)), 1, out).astype(np.int16)


N_SYMBOLS = 98


def windows(text: str, size: int = WINDOW) -> list[int]:
    """Starts of the windows of ``size``, half a window apart over the whole text, that hold a hint of a span."""
    half = size // 2
    blocks = {at // half for m in _WIDE_HINT.finditer(text) for at in (m.start(), m.end() - 1)}
    return [b * half for b in sorted(blocks | {b - 1 for b in blocks if b})]


def _cut(codes: np.ndarray, start: int, size: int = WINDOW) -> np.ndarray:
    out = np.zeros(size, np.int16)
    own = codes[start : start + size]
    out[: len(own)] = own
    return out


def _tags(text_len: int, spans) -> np.ndarray:
    tags = np.zeros(text_len, np.int8)
    for kind, a, b in spans:
        k = KINDS.index(kind)
        tags[a:b] = 2 + 2 * k
        tags[a] = 1 + 2 * k
    return tags


def shaped(kind: str, text: str, start: int, stop: int) -> bool:
    """Whether what the tagger found can be of its kind, and stands apart from what is around it."""
    own = text[start:stop].translate(_FOLD)
    around = text[max(0, start - 2) : start].translate(_FOLD) + "\0" + text[stop : stop + 2].translate(_FOLD)
    before, after = around.split("\0")
    if not _SHAPES[kind].fullmatch(own) or before[-1:].isalnum() or after[:1].isalnum():
        return False
    digits = _DIGITS.sub("", own)
    if kind == "email":
        return any(c.isalpha() for c in own)
    if re.search("[0-9][.]$", before) or re.match("[.][0-9]", after):  # a part of something longer
        return False
    if kind == "ip":
        return all(int(part) <= 255 for part in re.findall("[0-9]+", own))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    parted = re.search("[ ()/-]", own) or own.count(".") >= 2
    return 9 <= len(digits) <= 15 and bool(parted) and not _DATE.match(own) and not re.fullmatch("[0-9]+(?:[.][0-9]+){3,}", own)


def _rewritten(kind: str, own: str, rng: random.Random) -> tuple[str, bool]:
    """Another form of a span of the rules, its signs drawn one by one, and whether it still is of its kind."""
    digits = _DIGITS.sub("", own)
    if kind == "email":
        local, _, domain = own.partition("@")
        at = rng.choice(["(at)", "[at]", " (at) ", " [at] "])
        dot = rng.choice([".", ".", "(dot)", "[dot]", " (dot) ", " [dot] "])
        odd = rng.choice("üñéößåç")
        cut, edge = rng.choice([rng.randrange(len(local) + 1), len(local)]), rng.randrange(1, len(domain) + 1)
        letters = rng.choice([f"{local[:cut]}{odd}{local[cut:]}@{domain}", f"{local}{odd}@{domain[:1]}{odd}{domain[1:]}", f"{local}@{domain[:edge]}{odd}{domain[edge:]}"])
        return rng.choice([(local + at + domain.replace(".", dot), True), (local + at + domain, True), (letters, True), (letters, True), rng.choice([(f"@{local}", False), (f"{local}@", False)])])
    if kind == "ip":
        parts = own.split(".")
        wrong = [*parts[:3], str(rng.randrange(256, 1000))] if rng.random() < 0.5 else [*parts, str(rng.randrange(20))]
        return rng.choice([(rng.choice(["[.]", "(.)", "[dot]"]).join(parts), True)] * 3 + [(".".join(wrong), False), (".".join(parts[:3]), False)])
    if kind == "card":
        size = rng.choice([4, 4, 4, 5, 6])
        return rng.choice([".", "/", "-", " ", "  ", ". ", " -", "- ", "./"]).join(digits[k : k + size] for k in range(0, len(digits), size)), True
    area, middle, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    sign = lambda: rng.choice([" ", "-", ".", "/", " - ", ""])
    first = rng.choice([area, area, area, f"0{area}", f"({area})", f"({area})", f"(0{area})", f"00{digits[:2]}{rng.choice([' ', '-', '/'])}{area}", f"1{rng.choice([' ', '-', '.'])}{area}"])
    one = rng.choice([" ", "-", ".", "/", " - "]) if first[-1] != ")" else sign()
    two = one if rng.random() < 0.5 else sign()
    date = f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}"
    wrong = rng.choice([date, f"{middle}-{last[:2]}", f"{middle},{last[:3]}.{area[:2]}"])
    return (wrong, False) if rng.random() < 0.2 else (first + one + middle + two + last, True)


def _made_up(kind: str, words: list[str], rng: random.Random) -> str:
    """A span of the rules with random digits, and names from ``words``."""
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    name = lambda: re.sub("[^a-z]", "", rng.choice(words).lower())[:9] or "mail"
    if kind == "email":
        local = rng.choice([name(), name(), f"{name()}{rng.choice('._-')}{name()}", f"{name()}{rng.choice(['', '_'])}{num(rng.randrange(1, 4))}"])
        end = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 6)))
        return f"{local}@{name()}{rng.choice(['', '', num(1), '-' + num(1)])}.{rng.choice(['com', 'org', 'net', 'example.com', end, end, end])}"
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == "card":
        body = str(rng.randrange(3, 7)) + num(rng.choice([14, 14, 13, 15]))
        return body + next(c for c in "0123456789" if luhn(body + c))
    return f"+{rng.randrange(1, 99)} {rng.randrange(200, 999)} {num(3)} {num(4)}"


def _decoy(words: list[str], rng: random.Random) -> str:
    """Numbers and signs that are nothing: dates, versions, amounts, references, handles."""
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return rng.choice([
        f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}", f"{rng.randrange(1, 29)}/{rng.randrange(1, 13)}/{rng.randrange(1900, 2100)}", ".".join(str(rng.randrange(300)) for _ in range(5)),
        ".".join([*(num(2) for _ in range(3)), str(rng.randrange(256, 999))]), num(rng.randrange(1, 9)), f"{num(3)}.{num(rng.randrange(2, 5))}", f"{num(2)},{num(3)}", f"{num(3)}-{num(2)}", f"@{rng.choice(words)}", f"{rng.choice(words)} {num(3)}", f"v{num(1)}.{num(1)}.{num(1)}", f"{num(2)}:{num(2)}",
    ])


def _carrier(text: str, rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A stretch of ``text`` between two words with spans and decoys put between its words, and where the spans are.

    Every kind comes as often, in its own form and rewritten, whatever the corpus holds.
    """
    words = text[:4000].split()
    start = rng.randrange(max(1, len(words) - 12))
    own = [w for w in words[start : start + rng.randrange(4, 14)] if not _HINT.search(w)] or ["the"]
    out, spans, left = "", [], rng.randrange(1, 3)
    for k, word in enumerate(own):
        out += word[:20] + " "
        if left and (rng.random() < 0.3 or k == len(own) - 1):
            left -= 1
            if rng.random() < 0.7:
                kind = rng.choice(KINDS)
                made, is_one = (_made_up(kind, own, rng), True) if rng.random() < 0.2 else _rewritten(kind, _made_up(kind, own, rng), rng)
                if is_one:
                    spans.append((kind, len(out), len(out) + len(made)))
            else:
                made = _decoy(own, rng)
            out += made + rng.choice([" ", " ", ", ", ". "])
    return out, spans


def _windows_of(text: str, spans, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    codes, tags, starts = symbols(text), _tags(len(text), spans), windows(text, TRAIN_WINDOW)
    starts.sort(key=lambda s: not tags[s : s + TRAIN_WINDOW].any())  # stable: those with a span first
    pad = lambda s: np.pad(tags[s : s + TRAIN_WINDOW], (0, max(0, s + TRAIN_WINDOW - len(text))))
    return [(_cut(codes, s, TRAIN_WINDOW), pad(s)) for s in starts[:most]]


def examples(text: str, seed: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows (symbols, tags) to learn from: of the text with its spans, of two texts with rewritten ones, and of stretches with made-up ones.

    They take turns, so that the first few windows of a document hold some of each.
    """
    rng, base = random.Random(f"{seed}:{len(text)}:{text[:64]}"), base_spans(text)
    apart, done = [], 0
    for s in base:  # spans of different kinds may overlap; the first one counts
        if s[1] >= done:
            apart.append(s)
            done = s[2]
    sources = []
    for k in range(3 if apart else 1):
        pieces, spans, at, size = [], [], 0, 0
        for kind, a, b in apart:
            own, is_one = (text[a:b], True) if k == 0 else _rewritten(kind, text[a:b], rng)
            pieces += [text[at:a], own]
            size += a - at
            if is_one:
                spans.append((kind, size, size + len(own)))
            size, at = size + len(own), b
        sources.append(_windows_of("".join([*pieces, text[at:]]), spans, MAX_DOC_WINDOWS // 3))
    made = [w for _ in range(MAX_DOC_WINDOWS // 2) for w in _windows_of(*_carrier(text, rng), 2)]
    turns = [made[:len(made) // 2], sources[0], made[len(made) // 2:], *sources[1:]]
    return [own[k] for k in range(max(map(len, turns))) for own in turns if k < len(own)]


def _trained(xs: list[np.ndarray], ys: list[np.ndarray], epochs: int) -> Tagger | None:
    if not xs or not any(y.any() for y in ys):
        return None
    tagger = Tagger(N_SYMBOLS, 1 + 2 * len(KINDS))
    tagger.fit(np.stack(xs).astype(np.int64), np.stack(ys).astype(np.int64), epochs, 32)
    return tagger


def fit(texts: list[str], epochs: int = 12) -> Tagger | None:
    """Train on the first ``MAX_TRAIN_WINDOWS`` windows of ``texts``, labelled by their base spans."""
    found = list(islice((e for k, t in enumerate(texts) for e in examples(t, k)), MAX_TRAIN_WINDOWS))
    return _trained([x for x, _ in found], [y for _, y in found], epochs)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", epochs: int = 12) -> Tagger | None:
    """Fit on documents that come first by a hash of the id: ``MAX_TRAIN_DOCS`` that likely hold a span, and a third as many of any kind.

    Executors cut the windows, so the driver gets ``MAX_TRAIN_WINDOWS`` windows and no text.
    """
    spread = F.pmod(F.xxhash64(id_col), F.lit(1 << 40))
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("string").alias("id"), spread.alias("h")).where((F.length("text") > 0) & (F.length("text") <= MAX_TRAIN_CHARS))
    count = docs.count()

    def cut(batches):
        for b in batches:
            for h, text in zip(b.column("h").to_pylist(), b.column("text").to_pylist(), strict=True):
                found = examples(text, h)
                k = len(found)
                yield pa.record_batch([pa.array([h] * k, pa.int64()), pa.array(range(k), pa.int32()), pa.array([x.tobytes() for x, _ in found], pa.binary()), pa.array([y.tobytes() for _, y in found], pa.binary())], names=["h", "k", "x", "y"])

    def sample(own: DataFrame, most: int, per_row: int) -> list:
        share = min(1.0, per_row * most / max(count, 1))
        while True:  # a sample that turns out too thin is drawn again, wider
            picked = own.where(F.col("h") < int(share * (1 << 40))).orderBy("h", "id", "text").limit(most)
            found = picked.mapInArrow(cut, "h long, k int, x binary, y binary").orderBy("k", "h", "x").limit(MAX_TRAIN_WINDOWS * 3 // 4 if per_row > 9 else MAX_TRAIN_WINDOWS // 4).collect()
            if share == 1.0 or len({r["h"] for r in found}) * 2 > most or len(found) >= MAX_TRAIN_WINDOWS // 4:
                return found
            share = min(1.0, share * 8)

    found = sample(rows.where(F.col("text").rlike(_LIKELY)), MAX_TRAIN_DOCS, 30) + sample(rows, MAX_TRAIN_DOCS // 3, 9)
    return _trained([np.frombuffer(r["x"], np.int16) for r in found], [np.frombuffer(r["y"], np.int8) for r in found], epochs)


def _candidates(text: str, start: int, tags: np.ndarray, sure: np.ndarray):
    """Spans of a window: what has a kind's shape where the tagger marked more than half of it.

    One that touches the window's edge is left to the neighbour that holds it whole. The tagger's kind is tried
    first, then the others as listed.
    """
    n = min(WINDOW, len(text) - start)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], tags[:n] > 0, [0]]).astype(np.int8)))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        said = KINDS[(int(np.bincount(tags[a:b]).argmax()) - 1) // 2]
        low, high = max(0, a - LONGEST), min(n, b + LONGEST)
        around = text[start + low : start + high].translate(_FOLD)
        for kind in (said, *(k for k in KINDS if k != said)):
            met = [(m.start() + low, m.end() + low) for m in _SHAPES[kind].finditer(around) if m.start() + low < b and m.end() + low > a]
            met = [(x, y) for x, y in met if (x > 0 or start == 0) and (y < WINDOW or start + y == len(text)) and y - x <= LONGEST and 2 * int((tags[x:y] > 0).sum()) > y - x]
            found = [(x, y) for x, y in met if float(sure[x:y].mean()) >= SURE and shaped(kind, text, start + x, start + y)]
            if found:
                yield from ((kind, start + x, start + y, float(sure[x:y].mean())) for x, y in found)
                break


def reconcile(base, candidates) -> list[tuple[str, int, int]]:
    """Base spans, and of the candidates clear of them the non-overlapping set of greatest total confidence."""
    best: dict[tuple[str, int, int], float] = {}
    stops = list(accumulate((b for _, _, b in base), max))
    starts = [a for _, a, _ in base]
    for kind, a, b, sure in candidates:
        k = bisect.bisect_left(starts, b)
        if k and stops[k - 1] > a:
            continue
        best[kind, a, b] = max(best.get((kind, a, b), 0.0), sure)
    free = sorted(best.items(), key=lambda x: (x[0][2], x[0][1], x[0][0]))
    ends, total, chosen = [s[2] for s, _ in free], [0.0], []
    for (_, a, _), sure in free:
        k = bisect.bisect_right(ends, a, 0, len(total) - 1)
        chosen.append(k)
        total.append(max(total[-1], total[k] + sure))
    added, k = [], len(free)
    while k:
        if total[k] > total[k - 1]:
            added.append(free[k - 1][0])
            k = chosen[k - 1]
        else:
            k -= 1
    return sorted([*base, *added], key=lambda s: (s[1], KINDS.index(s[0])))


def find_batch(texts: list[str | None], tagger: Tagger | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    more: list[list] = [[] for _ in texts]
    held: list[tuple[int, int, np.ndarray]] = []

    def flush():
        tags, sure = tagger.decode(np.stack([w for _, _, w in held], 1).astype(np.int64))
        for k, (i, start, _) in enumerate(held):
            if tags[:, k].any():
                more[i].extend(_candidates(texts[i], start, tags[:, k], sure[:, k]))
        held.clear()

    if tagger is not None:
        for i, text in enumerate(texts):
            if text and (starts := windows(text)):
                codes = symbols(text)
                for start in starts:
                    held.append((i, start, _cut(codes, start)))
                    if len(held) == 512:
                        flush()
        if held:
            flush()
    return [(b, reconcile(b, m)) for b, m in zip(base, more, strict=True)]


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, tagger: Tagger | None, text_col: str = "text", out: str = "pii") -> DataFrame:
    """Adds a struct column ``out`` with the arrays ``base`` and ``spans``."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    @arrow_udf(f"base {SPAN}, spans {SPAN}")
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for at in range(0, len(texts), 256):
            rows += find_batch(texts[at : at + 256].to_pylist(), shared.value)
        columns = [pa.array([[dict(zip(("kind", "start", "stop"), s, strict=True)) for s in r[k]] for r in rows], span) for k in (0, 1)]
        return pa.StructArray.from_arrays(columns, names=["base", "spans"])

    return docs.withColumn(out, found(text_col))


def spans_text(spans):
    """The column form of ``joined``."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redacted(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """The documents, with every span replaced by its kind in angle brackets; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    @arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        out: list[str | None] = []
        for at in range(0, len(texts), 256):
            part = texts[at : at + 256].to_pylist()
            for text, (_, spans) in zip(part, find_batch(part, shared.value), strict=True):
                pieces, done = [], 0
                for kind, a, b in spans:
                    if a >= done:
                        pieces += [text[done:a], f"<{kind}>"]
                    done = max(done, b)
                out.append(None if text is None else "".join([*pieces, text[done:]]))
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, clean(text_col))

