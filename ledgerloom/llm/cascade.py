"""Quarantine and cascading release: attempts from a table, gathered along the order of turns.

A turn that is faulty is quarantined and tried again with growing waits until it is repaired and no random failure hits; its
children wait for it. How many attempts a turn needs depends on two small numbers only: the seconds of repair that remain
at its first attempt, clipped to 0 and the longest repair, and a bitmask of the attempts that fail at random. So all answers are computed once,
in a table of (longest repair + 1) x 2^attempts entries, and no turn runs a loop of attempts: the k-th turns of all
independent stretches of a batch look up their parents' ends and then their own entry, all at once.

Conversations are dealt by ranges of (conversation, turn), so one of any length lies in several partitions. A turn's parent is at most
``reach - 1`` turns earlier, so between two turns that no parent link crosses, the earlier ones don't matter. Partitions
decide all whole stretches between such places. What is left at their two ends (a few turns a partition)
meets by stretch in a second, tiny step. Numbers of turns, of releases, and the running state are
prefix sums: local ones in each partition, and one row a partition of what earlier ones hold.

Defined cases: turns of equal number follow each other by a hash of role and text; a null turn comes first, a null conversation is one
conversation, and in hashes null is written as nothing; a null text is empty; an empty table gives an empty result. ``state`` is
kept modulo 2^64, as longs are. Columns beyond the four that are read are not in the result, whatever their names. A stretch is decided
in one task; its length is a matter of the hashes (mean 4.5 turns; one in 10^11 is longer than 100).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.ordered import Runs, by_ranges, carried, joined, with_edges
from ledgerloom.plans.scratch import settle

DELIVERED, DEAD, BLOCKED = 0, 1, 2
STATUS = ("delivered", "dead", "blocked")


@dataclass(frozen=True)
class Policy:
    """Seconds between arrivals, parents, faults, repairs and retries; every draw is a CRC32 of ``k:conversation:turn``."""

    gap: int = 7
    reach: int = 3
    modulus: int = 101
    faulty_below: int = 35
    fails_one_in: int = 3
    first_wait: int = 10
    attempts: int = 5

    def waits(self) -> np.ndarray:
        """Seconds from the first attempt to each."""
        return self.first_wait * (2 ** np.arange(self.attempts, dtype=np.int64) - 1)


def attempts_table(policy: Policy) -> np.ndarray:
    """[remaining repair seconds, bitmask of random failures] -> the attempt that delivers, or 0."""
    table = np.zeros((policy.modulus, 1 << policy.attempts), np.int8)
    remaining, mask = np.arange(policy.modulus)[:, None], np.arange(1 << policy.attempts)[None, :]
    for a in reversed(range(policy.attempts)):
        good = (policy.waits()[a] >= remaining) & (mask >> a & 1 == 0)
        table[good] = a + 1
    return table


def replay(starts: np.ndarray, dist: np.ndarray, repair: np.ndarray, mask: np.ndarray, policy: Policy, table: np.ndarray) -> tuple[np.ndarray, ...]:
    """(status, attempts, wait, took) of turns in order; no parent lies before one of ``starts``.

    ``dist``: turns back to the parent, 0 for none. ``repair``: seconds, -1 for a sound turn. ``wait`` and ``took`` are the seconds
    from arrival to the first and the last attempt.
    """
    n, waits = len(dist), policy.waits()
    status, attempts, wait, took = np.zeros(n, np.int8), np.zeros(n, np.int8), np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = np.arange(n)
    step = at - np.maximum.accumulate(np.where(starts, at, 0))
    order = np.argsort(step, kind="stable")
    bounds = np.searchsorted(step[order], np.arange(int(step.max(initial=-1)) + 2))
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        i = order[lo:hi]
        parent = i - dist[i]
        child = dist[i] > 0
        late = np.where(child, np.maximum(0, took[parent] - policy.gap * dist[i]), 0)
        left = np.clip(repair[i] - late, 0, policy.modulus - 1)
        got = np.where(repair[i] < 0, 1, table[left, mask[i]])
        blocked = child & (status[parent] != DELIVERED)
        tried = np.where(blocked, 0, np.where(got == 0, policy.attempts, got))
        status[i] = np.where(blocked, BLOCKED, np.where(got == 0, DEAD, DELIVERED))
        attempts[i] = tried
        wait[i] = late
        took[i] = late + waits[np.maximum(tried, 1) - 1]
    return status, attempts, wait, took


def known_parents(dist: np.ndarray, place: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """``dist``, with 0 where the parent would lie before the first turn; that shows only of conversations that are ``whole``."""
    return np.where(whole & (dist > place), 0, dist)


def _turns(df: DataFrame, policy: Policy, names: dict[str, str]) -> DataFrame:
    """(conv, turn, tie, crc, dist, repair, mask): all draws as expressions, texts no further than their checksums."""
    c = lambda k: F.col(f"`{names[k]}`")
    h = lambda k: F.crc32(F.concat(F.lit(f"{k}:"), F.coalesce(c("conv_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce(c("turn").cast("string"), F.lit(""))).cast("binary"))
    fails = lambda a: F.when(h(a + 2) % policy.fails_one_in == 0, 1 << (a - 1)).otherwise(0)
    mask: Column = F.lit(0)
    for a in range(1, policy.attempts + 1):
        mask = mask + fails(a)
    return df.select(
        c("conv_id").alias("conv"), c("turn").alias("turn"), F.xxhash64(c("role"), c("text")).alias("tie"), F.crc32(F.coalesce(c("text"), F.lit("")).cast("binary")).alias("crc"),
        (h(0) % policy.reach).cast("int").alias("dist"), F.when(h(1) % policy.modulus < policy.faulty_below, h(2) % policy.modulus).otherwise(-1).cast("int").alias("repair"), mask.cast("int").alias("mask"),
    )


#: Of a row: decided; or open, before the first place that no link crosses, after the last one, or without any.
DONE, FRONT, BACK, THROUGH = 0, 1, 2, 3
_RESULT = "status tinyint, attempts tinyint, wait long, took long"


def _decided(turns: DataFrame, policy: Policy) -> DataFrame:
    """Each partition's whole stretches decided; ``seam`` marks the rest. Written, as partitions are what later steps refer to."""
    ranged = by_ranges(turns, "conv", "turn", "tie")
    kind = dict(turns.dtypes)
    schema = f"conv {kind['conv']}, turn {kind['turn']}, tie long, crc long, dist int, repair int, mask int, _place long, seam tinyint, {_RESULT}, _part int, _edge int"
    table = attempts_table(policy)

    def decide(batches):
        runs, held, first_cut = Runs(["conv"]), [], [False]

        def flush(rows: pa.Table, lo: int, seam: int, starts: np.ndarray, place: np.ndarray):
            """Rows up to ``lo``: decided from ``starts`` on, with ``seam`` before the first of them."""
            n = lo
            marks = np.zeros(n, np.int8)
            col = lambda c: rows.column(c).to_numpy()[:n]
            out = [np.zeros(n, np.int8), np.zeros(n, np.int8), np.zeros(n, np.int64), np.zeros(n, np.int64)]
            known = np.flatnonzero(starts[:n])
            a = int(known[0]) if len(known) and seam != BACK else n
            marks[:a] = seam
            if a < n:
                dist = known_parents(col("dist")[a:], place[a:n], whole[0][a:n])
                for o, got in zip(out, replay(starts[a:n], dist, col("repair")[a:], col("mask")[a:], policy, table), strict=True):
                    o[a:] = got
            part = rows.slice(0, n).combine_chunks().to_batches()
            for b in part:
                for name, values in (("_place", place[:n]), ("seam", marks), *zip(("status", "attempts", "wait", "took"), out, strict=True)):
                    b = b.append_column(name, pa.array(values))
                yield b

        whole = [np.zeros(0, bool)]  # of each open row: its conversation starts in this partition

        def arrays(batch):
            if batch is None:
                if held:
                    rows, place, starts, mine = held.pop()
                    whole[0] = mine
                    seam = BACK if first_cut[0] else THROUGH
                    yield from flush(rows, len(rows), seam, np.zeros(len(rows), bool), place)
                return
            if not len(batch):
                return
            fresh = runs.last is None
            begins, place = runs.number(batch)
            if fresh:
                begins[0] = False  # an earlier partition may hold more of it
            rows = pa.Table.from_batches([batch])
            now = np.zeros(len(batch), bool)
            seen = np.flatnonzero(begins)
            if len(seen):
                now[seen[0] :] = True
            if held:
                before, old_place, old_begins, mine = held.pop()
                rows, place, begins = pa.concat_tables([before, rows]), np.concatenate([old_place, place]), np.concatenate([old_begins, begins])
                now[: seen[0] if len(seen) else len(now)] = mine[-1]
                now = np.concatenate([mine, now])
            whole[0] = now
            dist = known_parents(rows.column("dist").to_numpy(), place, now)
            # A place that no link crosses: none of the next reach - 1 rows of the conversation has a parent before it.
            clean = begins.copy()
            inner = np.zeros(len(dist), bool)
            inner[: max(0, len(dist) - policy.reach + 2)] = True
            for ahead in range(policy.reach - 1):
                far = np.append(dist[ahead:], np.zeros(ahead, dist.dtype))
                other = np.zeros(len(dist), bool)  # a new conversation lies between
                for k in range(1, ahead + 1):
                    other |= np.append(begins[k:], np.zeros(k, bool))
                inner &= (far <= ahead) | other
            clean |= inner
            cuts = np.flatnonzero(clean)
            if not len(cuts):
                held.append((rows, place, begins, now))
                return
            last = int(cuts[-1])
            if last or first_cut[0]:
                lead = FRONT if not first_cut[0] else DONE
                yield from flush(rows, last, lead, clean, place)
            first_cut[0] = True
            held.append((rows.slice(last), place[last:], begins[last:], now[last:]))

        return with_edges(batches, arrays)

    return settle(ranged.mapInArrow(decide, schema))


def _seams(decided: DataFrame, carry: DataFrame, policy: Policy) -> DataFrame:
    """The open rows of all partitions, by the stretches that they form together."""
    kind = dict(decided.dtypes)
    rows = joined(decided.where("seam > 0"), carry, "conv", "_before").withColumn("_before", F.coalesce("_before", F.lit(0)))
    each = decided.where("seam > 0").groupBy(F.col("_part").alias("p"), F.col("conv").alias("c")).agg(F.max(F.when(F.col("seam") == BACK, 1).otherwise(0)).alias("cut"))
    each = each.withColumn("stretch", F.sum("cut").over(W.partitionBy("c").orderBy("p").rowsBetween(W.unboundedPreceding, 0)))
    named = rows.join(each, (rows["_part"] == each["p"]) & rows["conv"].eqNullSafe(each["c"])).withColumn("stretch", F.col("stretch") - F.when(F.col("seam") == FRONT, F.col("cut")).otherwise(0))
    named = named.select("conv", "stretch", "turn", "crc", (F.col("_place") + F.col("_before")).alias("p"), "dist", "repair", "mask")
    table = attempts_table(policy)

    def decide(batches):
        runs, held, starts = Runs(["conv", "stretch"]), None, np.zeros(0, bool)
        for batch in chain(batches, [None]):
            if batch is not None and len(batch):
                starts = np.concatenate([starts, runs.number(batch)[0]])
                new = pa.Table.from_batches([batch])
                held = new if held is None else pa.concat_tables([held, new])
            n = len(starts) if batch is None else int(np.flatnonzero(starts)[-1]) if len(starts) else 0
            if not n:
                continue
            rows, held = held.slice(0, n).combine_chunks(), held.slice(n)
            col = {c: rows.column(c).to_numpy() for c in ("p", "dist", "repair", "mask")}
            got = replay(starts[:n], np.where(col["dist"] <= col["p"], col["dist"], 0), col["repair"], col["mask"], policy, table)
            starts = starts[n:]
            for b in rows.select(["conv", "turn", "crc", "p"]).to_batches():
                for name, values in zip(("status", "attempts", "wait", "took"), got, strict=True):
                    b = b.append_column(name, pa.array(values))
                yield b

    dealt = named.repartition("conv", "stretch").sortWithinPartitions("conv", "stretch", "p")
    return settle(dealt.mapInArrow(decide, f"conv {kind['conv']}, turn {kind['turn']}, crc long, p long, {_RESULT}"))


def _released(delivered: DataFrame) -> DataFrame:
    """Adds the partition's own release number (``_place``, from 0), sum of checksums and weighted sum; written."""
    ranged = by_ranges(delivered, "conv", "last_at", "turn", "crc", "first_at")
    fields = ", ".join(f"{c} {t}" for c, t in delivered.dtypes)

    def number(batches):
        runs, sums = Runs(["conv"]), [np.uint64(0), np.uint64(0)]

        def running(values: np.ndarray, starts: np.ndarray, before: np.uint64) -> np.ndarray:
            """Sums from each run's start, modulo 2^64."""
            total = np.cumsum(values, dtype=np.uint64)
            at = np.arange(len(values))
            since = np.maximum.accumulate(np.where(starts, at, -1))
            base = np.where(since > 0, total[np.maximum(since, 1) - 1], np.uint64(0))
            return np.where(since < 0, total + before, total - base)

        def arrays(batch):
            if batch is None or not len(batch):
                return
            starts, place = runs.number(batch)
            crc = batch.column("crc").to_numpy().astype(np.uint64)
            both = [running(crc, starts, sums[0]), running((place + 1).astype(np.uint64) * crc, starts, sums[1])]
            sums[:] = [x[-1] for x in both]
            for name, values in (("_place", place), ("_crcs", both[0].view(np.int64)), ("_state", both[1].view(np.int64))):
                batch = batch.append_column(name, pa.array(values))
            yield batch

        return with_edges(batches, arrays)

    return settle(ranged.mapInArrow(number, f"{fields}, _place long, _crcs long, _state long, _part int, _edge int"))


def _long(x: Column) -> Column:
    """A whole decimal modulo 2^64, as the long of those bits."""
    rest = F.pmod(x, F.lit(str(2**64)).cast("decimal(38,0)"))
    return F.when(rest >= F.lit(str(2**63)).cast("decimal(38,0)"), rest - F.lit(str(2**64)).cast("decimal(38,0)")).otherwise(rest).cast("long")


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(38,0)")


def release(turns: DataFrame, policy: Policy = Policy(), names: dict[str, str] | None = None) -> DataFrame:
    """(conv_id, turn, status, attempts, first_at, last_at, release_no, state) of every row of (conv_id, turn, role, text)."""
    names = {c: c for c in ("conv_id", "turn", "role", "text")} | (names or {})
    decided = _decided(_turns(turns, policy, names), policy)
    carry = settle(carried(decided, "conv").select("_part", "conv", "_before"))
    keep = ["conv", "turn", "crc", "p", "status", "attempts", "wait", "took"]
    done = joined(decided.where("seam = 0"), carry.where("_before > 0"), "conv", "_before").withColumn("p", F.col("_place") + F.coalesce("_before", F.lit(0)))
    both = done.select(*keep).unionByName(_seams(decided, carry, policy).select(*keep))
    at, tried = F.col("p") * policy.gap, F.col("attempts") > 0
    timed = both.select("conv", "turn", "crc", "status", F.col("attempts").cast("int").alias("attempts"), F.when(tried, at + F.col("wait")).alias("first_at"), F.when(tried, at + F.col("took")).alias("last_at"))
    local = _released(timed.where(F.col("status") == DELIVERED))
    before = carried(local, "conv", "_crcs", "_state")
    # What earlier partitions hold of a conversation: each one's weighted sum, and its checksums once more for every release before it.
    so_far = W.partitionBy("conv").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = settle(before.withColumn("_held", _long(F.coalesce(F.sum(_wide("_state") + _wide("_before") * _wide("_crcs")).over(so_far), F.lit(0).cast("decimal(38,0)")))).where("_before > 0").select("_part", "conv", "_before", "_held"))
    out = joined(local, before, "conv", "_before", "_held")
    state = F.when(F.col("_before").isNull(), F.col("_state")).otherwise(_long(_wide("_state") + _wide("_before") * _wide("_crcs") + _wide("_held")))
    final = lambda df, number, state: df.select(F.col("conv").alias("conv_id"), "turn", F.element_at(F.array(*[F.lit(s) for s in STATUS]), F.col("status").cast("int") + 1).alias("status"), "attempts", "first_at", "last_at", number.cast("long").alias("release_no"), state.cast("long").alias("state"))
    null = F.lit(None)
    return final(out, F.col("_place") + 1 + F.coalesce("_before", F.lit(0)), state).unionByName(final(timed.where(F.col("status") != DELIVERED), null, null))
