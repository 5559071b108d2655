"""A Merkle manifest of a dataset by supersteps over RDDs, in the manner of Pregel.

Vertices are the nodes of one binary tree for each group, and of a tree over the groups' roots. In each superstep up, children
send their digests to their parent; a parent that has all its children's digests hashes them and forwards its own.
When all groups have halted at their roots, supersteps down carry from each parent to its children the siblings and
sides on the way to the root; at the leaves each row folds its own digest along that way and compares the
result with the root.

A vertex here stands for ``2 ** bits`` children, that is for ``bits`` levels of binary nodes: the levels inside are
messages within the vertex. So a tree over n rows takes log2(n) / bits supersteps, its leaf level never travels beyond one
shuffle by vertex, and no task holds more than one vertex's children at a time. A vertex knows that it is
complete, and whether it is the top, from a mark that the last node of each group carries up; no counts are sent around.
Places in the groups come from ``ordered``: no group passes through one task.

Each superstep's vertices are written to the shared folder: a lost executor costs its tasks only, and the way down reads them again.
The driver counts the vertices of each step and sees no digest.

Defined cases: null fields are ``-``; a null group is a group of its own, ahead of all others; null ids come first in their group, rows
of equal ids follow each other by their digests, equal rows are leaves of their own; a null id is not tampered with; an empty table gives an empty result. Texts of
any length are hashed whole. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.ordered import carried, joined, numbered
from ledgerloom.plans.scratch import settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Binary levels of one vertex.
BITS = 8

RIGHT, LEFT, ALONE = 1, 0, 2  # where a sibling stands
#: A vertex: its children's digests in order, 32 bytes each, with ids and altered digests of rows; the group's root if it is the top.
VERTEX = "grp string, vertex long, top boolean, last boolean, digests binary, ids array<long>, altered array<binary>, digest binary"


def encoded(c: Column) -> Column:
    """``-`` of null, else the UTF-8 byte count, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in values]).cast("binary"), 256)


def parent_digest(*children: bytes) -> bytes:
    """Of raw digests, by their hex texts."""
    return sha256("".join(c.hex() for c in children).encode()).digest()


def levels(digests: list[bytes], top: bool, bits: int) -> list[list[bytes]]:
    """The nodes of each level within a vertex, up to its own digest; the top's ends at its single node."""
    out = [digests]
    while len(out) <= bits and (len(out[-1]) > 1 or not top):
        now = out[-1]
        out.append([parent_digest(*now[i : i + 2]) for i in range(0, len(now), 2)])
    return out


def way_up(tree: list[list[bytes]], child: int) -> list[tuple[int, bytes]]:
    """(side, sibling) of each level from a child to its vertex's digest."""
    out = []
    for nodes in tree[:-1]:
        other = child ^ 1
        out.append((RIGHT if child < other else LEFT, nodes[other]) if other < len(nodes) else (ALONE, b""))
        child >>= 1
    return out


def fold(digest: bytes, way: list[tuple[int, bytes]]) -> bytes:
    for side, other in way:
        digest = parent_digest(digest, other) if side == RIGHT else parent_digest(other, digest) if side == LEFT else parent_digest(digest)
    return digest


def _deal(key: tuple) -> int:
    return zlib.crc32(repr(key).encode())


def _children(digests: bytes) -> list[bytes]:
    return [bytes(digests[i : i + 32]) for i in range(0, len(digests), 32)]


def _superstep(messages, spark, bits: int, n_parts: int) -> DataFrame:
    """``messages``: ((group, vertex), (child, last, digest, id, altered)). Vertices that have got all their children; written."""

    def complete(item):
        (group, vertex), got = item
        got = sorted(got, key=lambda m: m[0])
        last = any(m[1] for m in got)
        top = last and vertex == 0
        digest = levels([bytes(m[2]) for m in got], top, bits)[-1][0]
        return group, vertex, top, last, b"".join(bytes(m[2]) for m in got), [m[3] for m in got], [None if m[4] is None else bytes(m[4]) for m in got], digest

    return settle(spark.createDataFrame(messages.groupByKey(n_parts, _deal).map(complete), VERTEX, verifySchema=False))


def climb(nodes: DataFrame, bits: int = BITS) -> list[DataFrame]:
    """The vertices of each superstep up; ``nodes``: (grp, place, last, digest binary, id, altered binary)."""
    spark, steps = nodes.sparkSession, []
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    messages = nodes.select("grp", "place", "last", "digest", "id", "altered").rdd.map(lambda r: ((r[0], r[1] >> bits), (r[1], r[2], bytes(r[3]), r[4], r[5])))
    while True:
        steps.append(_superstep(messages, spark, bits, n_parts))
        going = steps[-1].where(~F.col("top")).select("grp", "vertex", "last", "digest")
        if going.isEmpty():
            return steps
        messages = going.rdd.map(lambda r: ((r[0], r[1] >> bits), (r[1], r[2], bytes(r[3]), None, None)))


def descend(steps: list[DataFrame], entries, bits: int = BITS):
    """RDD of (group, place, id, digest, altered, (root digests, way)) of the nodes that ``climb`` began with.

    ``entries``: RDD of (group, (digests from the group's root on, way from there)) that tops receive; other vertices hear from their parents.
    """
    spark = steps[0].sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    from_above = spark.sparkContext.emptyRDD()
    for k, step in reversed(list(enumerate(steps))):
        vertices = step.rdd.map(lambda r: ((r[0], r[1]), (r[2], bytes(r[4]), r[5], r[6])))
        inbox = from_above.union(entries.map(lambda e: ((e[0], 0), ("top", e[1]))))

        def spread(item, leaf: bool = k == 0) -> Iterator[tuple]:
            (group, vertex), got = item
            got = list(got)
            heard = [m for own, m in got if not own]
            for top, digests, ids, altered in (v for own, v in got if own):
                children = _children(digests)
                tree = levels(children, top, bits)
                for kind, (roots, rest) in heard:
                    if (kind == "top") != top:
                        continue
                    for j, child in enumerate(children):
                        way = (roots, way_up(tree, j) + rest)
                        place = (vertex << bits) + j
                        yield (group, place, ids[j], child, altered[j], way) if leaf else ((group, place), ("child", way))

        both = vertices.mapValues(lambda v: (True, v)).union(inbox.mapValues(lambda m: (False, m))).groupByKey(n_parts, _deal)
        from_above = both.flatMap(spread)
    return from_above


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", altered: dict[str, Column] | None = None, where: Column | None = None, bits: int = BITS) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``altered`` gives other values of fields for the rows ``where`` it holds: these fold an altered leaf along the
    siblings of the original tree, and so fail. By default no row is altered.
    """
    spark = docs.sparkSession
    value = {c: F.col(f"`{c}`") for c in fields}
    leaf = leaf_digest(list(value.values()))
    other = F.when(where, leaf_digest([(altered or {}).get(c, value[c]) for c in fields])) if where is not None else F.lit(None).cast("string")
    rows = docs.select(F.col(f"`{group_col}`").cast("string").alias("grp"), F.col(f"`{id_col}`").cast("long").alias("id"), F.unhex(leaf).alias("digest"), F.unhex(other).alias("altered"))
    placed = _placed(rows, "id", "digest")
    steps = climb(placed, bits)

    roots = steps[0].where("top")
    for step in steps[1:]:
        roots = roots.unionByName(step.where("top"))
    tops = roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    named = _placed(tops.withColumns({"id": F.lit(None).cast("long"), "altered": F.lit(None).cast("binary")}), "name")
    above = climb(named, bits)
    names = named.select("place", "name").rdd.map(lambda r: (r[0], ("name", r[1])))
    whole = above[-1].where("top").select("digest").rdd.map(lambda r: ("", ((bytes(r[0]),), [])))
    down = descend(above, whole, bits).map(lambda v: (v[1], ("way", v[3], v[5])))

    def entry(item):
        got = {m[0]: m for m in item[1]}
        _, digest, (top, way) = got["way"]
        return got["name"][1], ((digest, *top), way)

    entries = names.union(down).groupByKey().map(entry)

    def verified(v):
        _, _, row_id, digest, changed, ((subroot, root), way) = v
        folded = fold(digest if changed is None else bytes(changed), way)
        proof = sha256("".join(other.hex() for side, other in way if side != ALONE).encode()).hexdigest()
        return row_id, digest.hex(), subroot.hex(), root.hex(), proof, folded.hex(), folded == root

    schema = f"`{id_col}` long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return spark.createDataFrame(descend(steps, entries, bits).map(verified), schema, verifySchema=False)


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``place`` within ``grp`` and whether it is the ``last`` one."""
    local = numbered(rows, "grp", *order)
    carry = settle(carried(local, "grp").select("_part", "grp", "_before", "_more"))
    both = joined(local, carry, "grp", "_before", "_more")
    last = F.col("_ends") & ~F.coalesce(F.when(F.col("_edge").bitwiseAND(2) > 0, F.col("_more")), F.lit(False))
    return both.withColumns({"place": F.col("_place") + F.coalesce("_before", F.lit(0)), "last": last})
