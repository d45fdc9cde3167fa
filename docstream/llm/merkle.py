"""Merkle manifest of a dataset: one tree for each group of rows, and one over the groups.

A leaf is the SHA-256 of a row's fields. Within a group leaves stand in the order of their keys; as long as a group has
several nodes, each run of ``ARITY`` becomes the hash of its members' hex digests (the last run may be shorter, down to
one). What remains is the group's subroot; subroots, in the order of group names, make the root in the same way.

*Midstates*: a parent keeps a copy of its hash state before each child. To fold another leaf up to the root, the state
before its place is taken up again and is given the replacement and the siblings to the right; siblings to the left
are not hashed again.

On Spark: rows are ranked by a range partitioning and the counts of its parts, so a group that holds most rows is
spread over many tasks. ``CHUNK`` leaves in a row make a chunk, a whole part of the tree that a task works out alone;
the tops of chunks are the nodes of the next round. Then paths go down again, from the root to the chunks, by joins
on (group, chunk), which no two rows share. A chunk makes the states of the path above it once for all its leaves.

A null group is one of its own and comes first, a null key comes before others, equal keys go by leaf, and equal rows
are interchangeable. Null fields count as ``-``; empty and very long values are hashed whole; a lone leaf is its own
subroot, a lone subroot the root; an empty table gives an empty result. Only the columns named are looked at, under
names of the module's own, so others can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docstream.llm.dealing import saved
from docstream.llm.shipping import ship

ARITY, LEVELS = 3, 6
#: Leaves of a chunk.
CHUNK = ARITY**LEVELS

_PACKED = "g string, chunk long, n long, keys array<long>, nodes array<string>, others array<string>, top string"
_PATH = "left array<string>, right array<string>, subroot string, root string"


def leaf(columns: Sequence[Column | str]) -> Column:
    """The hash of a row: each field as its length in bytes, a colon and its value, or ``-``."""
    told = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in told)), 256)


def levels_of(n: int) -> int:
    """How many times a group of ``n`` nodes is shortened until one remains."""
    found = 0
    while n > 1:
        n, found = -(-n // ARITY), found + 1
    return found


class Part:
    """A whole part of a tree: its nodes, level by level, and the states that parents keep."""

    def __init__(self, nodes: list[str], levels: int):
        self.tiers = [[node.encode() for node in nodes]]
        self.states: list[list[list]] = []
        for _ in range(levels):
            above, kept = [], []
            for at in range(0, len(self.tiers[-1]), ARITY):
                state, before = hashlib.sha256(), []
                for child in self.tiers[-1][at : at + ARITY]:
                    before.append(state.copy())
                    state.update(child)
                kept.append(before)
                above.append(state.hexdigest().encode())
            self.tiers.append(above)
            self.states.append(kept)

    def top(self) -> str:
        return self.tiers[-1][0].decode()

    def siblings(self, place: int) -> Iterator[tuple[bytes, bytes]]:
        """Those to the left and to the right of the path from ``place``, level by level."""
        for tier in self.tiers[:-1]:
            first = place - place % ARITY
            yield b"".join(tier[first:place]), b"".join(tier[place + 1 : first + ARITY])
            place //= ARITY

    def fold(self, place: int, node: bytes) -> bytes:
        """The top with ``node`` at ``place``, by taking up the states before its path."""
        for tier, states in zip(self.tiers, self.states, strict=False):
            slot = place % ARITY
            node = resumed(states[place // ARITY][slot], node, b"".join(tier[place + 1 : place - slot + ARITY]))
            place //= ARITY
        return node


def resumed(state, node: bytes, right: bytes) -> bytes:
    """The digest of a parent whose hash state before ``node`` is kept."""
    state = state.copy()
    state.update(node)
    state.update(right)
    return state.hexdigest().encode()


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``rank`` within their ``g``, from 0 in the given order, and ``n``, the rows of ``g``; saved."""
    names = rows.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for g in batch.column(names.index("g")).to_pylist():
                last, count = (last, count + 1) if g == last else (g, 0)
                places.append(count)
            yield pa.record_batch([*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())], names=[*names, "part", "place"])

    # Equal rows have equal places to go to: their place in the saved table deals them to several tasks.
    dealt = rows.withColumn("row", F.monotonically_increasing_id())
    in_order = dealt.repartitionByRange("g", *order, "row").sortWithinPartitions("g", *order, "row").drop("row")
    placed = saved(in_order.mapInArrow(number, f"{schema}, part int, place long"), "placed")
    counts = placed.groupBy("g", "part").agg(F.count("*").alias("size"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("g", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"), F.sum("size").over(whole).alias("n"))
    return placed.join(starts, ["g", "part"]).select(*names, (F.col("start") + F.col("place")).alias("rank"), "n")


def chunks(rows: DataFrame, done: int) -> DataFrame:
    """``rows`` (g, rank, n, key, node, other), which stand ``done`` levels above the leaves, as packed chunks with their tops."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(name: tuple, held: list[tuple]) -> tuple:
            keys, nodes, others = ([row[k] for row in held] for k in range(3))
            top = Part(nodes, min(LEVELS, max(0, levels_of(name[2]) - done))).top()
            return (*name, keys, nodes, others, top)

        name, held, found = None, [], []
        for batch in batches:
            for g, chunk, n, key, node, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != (g, chunk, n):
                    if held:
                        found.append(packed(name, held))
                    name, held = (g, chunk, n), []
                held.append((key, node, other))
            while len(found) >= 64:
                yield batch_of(found[:64], _PACKED_ARROW)
                found = found[64:]
        if held:
            found.append(packed(name, held))
        if found:
            yield batch_of(found, _PACKED_ARROW)

    near = rows.withColumn("chunk", F.floor(F.col("rank") / F.lit(CHUNK)).cast("long"))
    near = near.repartition("g", "chunk").sortWithinPartitions("g", "chunk", "rank")
    return saved(near.select("g", "chunk", "n", "key", "node", "other").mapInArrow(pack, _PACKED), "chunks")


_PACKED_ARROW = pa.schema(
    [("g", pa.string()), ("chunk", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("nodes", pa.list_(pa.string())), ("others", pa.list_(pa.string())), ("top", pa.string())]
)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def rounds(rows: DataFrame) -> list[DataFrame]:
    """Chunks of ``rows`` (g, rank, n, key, node, other), chunks of their tops, and so on until each group has one."""
    most = rows.agg(F.max("n")).first()[0] or 0
    found = [chunks(rows, 0)]
    while len(found) * LEVELS < levels_of(most):
        tops = found[-1].select("g", F.col("chunk").alias("rank"), "n", F.lit(None).cast("long").alias("key"), F.col("top").alias("node"), F.lit(None).cast("string").alias("other"))
        found.append(chunks(tops, len(found) * LEVELS))
    return found


def paths(packed: DataFrame, above: DataFrame, done: int) -> DataFrame:
    """(g, chunk, path) of each node of ``packed`` by the paths of its chunks (g, chunk, path); saved."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, chunk, n, nodes, left, right, subroot, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = Part(nodes, min(LEVELS, max(0, levels_of(n) - done)))
                found = []
                for place in range(len(nodes)):
                    own = list(part.siblings(place))
                    found.append((g, chunk * CHUNK + place, [a.decode() for a, _ in own] + left, [b.decode() for _, b in own] + right, subroot, root))
                yield batch_of(found, _PATH_ARROW)

    rows = packed.join(above, ["g", "chunk"]).select("g", "chunk", "n", "nodes", "left", "right", "subroot", "root")
    return saved(rows.mapInArrow(work, f"g string, chunk long, {_PATH}"), "paths")


_PATH_ARROW = pa.schema([("g", pa.string()), ("chunk", pa.int64()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string())), ("subroot", pa.string()), ("root", pa.string())])


def folded(packed: DataFrame, above: DataFrame) -> DataFrame:
    """Each leaf of ``packed`` with its proof and the root that its other leaf, or itself, leads to."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, keys, nodes, others, left, right, subroot, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = Part(nodes, min(LEVELS, levels_of(n)))
                # The states of the parents above, before this chunk's place in them.
                upper = [(hashlib.sha256(a.encode()), b.encode()) for a, b in zip(left, right, strict=True)]
                beside = "".join(a + b for a, b in zip(left, right, strict=True)).encode()
                found = []
                for place, (key, node, other) in enumerate(zip(keys, nodes, others, strict=True)):
                    proof = hashlib.sha256(b"".join(a + b for a, b in part.siblings(place)) + beside).hexdigest()
                    end = part.fold(place, (other or node).encode())
                    for state, rest in upper:
                        end = resumed(state, end, rest)
                    found.append((key, node, subroot, root, proof, end.decode()))
                yield batch_of(found, _FOLDED_ARROW)

    rows = packed.join(above, ["g", "chunk"]).select("n", "keys", "nodes", "others", "left", "right", "subroot", "root")
    return rows.mapInArrow(work, "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


_FOLDED_ARROW = pa.schema([("key", pa.int64()), *((name, pa.string()) for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root"))])


def _down(tree: list[DataFrame], above: DataFrame) -> DataFrame:
    """The paths of the chunks of the lowest round."""
    for level in range(len(tree) - 1, 0, -1):
        above = paths(tree[level], above, level * LEVELS)
    return above


def manifest(rows: DataFrame, group: Column | str, key: Column | str, own: Column | str, other: Column | str | None = None) -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root`` of each row.

    ``own`` is the leaf of a row (see ``leaf``), ``other`` one that is folded up in its place; null: its own.
    """
    ship(rows.sparkSession)
    column = lambda c: F.col(c) if isinstance(c, str) else c
    named = F.coalesce(F.concat(F.lit("="), column(group).cast("string")), F.lit(""))
    instead = F.lit(None).cast("string") if other is None else column(other)
    leaves = saved(rows.select(named.alias("g"), column(key).cast("long").alias("key"), column(own).alias("node"), instead.alias("other")), "leaves")
    trees = rounds(ranked(leaves, "key", "node"))
    subroots = trees[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), F.lit(None).cast("long").alias("key"), F.col("top").alias("node"), F.lit(None).cast("string").alias("other"))
    places = saved(ranked(subroots, "name"), "subroots")
    crown = rounds(places.drop("name"))
    none = F.array().cast("array<string>")
    above = crown[-1].select("g", "chunk", none.alias("left"), none.alias("right"), F.lit("").alias("subroot"), F.col("top").alias("root"))
    # One more step down: from the chunks of the crown to each subroot.
    crowned = paths(crown[0], _down(crown, above), 0).drop("g", "subroot").withColumnRenamed("chunk", "rank")
    named_paths = places.join(crowned, "rank").select(F.col("name").alias("g"), F.lit(0).cast("long").alias("chunk"), "left", "right", F.col("node").alias("subroot"), "root")
    return folded(trees[0], _down(trees, named_paths))
