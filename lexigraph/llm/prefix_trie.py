"""Prefix trie of conversations: what a cache of shared beginnings would hold and save.

1. Each distinct turn gets a number (dictionary encoding); texts never travel beyond that step.
   Turns are joined to their numbers with very common turns spread over tasks.
2. A conversation is the row of its turn numbers. Equal rows are counted once, with their
   members' smallest identifier and a digest of all of them.
3. The distinct rows are range-partitioned by their numbers. Each shard puts its rows into a
   ternary search tree, medians first, so that the links among siblings stay balanced. A tree node
   is a trie node: the prefix that ends there. An iterative walk lists the nodes in order, and the
   way back adds up members, leaves and savings of each subtree.
4. Only prefixes of a shard's first or last row can also occur in another shard. These boundary
   nodes, two paths for each shard, are merged in order of the shards by a single pass that
   keeps one open path; all other nodes are final where they were built.

A row holds a conversation's turn numbers, eight bytes for each turn. A shard holds about
``SHARD_TURNS`` numbers, whatever its rows have in common: a prefix shared by many is divided
like any other range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_keys, spread_join
from .common import WORD, running_sums, shuffle_partitions, space

#: Turn numbers in one shard, about.
SHARD_TURNS = 500_000
#: A range of identifiers that are joined to one text before they are hashed in order. An Arrow
#: batch holds ten thousand such texts.
MEMBERS_PER_BLOCK = 500
BATCH = 4096
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()

NODE = (
    "conv_id BIGINT, depth BIGINT, parent_conv_id BIGINT, n_convs BIGINT, n_children BIGINT, "
    "n_leaves BIGINT, saved_tokens BIGINT, ends_sha256 STRING"
)
#: What a shard says about a node: final rows have no ``at``; ``parent_at`` names a boundary parent.
PARTIAL = f"shard BIGINT, at BIGINT, parent_at BIGINT, turn_id BIGINT, words BIGINT, {NODE}"


def encode_turns(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``conv_id, turns``: every conversation's turns in order, as ``array<struct<id, words>>``.

    Order is by ``turn``, null first; turns of equal number by a digest of role and text. Null
    role or text counts as empty. Rows without ``conv_id`` belong to no conversation and are left
    out. Repeated rows are turns of their own. Other columns are not read.
    """
    work = space(turns.sparkSession, "prefix_trie")
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # The role's length in front keeps different pairs different.
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        digest.alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    rows = work.write(rows, "turns")
    known = rows.groupBy("digest").agg(F.count("*").alias("uses"), F.first("words").alias("words"))
    known = work.write(known.withColumn("one", F.lit(1).cast("bigint")), "distinct")
    numbers = running_sums(known, [F.col("digest")], {"id": "one"}, work).select("digest", "id", "uses")
    numbers = work.write(numbers, "dictionary")
    encoded = spread_join(rows, numbers.select("digest", "id"), "digest", "conv_id", hot_keys(numbers, "digest", "uses"))
    ordered = F.array_sort(F.collect_list(F.struct(_null_first("turn"), "id", "words")))
    return encoded.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns")
    )


def _null_first(column: str) -> Column:
    return F.struct(F.col(column).isNotNull().alias("known"), F.col(column).alias("value")).alias("place")


def with_borrowed_heads(encoded: DataFrame, head: Column, source: Column, most: int) -> DataFrame:
    """Conversations whose first ``head`` turns are those of conversation ``source``.

    All of the source's turns if it has fewer, none if it is absent; at most ``most``. A
    conversation keeps its own turns from ``head`` on. At most twice as many conversations as the
    step between sources share one, so no source is hot.
    """
    work = space(encoded.sparkSession, "borrowed_heads")
    encoded = work.write(encoded, "encoded")
    heads = encoded.select(F.col("conv_id").alias("source"), F.slice("turns", 1, most).alias("heads"))
    wanted = encoded.select("conv_id", "turns", head.alias("head"), source.alias("source"))
    none = F.array().cast(encoded.schema["turns"].dataType)
    own = F.when(F.size("turns") > F.col("head"), F.expr("slice(turns, head + 1, size(turns))")).otherwise(none)
    borrowed = F.expr("slice(heads, 1, head)")
    return wanted.join(heads, "source", "left").select("conv_id", F.concat(F.coalesce(borrowed, none), own).alias("turns"))


def _digests(members: DataFrame) -> DataFrame:
    """``key, ends_sha256``: digest of each row's members, ascending, with commas between.

    SHA-256 runs through its input in order, so one task sees all members of a row, as a stream
    of blocks that were sorted and joined elsewhere. It holds one block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if state:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if len(done) >= BATCH:
                yield _rows(done, ["key", "ends_sha256"])
                done = []
        if state:
            done.append((key, state.hexdigest()))
        if done:
            yield _rows(done, ["key", "ends_sha256"])

    blocks = members.groupBy("key", F.floor(F.col("conv_id") / MEMBERS_PER_BLOCK).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    streamed = blocks.repartition(shuffle_partitions(members.sparkSession), "key").sortWithinPartitions("key", "block").select("key", "ids")
    return streamed.mapInArrow(run, "key STRING, ends_sha256 STRING")


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names)


class TernaryTree:
    """Trie of sorted distinct rows; node 0 is the root, its children hang under ``eq[0]``.

    A node's siblings form a binary search tree by ``lo`` and ``hi``; ``eq`` leads to its children.
    Nodes are made from the root outwards, so a node's trie parent has a smaller number.
    """

    def __init__(self) -> None:
        self.turn, self.words, self.parent = [-1], [0], [-1]
        self.lo, self.eq, self.hi = [-1], [-1], [-1]

    def _new(self, turn: int, words: int, parent: int) -> int:
        for column, value in ((self.turn, turn), (self.words, words), (self.parent, parent), (self.lo, -1), (self.eq, -1), (self.hi, -1)):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, ids: list[int], words: list[int]) -> int:
        """The node of a row, made if it is not there."""
        node = 0
        for turn, size in zip(ids, words):
            at = self.eq[node]
            if at < 0:
                at = self.eq[node] = self._new(turn, size, node)
            while turn != self.turn[at]:
                links = self.lo if turn < self.turn[at] else self.hi
                if links[at] < 0:
                    links[at] = self._new(turn, size, node)
                at = links[at]
            node = at
        return node

    def insert_balanced(self, rows: list[tuple[list[int], list[int]]]) -> list[int]:
        """Nodes of sorted ``rows``, which are put in median first, then both halves likewise."""
        nodes, ranges = [0] * len(rows), [(0, len(rows))]
        while ranges:
            start, end = ranges.pop()
            if start < end:
                middle = (start + end) // 2
                nodes[middle] = self.insert(*rows[middle])
                ranges += [(middle + 1, end), (start, middle)]
        return nodes

    def in_order(self) -> list[int]:
        """All nodes, each before its children, siblings ascending; no recursion."""
        order, todo = [], [(0, False)]
        while todo:
            node, seen = todo.pop()
            if not seen:
                if self.hi[node] >= 0:
                    todo.append((self.hi[node], False))
                todo.append((node, True))
                if self.lo[node] >= 0:
                    todo.append((self.lo[node], False))
            else:
                order.append(node)
                if self.eq[node] >= 0:
                    todo.append((self.eq[node], False))
        return order


def shard_nodes(shard: int, rows: list[tuple[list[int], list[int], int, int, str]]) -> Iterator[tuple]:
    """Rows of ``PARTIAL`` for a shard's sorted ``(ids, words, members, smallest member, digest)``."""
    tree = TernaryTree()
    nodes = tree.insert_balanced([(ids, words) for ids, words, *_ in rows])
    n = len(tree.turn)
    members, smallest, ends = [0] * n, [None] * n, [EMPTY_DIGEST] * n
    children, leaves, saved, depth = [0] * n, [0] * n, [0] * n, [0] * n
    for node, (_, _, count, first, digest) in zip(nodes, rows):
        members[node], smallest[node], ends[node] = count, first, digest
    boundary = set()
    for node in (nodes[0], nodes[-1]):
        while node >= 0:
            boundary.add(node)
            node = tree.parent[node]
    order = tree.in_order()
    for node in order[1:]:
        depth[node] = depth[tree.parent[node]] + 1
    for node in reversed(order):
        if node not in boundary:
            # All of its subtree is in this shard.
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * tree.words[node]
        up = tree.parent[node]
        if up >= 0:
            members[up] += members[node]
            smallest[up] = smallest[node] if smallest[up] is None else min(smallest[up], smallest[node])
            # Boundary children are counted, and their subtrees added, when shards are merged.
            if node not in boundary:
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]
    place = {node: at for at, node in enumerate(order) if node in boundary}
    for node in order:
        up = tree.parent[node]
        above = None if node in boundary else place.get(up)
        parent = None if node in boundary or above is not None else smallest[up]
        yield (
            shard, place.get(node), above, tree.turn[node], tree.words[node], smallest[node], depth[node], parent,
            members[node], children[node], leaves[node], saved[node], ends[node],
        )


@dataclass
class _Open:
    """A boundary node while later shards may still add to it."""

    turn: int
    words: int
    conv_id: int
    depth: int
    members: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str = EMPTY_DIGEST
    refs: list[tuple[int, int]] = field(default_factory=list)
    waiting: list[tuple] = field(default_factory=list)


def merge_boundary(partials: Iterator[dict]) -> Iterator[tuple]:
    """``(shard, at, row)`` for every partial node, given by shard and place within it.

    The first partial node of each carries the final ``row``, the others its ``conv_id`` only.
    Partial nodes come in order, so all that can still grow are on one open path. A closed node
    waits at its parent until the parent's smallest member is known.
    """
    path: list[_Open] = []

    def close() -> Iterator[tuple]:
        node = path.pop()
        node.leaves += not node.children
        node.saved += (node.members - 1) * node.words
        for shard, at, row in node.waiting:
            yield shard, at, (*row[:2], node.conv_id, *row[3:])
        row = (node.conv_id, node.depth, None, node.members, node.children, node.leaves, node.saved, node.ends)
        if path:
            up = path[-1]
            up.children += 1
            up.leaves += node.leaves
            up.saved += node.saved
            up.waiting.append((*node.refs[0], row))
        else:
            yield *node.refs[0], row
        for shard, at in node.refs[1:]:
            yield shard, at, (node.conv_id, None, None, None, None, None, None, None)

    for p in partials:
        depth = p["depth"]
        # The node is still open if an earlier shard ended below it; what hangs there may go on too.
        if len(path) > depth and path[depth].turn != p["turn_id"]:
            while len(path) > depth:
                yield from close()
        if len(path) == depth:
            path.append(_Open(p["turn_id"], p["words"], p["conv_id"], depth))
        node = path[depth]
        node.conv_id = min(node.conv_id, p["conv_id"])
        node.members += p["n_convs"]
        node.children += p["n_children"]
        node.leaves += p["n_leaves"]
        node.saved += p["saved_tokens"]
        if p["ends_sha256"] != EMPTY_DIGEST:
            node.ends = p["ends_sha256"]
        node.refs.append((p["shard"], p["at"]))
    while path:
        yield from close()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"BIGINT": pa.int64(), "STRING": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def prefix_trie(encoded: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each distinct prefix of ``encoded(conv_id, turns)``, the empty one included.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``
    (members: conversations that begin with it), ``n_children``, ``n_leaves`` (childless nodes of
    its subtree), ``saved_tokens`` (over its subtree, words of a node's last turn for every member
    but one) and ``ends_sha256`` of the members that end there.

    Conversations without turns are members of the root. ``conv_id`` is unique, as it comes out of
    ``encode_turns``. No conversation, no rows.
    """
    spark = encoded.sparkSession
    work = space(spark, "prefix_trie")
    keyed = encoded.select(
        "conv_id",
        F.col("turns.id").alias("ids"),
        F.col("turns.words").alias("words"),
        F.sha2(F.array_join(F.col("turns.id").cast("array<string>"), ","), 256).alias("key"),
    )
    keyed = work.write(keyed, "conversations")
    digests = _digests(keyed.select("key", "conv_id"))
    counted = keyed.groupBy("key").agg(
        F.count("*").alias("members"), F.min("conv_id").alias("smallest"), F.first("ids").alias("ids"), F.first("words").alias("words")
    )
    distinct = work.write(counted.join(digests, "key").drop("key"), "distinct")
    n_turns = distinct.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-n_turns // shard_turns))
    partial, node = _arrow(PARTIAL), _arrow(NODE)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
        if rows:
            yield from _batches(shard_nodes(TaskContext.get().partitionId(), rows), partial)

    ordered = distinct.repartitionByRange(shards, "ids").sortWithinPartitions("ids")
    ordered = ordered.select("ids", "words", "members", "smallest", "ends_sha256")
    nodes = work.write(ordered.mapInArrow(build, PARTIAL), "nodes")

    merged = pa.schema([("shard", pa.int64()), ("at", pa.int64()), *node])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = merge_boundary(r for batch in batches for r in batch.to_pylist())
        yield from _batches(((shard, at, *row) for shard, at, row in rows), merged)

    # Two paths for each shard: bounded by the number of shards and the longest conversation.
    boundary = nodes.filter("at IS NOT NULL").repartition(1).sortWithinPartitions("shard", "at")
    done = work.write(boundary.mapInArrow(merge, f"shard BIGINT, at BIGINT, {NODE}"), "boundary")
    columns = [c.split()[0] for c in NODE.split(", ")]
    names = done.select("shard", F.col("at").alias("parent_at"), F.col("conv_id").alias("above"))
    inner = nodes.filter("at IS NULL").join(names, ["shard", "parent_at"], "left")
    inner = inner.withColumn("parent_conv_id", F.coalesce("above", "parent_conv_id"))
    return inner.select(*columns).unionByName(done.filter("depth IS NOT NULL").select(*columns))


def shared_prefixes(turns: DataFrame, head: Column | None = None, source: Column | None = None, most: int = 0) -> DataFrame:
    """The trie of ``turns(conv_id, turn, role, text)``, with borrowed heads if ``head`` is given."""
    encoded = encode_turns(turns)
    if head is not None:
        encoded = with_borrowed_heads(encoded, head, source, most)
    return prefix_trie(encoded)
