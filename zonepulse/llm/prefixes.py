"""Conversations as a prefix trie, built from adaptive radix trees over turn ids.

A turn's id is the MD5 of its role and text, 16 big-endian bytes, so a conversation is the key of
its turns' ids. Copies are one key. Keys are sorted over the cluster and cut into blocks; each
block is a radix tree of its own, whose nodes grow from 4 to 16, 48 and 256 children and keep
the bytes that all keys below share as one path. Walking a tree gives a trie node at every depth
that is a whole number of turns, also inside a path.

A trie node is finished in its block unless the block's first or last key runs through it. Those
few go to one task as partial sums, one path per block edge, where neighbouring blocks meet on a
stack; rows and keys never do.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonepulse.llm.common import table
from zonepulse.session import stash

#: Bytes of a turn id.
WIDTH = 16
#: Keys per radix tree: what a task holds at once.
BLOCK = 50_000
#: Members of a key are joined in runs of conv_ids this wide before they are hashed in order.
RUN = 4_096
EMPTY = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"


# --- keys -------------------------------------------------------------------------------------


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes, as hex, that tell (role, text) apart; the role's length keeps the border between them."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def taken(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its twenty."""
    return F.crc32(conv.cast("string").cast("binary")) % 4


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): ids and words of a conversation's turns in their order, null turns first.

    A null role or text is empty; turns of one number come in the order of their ids, so repeated
    rows stay and the order of rows does not matter. Rows without conv_id belong to no
    conversation. Texts are not moved: only their ids and numbers of words are.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turn = F.struct(
        F.col("turn").isNotNull().alias("placed"), F.col("turn").cast("long").alias("turn"), turn_id(role, text).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    slim = turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn")).where("conv_id IS NOT NULL")
    ordered = F.array_sort(F.collect_list("turn"))
    return slim.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """(conv_id, turns): the first turns of the first conversation of each twenty, then a conversation's own."""
    head = taken(F.col("conv_id")).cast("int")
    first = F.col("conv_id") - F.col("conv_id") % 20
    givers = convs.where("conv_id % 20 = 0").select(F.col("conv_id").alias("first"), F.slice("turns", 1, 3).alias("given"))
    both = convs.withColumn("first", first).join(givers, "first", "left")
    given = F.coalesce(F.slice("given", F.lit(1), head), F.slice("turns", 1, 0))
    own = F.slice("turns", head + 1, F.greatest(F.size("turns") - head, F.lit(0)))
    return both.select("conv_id", F.concat(given, own).alias("turns"))


def distinct_keys(convs: DataFrame) -> DataFrame:
    """(key, words, n, conv_id, ends): each different conversation once.

    `conv_id` is the smallest of its n members and `ends` the SHA-256 of them all, ascending and
    comma-joined. A key that very many share is first summed in each run of conv_ids, so no group
    has more than `RUN` distinct ones; its runs are then hashed in order, as a stream.
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    slim = convs.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))
    slim = slim.withColumns({"digest": F.md5("key"), "run": F.floor(F.col("conv_id") / RUN)})
    runs = slim.groupBy("digest", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.array_sort(F.collect_list("conv_id")).alias("members"),
        F.first("key").alias("key"), F.first("words").alias("words"),
    )

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, open_, state = [], None, None
        for batch in batches:
            for row in batch.to_pylist():
                members = ",".join(map(str, row["members"])).encode()
                if open_ is not None and open_["digest"] == row["digest"]:
                    open_["n"] += row["n"]
                    state.update(b"," + members)
                    continue
                if open_ is not None:
                    rows.append({**open_, "ends": state.hexdigest()})
                open_, state = row, hashlib.sha256(members)
                if len(rows) == 1_000:
                    yield _batch(rows, _KEYS)
                    rows = []
        if open_ is not None:
            yield _batch([*rows, {**open_, "ends": state.hexdigest()}], _KEYS)

    ordered = runs.repartition("digest").sortWithinPartitions("digest", "run")
    return ordered.mapInArrow(joined, "key binary, words array<long>, n long, conv_id long, ends string")


_KEYS = pa.schema([("key", pa.binary()), ("words", pa.list_(pa.int64())), ("n", pa.int64()), ("conv_id", pa.int64()), ("ends", pa.string())])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{name: row.get(name) for name in schema.names} for row in rows], schema)


# --- adaptive radix tree ----------------------------------------------------------------------


class Node:
    """Bytes shared by all keys below, the value of the key that ends here, and children by byte.

    Up to 4 and up to 16 children: two lists sorted by byte. Up to 48: 256 places that point into
    a list of children. Beyond: 256 children.
    """

    __slots__ = ("path", "value", "size", "bytes", "children")

    def __init__(self, path: bytes, value: object = None):
        self.path, self.value, self.size = path, value, 4
        self.bytes, self.children = bytearray(), []

    def find(self, byte: int) -> Node | None:
        if self.size <= 16:
            at = bisect_left(self.bytes, byte)
            return self.children[at] if at < len(self.bytes) and self.bytes[at] == byte else None
        if self.size == 48:
            at = self.bytes[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        """Sets a byte's child; a node that is full takes the next layout first."""
        if self.size <= 16:
            at = bisect_left(self.bytes, byte)
            if at < len(self.bytes) and self.bytes[at] == byte:
                self.children[at] = child
                return
            if len(self.bytes) < self.size:
                self.bytes.insert(at, byte)
                self.children.insert(at, child)
                return
            if self.size == 4:
                self.size = 16
            else:
                places = bytearray(256)
                for n, b in enumerate(self.bytes):
                    places[b] = n + 1
                self.size, self.bytes = 48, places
            self.put(byte, child)
        elif self.size == 48:
            if self.bytes[byte]:
                self.children[self.bytes[byte] - 1] = child
            elif len(self.children) < 48:
                self.children.append(child)
                self.bytes[byte] = len(self.children)
            else:
                self.children = [self.children[at - 1] if at else None for at in self.bytes]
                self.size, self.bytes = 256, bytearray()
                self.children[byte] = child
        else:
            self.children[byte] = child

    def below(self) -> list[Node]:
        """Children in the order of their bytes."""
        if self.size <= 16:
            return self.children
        if self.size == 48:
            return [self.children[at - 1] for at in self.bytes if at]
        return [child for child in self.children if child is not None]


class RadixTree:
    """Keys of bytes with values; a node's path does not hold the byte its parent finds it by."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value: object) -> None:
        if self.root is None:
            self.root = Node(key, value)
            return
        node, above, by, at = self.root, None, 0, 0
        while True:
            path = node.path
            if not key.startswith(path, at):
                same = next((n for n, (x, y) in enumerate(zip(path, key[at:])) if x != y), min(len(path), len(key) - at))
                # The path splits: a new node takes the shared bytes.
                upper = Node(path[:same])
                upper.put(path[same], node)
                node.path = path[same + 1 :]
                if above is None:
                    self.root = upper
                else:
                    above.put(by, upper)
                node, path = upper, upper.path
            at += len(path)
            if at == len(key):
                node.value = value
                return
            child = node.find(key[at])
            if child is None:
                node.put(key[at], Node(key[at + 1 :], value))
                return
            node, above, by, at = child, node, key[at], at + 1

    def walk(self) -> Iterator[tuple[int, int, Node]]:
        """(bytes above, bytes with its path, node) in key order; afterwards (…, -1, node) when it is left."""
        if self.root is None:
            return
        open_ = [(0, 0, self.root, False)]
        while open_:
            before, skip, node, done = open_.pop()
            after = before + skip + len(node.path)
            if done:
                yield before, -1, node
                continue
            yield before, after, node
            open_.append((before, skip, node, True))
            open_.extend((after, 1, child, False) for child in reversed(node.below()))


# --- trie nodes -------------------------------------------------------------------------------


class Open:
    """A trie node whose subtree is being summed up."""

    __slots__ = ("id", "depth", "n", "conv_id", "children", "leaves", "saved", "words", "ends", "first", "number", "waiting")

    def __init__(self, id_: bytes, depth: int, first: bool = False):
        self.id, self.depth, self.first = id_, depth, first
        self.n = self.children = self.leaves = self.saved = self.words = self.number = 0
        self.conv_id: int | None = None
        self.ends: str | None = None
        self.waiting: list[dict] = []

    def finish(self) -> dict:
        """The node's row, without its parent; leaves and saved tokens then cover the whole subtree."""
        self.leaves += not self.children
        self.saved += (self.n - 1) * self.words
        return {
            "conv_id": self.conv_id, "depth": self.depth, "n_convs": self.n, "n_children": self.children,
            "n_leaves": self.leaves, "saved_tokens": self.saved, "ends_sha256": self.ends,
        }


_NODES = pa.schema(
    [
        ("kind", pa.string()), ("part", pa.int32()), ("block", pa.int32()), ("side", pa.int32()), ("depth", pa.int64()),
        ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("words", pa.int64()), ("ends_sha256", pa.string()), ("id", pa.binary()),
    ]
)
_NODES_DDL = (
    "kind string, part int, block int, side int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, words long, ends_sha256 string, id binary"
)


def block_nodes(keys: list[dict], width: int = WIDTH) -> Iterator[dict]:
    """Trie nodes of one block of keys.

    kind: `whole` for a finished node with its parent; `under` for a finished one whose parent,
    at `depth` - 1 on the path of the block's first (side 0) or last key (side 1), is not; `edge`
    for the partial sums of the nodes on those two paths, in key order.
    """
    tree = RadixTree()
    for row in keys:
        tree.insert(row["key"], row)
    stack: list[Open] = []
    left, seen, words = len(keys), 0, []

    def close(to: int) -> Iterator[dict]:
        while len(stack) > to:
            node = stack.pop()
            node.words = words[node.depth - 1] if node.depth else 0
            above = stack[-1] if stack else None
            if above is not None:
                above.n += node.n
                above.conv_id = node.conv_id if above.conv_id is None else min(above.conv_id, node.conv_id)
            if node.first or not left:
                # On the first or the last key's path: the smaller side where it is on both.
                side = 0 if node.first else 1
                yield from ({"kind": "under", "side": side, **row} for row in node.waiting)
                yield {
                    "kind": "edge", "side": side, "depth": node.depth, "conv_id": node.conv_id, "n_convs": node.n, "n_children": node.children,
                    "n_leaves": node.leaves, "saved_tokens": node.saved, "words": node.words, "ends_sha256": node.ends, "id": node.id,
                }
            else:
                row = node.finish()
                above.children, above.leaves, above.saved = above.children + 1, above.leaves + node.leaves, above.saved + node.saved
                above.waiting.append(row)
                yield from ({"kind": "whole", "parent_conv_id": node.conv_id, **below} for below in node.waiting)

    for before, after, node in tree.walk():
        if after < 0:
            yield from close(0 if node is tree.root else before // width + 1)
            continue
        # Any key below has the bytes of the turns that end here.
        depths = range(0 if node is tree.root else before // width + 1, after // width + 1)
        some = node
        while depths and some.value is None:
            some = some.below()[0]
        for depth in depths:
            stack.append(Open(some.value["key"][(depth - 1) * width : depth * width] if depth else b"", depth, not seen))
        if node.value is not None:
            row, top = node.value, stack[-1]
            top.n += row["n"]
            top.conv_id = row["conv_id"] if top.conv_id is None else min(top.conv_id, row["conv_id"])
            top.ends, words = row["ends"], row["words"]
            seen, left = seen + 1, left - 1


def blocks(keys: DataFrame, size: int = BLOCK) -> DataFrame:
    """Trie nodes of all blocks; (part, block) is the order of the blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        keys: list[dict] = []

        def nodes() -> Iterator[pa.RecordBatch]:
            rows = []
            for row in block_nodes(keys):
                rows.append({**row, "part": part, "block": block})
                if len(rows) == 5_000:
                    yield _batch(rows, _NODES)
                    rows = []
            if rows:
                yield _batch(rows, _NODES)

        for batch in batches:
            for row in batch.to_pylist():
                keys.append(row)
                if len(keys) == size:
                    yield from nodes()
                    keys, block = [], block + 1
        if keys:
            yield from nodes()

    return keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, _NODES_DDL)


_MERGED = pa.schema(
    [
        ("number", pa.int64()), ("parent", pa.int64()), ("part", pa.int32()), ("block", pa.int32()), ("side", pa.int32()), ("depth", pa.int64()),
        ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ]
)
_MERGED_DDL = (
    "number long, parent long, part int, block int, side int, depth long, conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


def merge_edges(rows: Iterable[dict]) -> Iterator[dict]:
    """Joins the edge paths of neighbouring blocks, given in the order of blocks, sides and depths.

    The stack holds the path of the last key so far. Rows with n_convs are finished nodes, each
    with its own number and its parent's; the others say which number a block's edge node has.
    """
    stack: list[Open] = []
    numbers = 0

    def close(to: int) -> Iterator[dict]:
        while len(stack) > to:
            node = stack.pop()
            row = node.finish()
            if stack:
                above = stack[-1]
                above.children, above.leaves, above.saved = above.children + 1, above.leaves + node.leaves, above.saved + node.saved
            yield {**row, "number": node.number, "parent": stack[-1].number if stack else None}

    for row in rows:
        depth = row["depth"]
        if depth >= len(stack) or stack[depth].id != row["id"] or row["side"]:
            yield from close(depth)
            node = Open(row["id"], depth)
            node.number, numbers = numbers, numbers + 1
            stack.append(node)
        node = stack[depth]
        node.n += row["n_convs"]
        node.conv_id = row["conv_id"] if node.conv_id is None else min(node.conv_id, row["conv_id"])
        node.children, node.leaves, node.saved = node.children + row["n_children"], node.leaves + row["n_leaves"], node.saved + row["saved_tokens"]
        node.words, node.ends = row["words"], row["ends_sha256"] or node.ends
        yield {"number": node.number, "part": row["part"], "block": row["block"], "side": row["side"], "depth": depth}
    yield from close(0)


def trie(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every trie node of the rebuilt conversations of `turns` (conv_id, turn, role, text).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256);
    depth is a number of turns and the root has depth 0 and no parent. Without any conversation
    there is no root either.
    """
    keys = stash(distinct_keys(rebuilt(conversations(turns))), "trie-keys")
    nodes = stash(blocks(keys, block), "trie-blocks")

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in merge_edges(row for batch in batches for row in batch.to_pylist()):
            rows.append(row)
            if len(rows) == 5_000:
                yield _batch(rows, _MERGED)
                rows = []
        if rows:
            yield _batch(rows, _MERGED)

    # One task reads two paths per block of keys, in key order.
    edges = nodes.where("kind = 'edge'").repartition(1).sortWithinPartitions("part", "block", "side", "depth")
    edges = stash(edges.mapInArrow(merged, _MERGED_DDL), "trie-edges")
    tops, known = edges.where("n_convs IS NOT NULL"), edges.where("n_convs IS NULL")
    names = tops.select(F.col("number"), F.col("conv_id").alias("parent_conv_id"))
    parents = known.select("number", "part", "block", "side", (F.col("depth") + 1).alias("depth")).join(names, "number")
    under = nodes.where("kind = 'under'").drop("parent_conv_id").join(parents, ["part", "block", "side", "depth"])
    tops = tops.join(names.withColumnRenamed("number", "parent"), "parent", "left")
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    ]
    return nodes.where("kind = 'whole'").select(*columns).unionByName(under.select(*columns)).unionByName(tops.select(*columns))


def op12_radix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations.

    Null roles and texts are empty, null turns come first, turns of one number come in the order
    of their ids, rows without conv_id are in no conversation; an empty table gives no rows.
    """
    return trie(table(spark, folder, "conversations"))


#: The checksum of the decimal conv_id, bit by bit; the rest restates the definition over lists of turns.
SQL = {
    "op12_radix_trie": r"""
WITH t AS (
  SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), b AS (
  SELECT conv_id, own, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(0, length(conv_id::VARCHAR)),
      lambda p: list_transform(range(0, 8), lambda k: (ascii(substr(conv_id::VARCHAR, p::BIGINT + 1, 1))::BIGINT >> k::BIGINT) & 1)))),
      lambda x, y: CASE WHEN ((x & 1) <> y) THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END) AS state
  FROM t
), h AS (SELECT conv_id, own, xor(state, 4294967295::BIGINT) % 4 AS head, conv_id - conv_id % 20 AS first_id FROM b),
r AS (
  SELECT h.conv_id, coalesce(g.own[1:h.head], []) || h.own[h.head + 1:] AS turns FROM h LEFT JOIN t g ON g.conv_id = h.first_id
), p AS (
  SELECT conv_id, d::BIGINT AS depth, turns[1:d] AS path, len(turns) = d AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)
), n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
    CASE WHEN depth > 0 THEN (count(*) - 1) * len(regexp_extract_all(path[depth][2], '[^\x20\x09-\x0D]+')) ELSE 0 END AS own_saved
  FROM p GROUP BY path, depth
), c AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c ON c.path = n.path),
u AS (
  SELECT path[1:k] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(own_saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM f) GROUP BY 1
)
SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children::BIGINT AS n_children, u.n_leaves::BIGINT AS n_leaves,
  u.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN u ON u.path = f.path LEFT JOIN n q ON f.depth > 0 AND q.path = f.path[1:f.depth - 1]""",
}
