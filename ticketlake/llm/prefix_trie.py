"""The prefix trie of conversations, from adaptive radix trees.

A turn is an id of 16 bytes, big-endian: four bytes with the length of its text, twelve of a
digest of role and text. A conversation is the string of its turns' ids, so prefixes of
conversations are prefixes of bytes, and their order is the order of the bytes.

- Equal conversations are counted before anything else and are one key.
- The keys are sorted by range over the tasks. A first turn that a third of all
  conversations share is no hot key, since a range may end anywhere. Each task
  cuts its keys to blocks of bounded bytes and makes one adaptive radix tree of each: nodes
  of 4, 16, 48 or 256 children that are replaced by the next size when full, with compressed
  paths. Only byte depths that are whole turns are nodes of the trie; such depths inside
  a compressed path are nodes with one child.
- What lies on the path to a block's first or last key may go on in a neighbouring
  block: these nodes stay open. A block gives its open nodes as one row. One pass over these rows
  in order of the keys, which holds a single path, adds up what belongs together.
- A closed node whose parent is open learns the parent's conversation by a join.
- The ids that end at a node are joined to text in stretches of 4,096 numbers, which are
  hashed in their order: a key that very many conversations have is few rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ticketlake.llm.common import discard, written

WIDTH = 16
#: Keys and bytes of keys in one tree.
BLOCK_KEYS, BLOCK_BYTES = 50_000, 32 << 20
#: 2 ** _PIECE neighbouring numbers become one piece of text.
_PIECE = 12


# --- adaptive radix tree -------------------------------------------------------------


class _Sorted:
    """Up to 4 or 16 children, their bytes in order."""

    __slots__ = ("most", "bytes", "nodes")

    def __init__(self, most: int):
        self.most, self.bytes, self.nodes = most, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node: Node):
        if len(self.nodes) == self.most:
            larger = _Sorted(16) if self.most == 4 else _Indexed()
            for b, n in self:
                larger.put(b, n)
            return larger.put(byte, node)
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def __iter__(self):
        return zip(self.bytes, self.nodes)


class _Indexed:
    """Up to 48 children, by a table of 256 places."""

    __slots__ = ("place", "nodes")
    most = 48

    def __init__(self):
        self.place, self.nodes = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        at = self.place[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node: Node):
        if len(self.nodes) == self.most:
            larger = _Direct()
            for b, n in self:
                larger.put(b, n)
            return larger.put(byte, node)
        self.nodes.append(node)
        self.place[byte] = len(self.nodes)
        return self

    def __iter__(self):
        return ((b, self.nodes[at - 1]) for b, at in enumerate(self.place) if at)


class _Direct:
    """A child for each of the 256 bytes."""

    __slots__ = ("nodes",)
    most = 256

    def __init__(self):
        self.nodes: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node):
        self.nodes[byte] = node
        return self

    def __iter__(self):
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    """The bytes behind the one that leads here, what ends here, and the children."""

    __slots__ = ("path", "end", "children")

    def __init__(self, path: bytes, end: tuple | None = None, children=None):
        self.path, self.end, self.children = path, end, children


def _common(key: bytes, at: int, path: bytes) -> int:
    """How many bytes of ``path`` stand in ``key`` from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    low, high = 0, min(len(path), len(key) - at)  # the first ``low`` bytes agree
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(path[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


def insert(root: Node, key: bytes, value: tuple) -> None:
    node, at = root, 0
    while True:
        same = _common(key, at, node.path)
        if same < len(node.path):
            lower = Node(node.path[same + 1 :], node.end, node.children)
            node.children = _Sorted(4).put(node.path[same], lower)
            node.path, node.end = node.path[:same], None
        at += same
        if at == len(key):
            node.end = value
            return
        child = node.children.get(key[at]) if node.children is not None else None
        if child is None:
            node.children = (node.children if node.children is not None else _Sorted(4)).put(key[at], Node(key[at + 1 :], value))
            return
        node, at = child, at + 1


class _Sum:
    """What the part of a subtree that is known so far adds up to."""

    __slots__ = ("least", "n", "leaves", "saved", "tops", "end")

    def __init__(self):
        # tops: rows of the topmost nodes of the trie, whose parent is further up
        self.least, self.n, self.leaves, self.saved, self.tops, self.end = None, 0, 0, 0, [], None

    def add(self, least, n, leaves, saved, tops) -> None:
        self.least = least if self.least is None else min(self.least, least)
        self.n += n
        self.leaves += leaves
        self.saved += saved
        self.tops += tops


class Block:
    """The nodes of one tree: ``rows`` of those that are complete, and the open ones by side and depth.

    A row is [least, depth, parent's least, parent's side, n, children, leaves, saved, end];
    an open node is (depth, least, n, children, leaves, saved, end). The nodes of the path
    to the first key are on side 0, the others of the path to the last key on side 1.
    """

    def __init__(self, keys: list[tuple[bytes, int, int]]):
        self.first, self.last = keys[0][0], keys[-1][0]
        self.rows: list[list] = []
        self.open: tuple[list[tuple], list[tuple]] = ([], [])
        self.path = bytearray()
        root = Node(b"")
        for key, least, n in keys:
            insert(root, key, (least, n))
        self._walk(root)
        for side in self.open:
            side.reverse()

    def _frame(self, node: Node, label: bytes, sides: tuple[bool, bool]):
        """Of a node that is entered: the byte depth above its edge, whether it is on the path to the first and last key, its sum, its children."""
        above = len(self.path)
        self.path += label
        total = _Sum()
        if node.end is not None:
            least, n = node.end
            total.add(least, n, 0, 0, [])
            total.end = least
        return above, sides, total, iter(node.children if node.children is not None else ())

    def _walk(self, root: Node) -> None:
        """All nodes, each after its children."""
        stack = [self._frame(root, root.path, (True, True))]
        while stack:
            above, sides, total, children = stack[-1]
            step = next(children, None)
            if step is not None:
                byte, child = step
                at = len(self.path)
                on = tuple(side and at < len(key) and key[at] == byte for side, key in zip(sides, (self.first, self.last)))
                stack.append(self._frame(child, bytes((byte,)) + child.path, on))
                continue
            stack.pop()
            # only byte depths of whole turns are nodes of the trie; the root is one
            for depth in range(len(self.path) // WIDTH, above // WIDTH if stack else -1, -1):
                total = self._node(depth, sides, total)
            del self.path[above:]
            if stack:
                stack[-1][2].add(total.least, total.n, total.leaves, total.saved, total.tops)

    def _node(self, depth: int, sides: tuple[bool, bool], below: _Sum) -> _Sum:
        """Make the node at a depth out of what is below it; what its ancestors learn of it."""
        above = _Sum()
        above.add(below.least, below.n, 0, 0, [])
        if any(sides):
            side = 0 if sides[0] else 1
            self.open[side].append((depth, below.least, below.n, len(below.tops), below.leaves, below.saved, below.end))
            for row in below.tops:
                self.rows[row][3] = side
            return above
        for row in below.tops:
            self.rows[row][2] = below.least
        start = (depth - 1) * WIDTH
        above.leaves = below.leaves if below.tops else 1
        above.saved = below.saved + (below.n - 1) * int.from_bytes(self.path[start : start + 4], "big")
        above.tops = [len(self.rows)]
        self.rows.append([below.least, depth, None, None, below.n, len(below.tops), above.leaves, above.saved, below.end])
        return above


# --- the tasks -----------------------------------------------------------------------

_OPEN = "array<struct<depth: long, least: long, n: long, children: long, leaves: long, saved: long, ends: long>>"
_NODE = "conv_id long, depth long, parent_conv_id long, side int, n_convs long, n_children long, n_leaves long, saved_tokens long, ends long"
BLOCKS = f"block long, {_NODE}, first binary, last binary, left {_OPEN}, right {_OPEN}"
MERGED = f"node long, parent long, block long, {_NODE}"

_LONG, _INT = pa.int64(), pa.int32()
_NODE_TYPES = [_LONG, _LONG, _LONG, _INT, *[_LONG] * 5]
_OPEN_TYPE = pa.list_(pa.struct([(x, _LONG) for x in ("depth", "least", "n", "children", "leaves", "saved", "ends")]))


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ") if "<" not in x and ":" not in x]


_BLOCK_NAMES = ["block", *_names(_NODE), "first", "last", "left", "right"]
_MERGED_NAMES = ["node", "parent", "block", *_names(_NODE)]


def _batch(columns: list, types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _blocks(block_keys: int, block_bytes: int):
    """Sorted keys -> complete nodes, and one row of open ones for each block."""

    def solved(number: int, keys: list[tuple[bytes, int, int]]) -> Iterator[pa.RecordBatch]:
        block = Block(keys)
        n = len(block.rows)
        if n:
            columns = [[number] * n, *zip(*block.rows), *[[None] * n] * 4]
            yield _batch(columns, [_LONG, *_NODE_TYPES, pa.binary(), pa.binary(), _OPEN_TYPE, _OPEN_TYPE], _BLOCK_NAMES)
        sides = [[dict(zip(("depth", "least", "n", "children", "leaves", "saved", "ends"), x)) for x in side] for side in block.open]
        columns = [[number], *[[None]] * 9, [block.first], [block.last], *[[x] for x in sides]]
        yield _batch(columns, [_LONG, *_NODE_TYPES, pa.binary(), pa.binary(), _OPEN_TYPE, _OPEN_TYPE], _BLOCK_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, keys = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if keys and (len(keys) >= block_keys or held + len(row[0]) > block_bytes):
                    yield from solved(number, keys)
                    number, held, keys = number + 1, 0, []
                keys.append(row)
                held += len(row[0])
        if keys:
            yield from solved(number, keys)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open nodes of all blocks in order -> for each the node it is part of, and the nodes (``node`` and ``parent`` are numbers).

    Only the path to the last key is held.
    """
    path, stack, numbers = b"", [], iter(range(1 << 62))
    out: list[tuple] = []

    def close() -> None:
        node, depth, least, n, children, leaves, saved, end = stack.pop()
        leaves = leaves if children else 1
        saved += (n - 1) * int.from_bytes(path[(depth - 1) * WIDTH :][:4], "big") if depth else 0
        if stack:
            stack[-1][4] += 1
            stack[-1][5] += leaves
            stack[-1][6] += saved
        out.append((node, stack[-1][0] if stack else None, None, least, depth, None, None, n, children, leaves, saved, end))

    def flush() -> pa.RecordBatch:
        done = _batch(list(zip(*out)), [_LONG, _LONG, _LONG, *_NODE_TYPES], _MERGED_NAMES)
        out.clear()
        return done

    for batch in batches:
        for block, first, last, left, right in zip(*(c.to_pylist() for c in batch.columns)):
            for side, key, nodes in ((0, first, left), (1, last, right)):
                common = _common(key, 0, path) // WIDTH
                while len(stack) > common + 1:
                    close()
                path = key
                for x in nodes:
                    depth, known = x["depth"], [x[c] for c in ("least", "n", "children", "leaves", "saved", "ends")]
                    if depth == len(stack):
                        stack.append([next(numbers), depth, *known])
                    else:
                        mine = stack[depth]
                        mine[2] = min(mine[2], known[0])
                        mine[3:7] = [a + b for a, b in zip(mine[3:7], known[1:5])]
                        mine[7] = known[5] if mine[7] is None else mine[7]
                    out.append((stack[depth][0], None, block, None, depth, None, side, *[None] * 5))
                    if len(out) >= 50_000:
                        yield flush()
    while stack:
        close()
    if out:
        yield flush()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of text, ordered by class and place -> the hash of each class's pieces, joined by commas."""
    now, digest = None, None
    for batch in batches:
        ready: list[tuple[int, str]] = []
        for least, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest is not None and least == now:
                digest.update(b",")
            else:
                if digest is not None:
                    ready.append((now, digest.hexdigest()))
                now, digest = least, hashlib.sha256()
            digest.update(piece.encode())
        yield _batch([[x[i] for x in ready] for i in (0, 1)], [_LONG, pa.string()], ["least", "ends_sha256"])
    if digest is not None:
        yield _batch([[now], [digest.hexdigest()]], [_LONG, pa.string()], ["least", "ends_sha256"])


# --- the steps -----------------------------------------------------------------------


def turn_id(role: Column, text: Column) -> Column:
    """Sixteen bytes: the text's length in four, then a digest of role and text."""
    role, text = (F.coalesce(x.cast("string"), F.lit("")) for x in (role, text))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.unhex(F.concat(F.lpad(F.hex(F.octet_length(text)), 8, "0"), F.substring(digest, 1, 2 * WIDTH - 8)))


def sequences(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and ``turns``, the ids of its turns in order.

    Turns are ordered by ``turn``, null first, equal ones by their id. A null role or text is
    empty. Rows without a conv_id belong to no conversation and are left out; a row that
    is there twice is two turns. Further columns are ignored. Texts are not moved: a turn is 16 bytes and its number.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_id(F.col("role"), F.col("text")).alias("id"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "id")))
    return rows.where("conv_id is not null").groupBy("conv_id").agg(turns.alias("t")).select("conv_id", F.col("t.id").alias("turns"))


def trie(conversations: DataFrame, block_keys: int = BLOCK_KEYS, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the prefix trie of rows ``conv_id`` (distinct) and ``turns`` (ids of ``WIDTH`` bytes, null: none).

    A node is a distinct sequence of the first ``depth`` turns; the root has none. Columns:
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's; null for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes below, or itself), ``saved_tokens`` (over the
    subtree, members but one times the bytes of the last text) and ``ends``, the smallest conversation
    that ends here (null: none). The second table has all of them, as ``ends`` and ``conv_id``.
    Without conversations both are empty. A conversation is one row: 16 bytes a turn.
    """
    key = F.unhex(F.array_join(F.transform(F.coalesce("turns", F.expr("cast(array() as array<binary>)")), F.hex), ""))
    keyed = conversations.select("conv_id", key.alias("key"))
    keyed = written(keyed.withColumn("seq", F.unhex(F.substring(F.sha2("key", 256), 1, 32))), "sequences")
    classes = written(keyed.groupBy("seq").agg(F.min("conv_id").alias("ends"), F.count(F.lit(1)).alias("n")), "classes")
    members = written(keyed.select("seq", "conv_id").join(classes.select("seq", "ends"), "seq").select("ends", "conv_id"), "members")

    keys = keyed.select("conv_id", "key").join(classes.select(F.col("ends").alias("conv_id"), "n"), "conv_id").select("key", "conv_id", "n")
    blocks = keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_blocks(block_keys, block_bytes), BLOCKS)
    blocks = written(blocks, "blocks")
    # one row per block, whose order is that of the keys
    spines = blocks.where("first is not null").select("block", "first", "last", "left", "right")
    merged = written(spines.repartition(1).sortWithinPartitions("block").mapInArrow(_merge, MERGED), "merged", 100)

    names = _names(_NODE)
    names.remove("side")
    nodes = merged.where("block is null")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("up"))
    open_ = nodes.drop("parent_conv_id").join(parents, "parent", "left").withColumnRenamed("up", "parent_conv_id").select(*names)
    # where the parent of a complete node is open
    refs = merged.where("block is not null").select("block", "side", "depth", F.col("node").alias("parent")).join(parents, "parent")
    refs = written(refs.select("block", "side", (F.col("depth") + 1).alias("depth"), F.col("up").alias("parent_conv_id")), "parents")
    edge = blocks.where("first is null and side is not null").drop("parent_conv_id").join(refs, ["block", "side", "depth"]).select(*names)
    inner = blocks.where("first is null and side is null").select(*names)
    result = written(inner.unionByName(edge).unionByName(open_), "nodes")
    discard(keyed, classes, blocks, merged, refs)
    return result, members


def ends_digests(members: DataFrame) -> DataFrame:
    """``least`` and ``ends_sha256``: the hash of each class's conversations, ascending, joined by commas."""
    piece = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = members.groupBy(F.col("ends").alias("least"), F.shiftright("conv_id", _PIECE).alias("place")).agg(piece.alias("piece"))
    pieces = pieces.repartition("least").sortWithinPartitions("least", "place").select("least", "piece")
    return written(pieces.mapInArrow(_hashed, "least long, ends_sha256 string"), "ends", 500)


# --- the query -----------------------------------------------------------------------


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversation c: the first h turns of conversation c - c % 5, then its own without its first h, with h the crc32 of c modulo 9."""
    own = written(conversations, "conversations")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    heads = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    rows = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % 5, "h": h}).join(heads, "base", "left")
    none = F.expr("cast(array() as array<binary>)")
    head = F.expr("slice(head, 1, h)")
    rest = F.expr("slice(turns, h + 1, size(turns))")
    return rows.select("conv_id", F.concat(F.coalesce(head, none), rest).alias("turns"))


def digests(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """The contract's columns of ``trie``."""
    empty = hashlib.sha256().hexdigest()
    found = nodes.join(ends_digests(members), F.col("ends") == F.col("least"), "left")
    names = [x for x in _names(_NODE) if x not in ("side", "ends")]
    return found.select(*names, F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def oracle() -> str:
    return r"""
WITH RECURSIVE crc(i, j, v) AS (
  SELECT range, 0, range::BIGINT FROM range(256)
  UNION ALL SELECT i, j + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc WHERE j < 8),
t AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM crc WHERE j = 8),
r AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
o AS MATERIALIZED (SELECT conv_id, list(struct_pack(d := digest, b := bytes) ORDER BY turn NULLS FIRST, bytes, digest) AS w FROM r GROUP BY conv_id),
h AS (
  SELECT conv_id, w, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')]),
      lambda s, c: xor(t[1 + (xor(s, c) & 255)], s >> 8)), 4294967295) % 9 AS h
  FROM o, t),
c AS MATERIALIZED (
  SELECT h.conv_id, list_concat(coalesce(b.w, [])[1:h.h], h.w[h.h + 1:]) AS w FROM h LEFT JOIN o b ON b.conv_id = h.base),
p AS MATERIALIZED (
  SELECT conv_id, d, len(w) AS n, md5(array_to_string([x.d FOR x IN w[1:d]], ',')) AS k,
    CASE WHEN d > 0 THEN md5(array_to_string([x.d FOR x IN w[1:d - 1]], ',')) END AS up, CASE WHEN d > 0 THEN w[d].b ELSE 0 END AS b
  FROM (SELECT *, unnest(range(len(w) + 1)) AS d FROM c)),
v AS MATERIALIZED (
  SELECT k, any_value(up) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n, any_value(b) AS b,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = n) AS ends
  FROM p GROUP BY k),
k AS MATERIALIZED (SELECT up, count(*) AS n FROM v WHERE up IS NOT NULL GROUP BY up),
s AS (
  SELECT p.k, sum((v.n - 1) * v.b) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
  FROM v JOIN p ON p.conv_id = v.conv_id AND p.d <= v.depth LEFT JOIN k ON k.up = v.k GROUP BY p.k)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(k.n, 0)::BIGINT AS n_children, s.leaves AS n_leaves,
  s.saved::BIGINT AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN s USING (k) LEFT JOIN k ON k.up = v.k LEFT JOIN v u ON u.k = v.up"""
