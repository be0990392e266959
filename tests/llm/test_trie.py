"""The prefix trie of conversations against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ticketlake.llm import prefix_trie
from ticketlake.llm.prefix_trie import Block, Node, insert

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def talks(seed, size=120):
    """Conversations with shared beginnings, copies, a long one, gaps, nulls, ties and repeated rows."""
    rng = random.Random(seed)
    rows, made = [], []
    for c in rng.sample(range(-20, 400), size):
        turns = [(rng.choice("ua"), rng.choice(["hi", "so", "", "é" * 40, None])) for _ in range(rng.randint(1, 6))]
        if made and rng.random() < 0.6:
            turns = rng.choice(made)[: rng.randint(1, 8)] + turns * rng.randint(0, 1)
        made.append(turns)
        rows += [(c, i if rng.random() < 0.9 else None, role, text, "clash") for i, (role, text) in enumerate(turns)]
    rows += [(1000, i, "u", f"turn {i}", "clash") for i in range(500)] + [(1003, i, "u", f"turn {i}", "clash") for i in range(300)]
    rows += [(None, 1, "u", "nobody", "clash"), (2000, 3, None, None, "clash"), (2000, 3, None, None, "clash"), (2001, None, "u", "x", "clash"), (2001, None, "a", "y", "clash")]
    rng.shuffle(rows)
    return rows


def ordered(rows):
    out = defaultdict(list)
    for c, turn, role, text, _ in rows:
        if c is not None:
            role, text = role or "", text or ""
            size = len(text.encode())
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            out[c].append((turn is not None, turn or 0, size, digest))
    return {c: [(size, digest) for _, _, size, digest in sorted(turns)] for c, turns in out.items()}


def brute_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute_nodes(made):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(who) - 1) * (node[-1][0] if node else 0)
    return sorted(
        (min(who), len(node), min(members[node[:-1]]) if node else -1, len(who), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, who in members.items()
    )


@pytest.mark.parametrize("seed, keys, size", [(1, 50_000, 32 << 20), (2, 3, 32 << 20), (3, 1, 32 << 20), (4, 50_000, 200)])
def test_nodes_like_brute_force(spark, seed, keys, size):
    rows = talks(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    nodes, members = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(frame)), keys, size)
    got = prefix_trie.digests(nodes, members)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, got.collect())) == brute_nodes(brute_rebuilt(ordered(rows)))


def test_many_equal_conversations(spark):
    """Members of one node whose text is made of several pieces, and ids below zero."""
    ids = [*range(-5000, 5000, 3), 2**40, -(2**40)]
    frame = spark.createDataFrame([(c, 1, "u", "hi", "") for c in ids], SCHEMA)
    got = prefix_trie.digests(*prefix_trie.trie(prefix_trie.sequences(frame))).collect()
    text = ",".join(map(str, sorted(ids)))
    assert sorted((r.depth, r.n_convs, r.saved_tokens, r.ends_sha256) for r in got) == [
        (0, len(ids), 2 * (len(ids) - 1), hashlib.sha256().hexdigest()), (1, len(ids), 2 * (len(ids) - 1), hashlib.sha256(text.encode()).hexdigest())
    ]


def test_no_conversations(spark):
    assert prefix_trie.digests(*prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame([], SCHEMA)))).collect() == []


def kinds(node):
    out = []
    while node is not None:
        if node.children is not None:
            out.append(node.children.most)
        node = next((n for _, n in node.children), None) if node.children is not None else None
    return out


@pytest.mark.parametrize("n, most", [(4, 4), (5, 16), (16, 16), (17, 48), (48, 48), (49, 256), (256, 256)])
def test_nodes_grow_and_paths_are_compressed(n, most):
    root = Node(b"")
    keys = [b"\0" * 15 + bytes((i,)) + b"\7" * 32 for i in range(n)]
    for key in random.Random(1).sample(keys, n):
        insert(root, key, (1, 1))
    assert kinds(root)[-1] == most  # one node of children, everything else is paths
    child = root.children.get(0)
    assert child.path == b"\0" * 14 and [b for b, _ in child.children] == list(range(n))
    assert all(node.path == b"\7" * 32 and node.children is None for _, node in child.children)


def test_only_whole_turns_are_nodes():
    """Ids that part in the middle of a turn make no node there; long paths make one for each turn."""
    one, two, three = (bytes(15) + bytes((x,)) for x in (1, 2, 3))
    block = Block([(one + one, 5, 1), (one + two + two + one, 6, 2), (one + three, 7, 1)])
    assert sorted((r[1], r[4], r[5]) for r in block.rows) == [(2, 2, 1), (3, 2, 1), (4, 2, 0)]
    assert [x[0] for x in block.open[0]] == [0, 1, 2] and [x[0] for x in block.open[1]] == [2]
