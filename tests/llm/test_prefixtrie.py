"""The prefix trie against a plain trie of tuples, and the radix tree against a dictionary."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from oracle_check import SMALL, connect, spark_rows, sql_rows
from streamlens.llm import prefixtrie
from streamlens.llm.queries import ORACLE, QUERIES
from streamlens.llm.radix import Tree

SCHEMA = "conv_id long, turn long, role string, text string, key string, n int"


# --- radix tree ---------------------------------------------------------------


def held(tree):
    """Keys and values, by walking from the root."""
    out, todo = [], [(tree.root, b"")]
    while todo:
        node, above = todo.pop()
        whole = above + node.path
        if node.value is not None:
            out.append((whole, node.value))
        todo += [(kid, whole + bytes([byte])) for byte, kid in node.items()]
    return sorted(out)


@pytest.mark.parametrize("letters", [2, 5, 17, 49, 256])
def test_tree_holds_what_was_put_in(letters):
    rng = random.Random(letters)
    keys = {bytes(rng.randrange(letters) for _ in range(rng.choice([0, 1, 2, 3, 9]))) for _ in range(2000)}
    keys |= {b"\1" * n for n in range(60)}
    order = list(keys)
    rng.shuffle(order)
    tree = Tree()
    for key in order:
        tree.insert(key, len(key) + 1)
    tree.insert(order[0], 77)
    want = {k: len(k) + 1 for k in keys} | {order[0]: 77}
    assert held(tree) == sorted(want.items())
    seen = set()
    for node, _, _ in tree.bottom_up():
        assert all(id(kid) in seen for _, kid in node.items())
        # Compressed: a node ends a key or parts several.
        assert node.value is not None or len(list(node.items())) > 1 or node is tree.root
        seen.add(id(node))


def test_layouts_grow():
    tree, kinds = Tree(), []
    for byte in range(256):
        tree.insert(bytes([byte, 0]), 1)
        kinds.append(type(tree.root.below).__name__ + str(getattr(tree.root.below, "room", "")))
    assert [kinds[i] for i in (3, 4, 15, 16, 47, 48, 255)] == [
        "_Sorted4", "_Sorted16", "_Sorted16", "_Indexed", "_Indexed", "_Direct", "_Direct",
    ]


# --- nodes --------------------------------------------------------------------


def plain_nodes(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv_id].append((turn is not None, turn or 0, name, len(text), (role, text)))
    turns = {c: [(t[4], t[3]) for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(turns.get(base, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(convs) - 1) * (node[-1][1] if node else 0)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(convs), len(node), parent, len(convs), kids[node], leaves[node], saved[node],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def found_nodes(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in prefixtrie.nodes(df).collect()), key=str)


def conversations(rng):
    rows = []
    texts = [None, "", "a", "b", "日本", "ab" * 400]
    for c in rng.sample(range(-150, 450), 150):
        for turn in range(rng.choice([1, 2, 3, 4, 9])):
            rows.append((c, turn, rng.choice(["user", None, "user", "assistant"]), rng.choice(texts[: rng.randint(2, 6)])))
    # Copies of one conversation, chains of beginnings, ties, repeated and null turns.
    rows += [(1000 + c, t, "user", str(t)) for c in range(60) for t in range(3)]
    rows += [(2000 + c, t, "user", "chain") for c in range(30) for t in range(c)]
    rows += [(3001, None, "user", "none"), (3001, None, "user", "again"), (3001, 0, "user", "x")] * 2
    rows += [(None, 0, "user", "nobody"), (None, 1, None, None)]
    rows += [(4002, t, "user", str(t % 7)) for t in range(300)]
    return rows


@pytest.mark.parametrize("held", [1 << 20, 40])
def test_nodes_equal_plain_trie(spark, monkeypatch, held):
    """With the usual ranges, and with ranges of some two turns."""
    monkeypatch.setattr(prefixtrie, "RANGE_BYTES", held * 20)
    monkeypatch.setattr(prefixtrie, "CHUNK_IDS", 7)
    monkeypatch.setattr(prefixtrie, "BATCH_ROWS", 50)
    rows = conversations(random.Random(held))
    assert found_nodes(spark, rows) == plain_nodes(rows)


def test_turnless_and_missing_heads(spark):
    # 123's hundred starts with no conversation, and h is above its number of turns.
    rows = [(c, 0, "user", "only") for c in range(101, 130)]
    got = found_nodes(spark, rows)
    assert got == plain_nodes(rows)
    assert got[0][1] == 0 or any(r[1] == 0 and r[3] == 29 for r in got)


def test_one_conversation_and_none(spark):
    assert found_nodes(spark, [(0, 0, "user", "x")]) == plain_nodes([(0, 0, "user", "x")])
    assert found_nodes(spark, []) == []


def test_query_equals_its_sql(spark):
    name = "op12_prefix_trie"
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(connect(SMALL), ORACLE[name])
