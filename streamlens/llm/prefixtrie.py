"""The trie of the turns that conversations begin with, for reusing what is common.

A turn gets an id of 16 bytes, a hash of role and text, and a conversation is the key of its
turns' ids in a row.  Distinct keys are dealt out by key ranges; every task holds its range in an
adaptive radix tree (``radix``) and emits the nodes at whole turns, as byte depths in between mean
nothing.  A node whose members all lie in one range is settled there, with all that is below it.
The other ones start the first or the last key of a range; they are few, known by a hash of
their turns, and merged by Spark: counts add up, and what lies below them is summed along the
first and last keys.

Copies of a conversation are one key.  Their ids, which a digest needs in order, are sorted by
Spark and joined into texts of some thousand ids, so the task that hashes them reads few rows.

Defined results: rows without conv_id are left out.  Turns of equal number follow each other by
their ids; a null number comes first, and null role or text is empty.  Repeated rows are repeated turns.  An empty
table has no nodes, not even a root.  Texts of any length are hashed where they are read and
never moved.  A conversation is one key of 16 bytes a turn, so one of a million turns is a row of
16 MB; it is handled in one task.  Further columns are not read, so their names cannot clash.
Turns are known by 128 bits of a cryptographic hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlens.llm.radix import Node, Tree
from streamlens.llm.tables import kept, parallelism

WIDTH = 16
#: Every conversation starts with up to 5 turns of the first one of its hundred.
BLOCK, HEADS = 100, 6
#: Bytes of keys that a task holds as a tree, ids in a text that is hashed, rows in a batch.
RANGE_BYTES = 8 << 20
CHUNK_IDS = 1 << 14
BATCH_ROWS = 1 << 14

NO_ENDS = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, key, chars``: the ids of its turns as hexadecimal text, the lengths of their texts."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.sha2(whole, 256), 1, 2 * WIDTH).alias("id"),
        F.length(text).alias("chars"),
    )
    grouped = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "id", "chars"))).alias("turns")
    )
    own = kept(grouped, "trie-conversations")
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    heads = own.filter(F.col("conv_id") % BLOCK == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("heads")
    )
    n_heads = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS)).cast("int")
    joined = own.withColumns({"base": base, "h": n_heads}).join(heads, "base", "left")
    no_turns = F.slice("turns", 1, 0)
    whole_turns = F.concat(
        F.slice(F.coalesce("heads", no_turns), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.size("turns")),
    )
    return joined.select("conv_id", whole_turns.alias("turns")).select(
        "conv_id",
        F.unhex(F.array_join("turns.id", "")).alias("key"),
        F.col("turns.chars").alias("chars"),
    )


# --- copies -------------------------------------------------------------------


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (name, conv_id) to rows of up to ``CHUNK_IDS`` ids joined by commas."""
    name, ids, rows = None, [], []

    def flush():
        if ids:
            rows.append((name, ids[0], len(ids), ",".join(map(str, ids))))

    for batch in batches:
        for next_name, conv_id in zip(batch["name"].to_pylist(), batch["conv_id"].to_pylist()):
            if next_name != name or len(ids) == CHUNK_IDS:
                flush()
                name, ids = next_name, []
            ids.append(conv_id)
        if sum(r[2] for r in rows) >= CHUNK_IDS:
            yield _batch(rows, _CHUNKS)
            rows = []
    flush()
    if rows:
        yield _batch(rows, _CHUNKS)


_CHUNKS = pa.schema(
    [("name", pa.string()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ids", pa.string())]
)
_COPIES = pa.schema(
    [("name", pa.string()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())]
)


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by (name, conv_id) to a row per name: least id, number, digest of all ids."""
    name, least, n, digest, rows = None, None, 0, None, []
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in _CHUNKS.names)):
            if row[0] != name:
                if digest is not None:
                    rows.append((name, least, n, digest.hexdigest()))
                name, least, n, digest = row[0], row[1], 0, hashlib.sha256()
            elif n:
                digest.update(b",")
            digest.update(row[3].encode())
            n += row[2]
        if len(rows) >= BATCH_ROWS:
            yield _batch(rows, _COPIES)
            rows = []
    if digest is not None:
        rows.append((name, least, n, digest.hexdigest()))
    if rows:
        yield _batch(rows, _COPIES)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def distinct_keys(conversations: DataFrame) -> DataFrame:
    """One row per distinct key: ``key, chars``, least ``conv_id``, number and digest of all ids."""
    spark = conversations.sparkSession
    parts = parallelism(spark)
    every = kept(conversations.withColumn("name", F.sha2("key", 256)), "trie-rebuilt")
    ranged = every.select("name", "conv_id").repartitionByRange(parts, "name", "conv_id")
    chunks = ranged.sortWithinPartitions("name", "conv_id").mapInArrow(
        _joined_ids, "name string, conv_id long, n long, ids string"
    )
    grouped = chunks.repartition(parts, "name").sortWithinPartitions("name", "conv_id")
    copies = grouped.mapInArrow(_hashed_ids, "name string, conv_id long, n long, ends string")
    return every.drop("name").join(copies.drop("name"), "conv_id")


# --- trees --------------------------------------------------------------------

_NODES = pa.schema(
    [
        ("open", pa.bool_()),
        ("range", pa.int64()),
        ("path", pa.int64()),
        ("depth", pa.int64()),
        ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("pid", pa.binary()),
        ("parent_pid", pa.binary()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved", pa.int64()),
        ("chars", pa.int64()),
        ("ends", pa.string()),
    ]
)
_NODES_SQL = (
    "open boolean, range long, path long, depth long, conv_id long, parent_conv_id long, pid binary,"
    " parent_pid binary, n_convs long, n_children long, n_leaves long, saved long, chars long, ends string"
)


class _Below:
    """What lies at and below the end of an edge: members, and the whole turns further down."""

    __slots__ = ("n", "conv", "sums", "children", "leaves", "saved")

    def __init__(self, node: Node):
        value = node.value
        self.n, self.conv, self.sums = (value[0], value[1], value[2]) if value else (0, None, None)
        self.children = self.leaves = self.saved = 0

    def take(self, kid: "_Above") -> None:
        self.n += kid.n
        self.conv = kid.conv if self.conv is None else min(self.conv, kid.conv)
        self.sums = kid.sums if self.sums is None else self.sums
        self.children += kid.children
        self.leaves += kid.leaves
        self.saved += kid.saved


class _Above(_Below):
    """The same seen from the start of the edge, whose whole turns are counted in."""

    __slots__ = ()

    def __init__(self, below: _Below, start: int, end: int):
        self.n, self.conv, self.sums = below.n, below.conv, below.sums
        self.children, self.leaves, self.saved = below.children, below.leaves, below.saved
        first, last = _turns(start, end)
        if first <= last:
            self.leaves = max(1, self.leaves)
            self.saved += (self.n - 1) * int(self.sums[last] - self.sums[first - 1])
            self.children = 1


def _turns(start: int, end: int) -> tuple[int, int]:
    """The whole turns whose last byte is on an edge that spans the bytes start to end.

    The byte before ``start`` leads to the edge and is part of it; the root has none.
    """
    return max(1, -(-start // WIDTH)), end // WIDTH


class _Open:
    """A node that other ranges may share; its sums leave out what is below other open nodes."""

    __slots__ = ("depth", "pid", "parent", "n", "conv", "children", "leaves", "saved", "chars", "ends", "told")

    def __init__(self, depth, parent, turn, below: _Below, chars):
        self.depth, self.parent = depth, parent
        self.pid = b"" if parent is None else hashlib.sha256(parent.pid + turn).digest()[:WIDTH]
        self.n, self.conv, self.chars = below.n, below.conv, chars
        self.children = self.leaves = self.saved = 0
        self.ends, self.told = None, False


def _emitted(keys: list[bytes], tree: Tree, number: int) -> Iterator[tuple]:
    """The nodes of one range, as rows of ``_NODES``."""
    bounds = (keys[0], keys[-1])
    for node, start, end in tree.bottom_up():
        below = _Below(node)
        for _, kid in node.items():
            below.take(kid.found[1])
        node.found = below, _Above(below, start, end)

    paths: tuple[list[_Open], list[_Open]] = ([], [])
    # Node, where its edge starts, which bounds it lies on, and the nearest whole turn above:
    # an open node, or the conversation of a settled one.
    todo = [(tree.root, 0, (True, True), None)]
    while todo:
        node, start, on, above = todo.pop()
        end = start + len(node.path)
        below = node.found[0]
        first, last = _turns(start, end)
        ends = node.value[3] if node.value else None
        if any(on):
            along = bounds[0] if on[0] else bounds[1]
            depths = range(first, last + 1) if above is not None else range(0, last + 1)
            for depth in depths:
                turn = along[(depth - 1) * WIDTH : depth * WIDTH] if depth else b""
                chars = int(below.sums[depth] - below.sums[depth - 1]) if depth else 0
                above = _Open(depth, above, turn, below, chars)
                for path, lies in zip(paths, on):
                    if lies:
                        path.append(above)
            if node.value:
                above.ends = ends
        else:
            leaves, saved, children = max(1, below.leaves), below.saved, below.children
            rows = []
            for depth in range(last, first - 1, -1):
                saved += (below.n - 1) * int(below.sums[depth] - below.sums[depth - 1])
                here = ends if depth * WIDTH == end else None
                rows.append((depth, children, leaves, saved, here))
                children = 1
            for depth, children, leaves, saved, here in reversed(rows):
                parent = (above.pid, None) if isinstance(above, _Open) else (None, above)
                yield (
                    False, number, None, depth, below.conv, parent[1], None, parent[0],
                    below.n, children, leaves, saved, None, here,
                )
                above = below.conv
        for byte, kid in node.items():
            kid_on = tuple(
                lies and len(bound) > end and bound[end] == byte for lies, bound in zip(on, bounds)
            )
            todo.append((kid, end + 1, kid_on, above))
            if any(on) and not any(kid_on):
                seen = kid.found[1]
                above.children += seen.children
                above.leaves += seen.leaves
                above.saved += seen.saved
    for side, path in enumerate(paths):
        for node in path:
            parent = node.parent.pid if node.parent is not None else None
            counts = (node.n, node.children, node.leaves, node.saved)
            if node.told:
                counts = 0, 0, 0, 0
            node.told = True
            yield (
                True, number, 2 * number + side, node.depth, node.conv, None, node.pid, parent,
                *counts, node.chars, node.ends,
            )


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct keys in order to the nodes of their tree."""
    tree, bounds = Tree(), []
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("key", "n", "conv_id", "ends"))
        for key, n, conv_id, ends, chars in zip(*columns, batch["chars"]):
            lengths = chars.values.to_numpy(zero_copy_only=False) if len(chars) else ()
            sums = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))) if len(chars) else (0,)
            tree.insert(key, (n, conv_id, sums, ends))
            bounds[1:] = [key] if bounds else [key, key]
    if not bounds:
        return
    rows = []
    for row in _emitted(bounds, tree, TaskContext.get().partitionId()):
        rows.append(row)
        if len(rows) == BATCH_ROWS:
            yield _batch(rows, _NODES)
            rows = []
    yield _batch(rows, _NODES)


def _merged(opened: DataFrame) -> DataFrame:
    """Open nodes of all ranges as one each, with sums over everything below them."""
    totals = opened.groupBy("pid").agg(
        F.min("path").alias("owner"),
        F.min("depth").alias("depth"),
        F.min("parent_pid").alias("parent_pid"),
        F.min("conv_id").alias("conv_id"),
        F.max("chars").alias("chars"),
        F.max("ends").alias("ends"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
    )
    kids = totals.groupBy(F.col("parent_pid").alias("pid")).agg(F.count(F.lit(1)).alias("more"))
    counted = totals.join(kids.filter("pid IS NOT NULL"), "pid", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))
    )
    own = counted.withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0),
            "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("chars"),
        }
    )
    # A node belongs to the first path through it, so a path owns its lower end.
    along = opened.select("path", "depth", "pid").join(
        own.select("pid", "owner", "n_leaves", "saved"), "pid"
    )
    upwards = Window.partitionBy("path").orderBy(F.desc("depth"))
    below = along.select(
        "pid",
        *(
            F.sum(F.when(F.col("path") == F.col("owner"), F.col(c)).otherwise(0)).over(upwards).alias(c)
            for c in ("n_leaves", "saved")
        ),
    )
    sums = below.groupBy("pid").agg(*(F.sum(c).alias(c) for c in ("n_leaves", "saved")))
    return own.drop("n_leaves", "saved", "owner", "chars", "more").join(sums, "pid")


def nodes(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, turn, role, text)."""
    spark = conversations.sparkSession
    keys = kept(distinct_keys(rebuilt(conversations)), "trie-keys")
    held = keys.agg(F.sum(F.length("key"))).first()[0] or 0
    ranges = max(parallelism(spark), -(-held // RANGE_BYTES))
    ordered = keys.repartitionByRange(ranges, "key").sortWithinPartitions("key")
    found = kept(ordered.mapInArrow(_trees, _NODES_SQL), "trie-nodes")

    opened, settled = found.filter("open"), found.filter("NOT open")
    merged = kept(_merged(opened), "trie-open")
    parents = merged.select(F.col("pid").alias("parent_pid"), F.col("conv_id").alias("known"))
    # By range as well: a range holds few rows of a parent, whatever others hold of it.
    seen = opened.select("range", F.col("pid").alias("parent_pid")).distinct().join(parents, "parent_pid")
    inner = settled.join(seen, ["range", "parent_pid"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "known")
    )
    outer = merged.join(parents, "parent_pid", "left").withColumn("parent_conv_id", F.col("known"))
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends")
    every = inner.select(*names).unionByName(outer.select(*names))
    return every.select(
        *names[:-2],
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
