"""Approximate nearest neighbours by cross-polytope hashing.

A hash of a vector is the axis, with its sign, that it is nearest to after a fast
pseudo-rotation (three rounds of sign flips and a Hadamard transform).  A cell of a
table is two such hashes, of two rotations of its own.  In every table a query looks
into the cells that miss its best ones by least (multiprobe), a part of all cells that
falls with the number of vectors, as neighbours get nearer; what it meets there is
ranked by the exact cosine of the original vectors in double precision.

Vectors and queries travel by the first hash of a cell; inside, a query is compared with
the vectors of the second hashes that it looks for.

Cells are split into blocks of at most about ``BLOCK_ROWS`` vectors, and their
queries into blocks of about ``BLOCK_QUERIES``, however many a cell holds; a block
of vectors meets a block of queries in one task.

A query that meets fewer vectors than it asks for goes on to all others: it is
compared with every vector, in blocks.  So no query lacks a candidate that is there.

Defined results: vectors that are null, zero or hold null or non-finite
components take no part; vectors of different lengths never meet; rows with the
same vec_id count as one (the smallest vector); a query with fewer candidates
returns all of them; ties go to the smaller vec_id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlens.llm.tables import kept, parallelism

TABLES = 8
# Part of the cells that a query looks into per table, for so many vectors.  With four times
# as many vectors it is 0.7 of that.
PROBED, PROBED_AT = 0.06, 2000
ROUNDS = 3
BLOCK_ROWS = 8192
BLOCK_QUERIES = 8192


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The normalised fast Hadamard transform of every row; the width is a power of two."""
    width = rows.shape[1]
    out, half = rows, 1
    while half < width:
        pairs = out.reshape(len(rows), width // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        out = out.reshape(len(rows), width)
        half *= 2
    return out / np.sqrt(width)


def rotated(rows: np.ndarray, table: int) -> np.ndarray:
    width = 1 << max(rows.shape[1] - 1, 1).bit_length() if rows.shape[1] > 1 else 2
    out = np.zeros((len(rows), width))
    out[:, : rows.shape[1]] = rows
    signs = np.random.Generator(np.random.PCG64([table, width]))
    for _ in range(ROUNDS):
        out = hadamard(out * signs.choice([-1.0, 1.0], width))
    return out


def signed_axes(rows: np.ndarray, table: int) -> list[np.ndarray]:
    """How near every row is to every signed axis, in the two rotations of a table."""
    both = []
    for part in (2 * table, 2 * table + 1):
        turned = rotated(rows, part)
        both.append(np.concatenate([turned, -turned], axis=1))
    return both


def probes(axes: int, vectors: int) -> int:
    """How many cells of a table a query looks into."""
    part = min(1.0, PROBED * (PROBED_AT / max(vectors, 1)) ** 0.25)
    return max(1, round(axes * axes * part))


def probed(near: list[np.ndarray], count: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, first hash, second hashes) of the ``count`` cells that miss the best by least."""
    axes = near[0].shape[1]
    # How many axes of a rotation can be among the best cells at all.
    reach = min(axes, count)
    miss = [n.max(axis=1, keepdims=True) - n for n in near]
    order = [np.argsort(m, axis=1, kind="stable")[:, :reach] for m in miss]
    short = [np.take_along_axis(m, o, axis=1) ** 2 for m, o in zip(miss, order)]
    for row in range(len(near[0])):
        sums = (short[0][row][:, None] + short[1][row][None, :]).reshape(-1)
        best = np.argpartition(sums, count - 1)[:count] if count < len(sums) else np.arange(len(sums))
        first, second = order[0][row][best // reach], order[1][row][best % reach]
        by = np.argsort(first, kind="stable")
        edges = np.flatnonzero(np.diff(first[by], prepend=-1))
        for at, codes in zip(edges, np.split(second[by], edges[1:])):
            yield row, int(first[by[at]]), codes


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and the vector in doubles, of the rows that take part."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long"), vector.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .filter(~bad & F.exists("vector", lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
    )


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, vectors) for every vector length in the batch."""
    lists = batch.column("vector")
    lengths = lists.value_lengths().to_numpy()
    for dims in np.unique(lengths):
        at = np.flatnonzero(lengths == dims)
        values = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield at, values.reshape(len(at), dims)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


_ROWS = "dims int, table int, cell int, code int, vec_id long, vector array<double>"
_ASKED = "dims int, table int, cell int, codes array<int>, vec_id long, vector array<double>"
# Queries that are hashed at once: each becomes some hundred rows.
QUERY_SLICE = 64


def _emitted(batch: pa.RecordBatch, dims: int, table: int, at, cell, code, name: str) -> pa.RecordBatch:
    taken = batch.select(["vec_id", "vector"]).take(pa.array(at))
    fixed = (np.full(len(at), v, dtype=np.int32) for v in (dims, table))
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, fixed), pa.array(cell, pa.int32()), code, *taken.columns],
        names=["dims", "table", "cell", name, *taken.schema.names],
    )


def hashed(vectors: DataFrame) -> DataFrame:
    """Every vector once per table, with the two hashes of its cell, ``cell`` and ``code``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows in _matrices(batch):
                unit = _unit(rows)
                for table in range(TABLES):
                    cell, code = (n.argmax(axis=1).astype(np.int32) for n in signed_axes(unit, table))
                    yield _emitted(batch, rows.shape[1], table, at, cell, pa.array(code), "code")

    return vectors.mapInArrow(run, _ROWS)


def asked_cells(queries: DataFrame) -> DataFrame:
    """Queries once per table and first hash they look for, with the second ones in ``codes``.

    ``there`` of a query is the number of vectors of its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, QUERY_SLICE):
                batch = whole.slice(start, QUERY_SLICE)
                there = batch.column("there").to_numpy()
                for at, rows in _matrices(batch):
                    unit = _unit(rows)
                    for table in range(TABLES):
                        near = signed_axes(unit, table)
                        count = probes(near[0].shape[1], int(there[at[0]]))
                        found = [(at[r], c, codes) for r, c, codes in probed(near, count)]
                        row, cell, codes = zip(*found)
                        listed = pa.array([c.tolist() for c in codes], pa.list_(pa.int32()))
                        yield _emitted(batch, rows.shape[1], table, row, cell, listed, "codes")

    return queries.mapInArrow(run, _ASKED)


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of one vector with every row, the same for equal rows wherever they stand.

    Scaling by powers of two changes no digit and keeps squares in range.
    """
    query = np.ldexp(query, -np.frexp(np.abs(query).max())[1])
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    dots = (rows * query).sum(axis=1)
    return dots / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def _best(queries: pd.DataFrame, block: pd.DataFrame, count: int) -> Iterator[tuple]:
    """The nearest rows of one block for each of its queries, among those of the codes it looks for."""
    order = np.argsort(block["code"].to_numpy(), kind="stable")
    code = block["code"].to_numpy()[order]
    rows, ids = np.stack(block["vector"].to_numpy())[order], block["vec_id"].to_numpy()[order]
    unit = _unit(rows)
    asked = np.stack(queries["vector"].to_numpy())
    wanted = _unit(asked)
    for i, (query, codes) in enumerate(zip(queries["vec_id"].to_numpy(), queries["codes"])):
        first, last = (np.searchsorted(code, codes, side) for side in ("left", "right"))
        at = np.concatenate([np.arange(a, b) for a, b in zip(first, last)])
        at = at[ids[at] != query] if len(at) else at
        if not len(at):
            continue
        near = unit[at] @ wanted[i]
        # Rounding must not decide among equals, so near ties are looked at exactly.
        least = -np.partition(-near, min(count, len(at)) - 1)[min(count, len(at)) - 1]
        at = at[near >= least - 1e-9]
        exact = cosines(asked[i], rows[at])
        for k in np.lexsort((ids[at], -exact))[:count]:
            yield query, ids[at[k]], exact[k]


def _blocks(rows: DataFrame, key: list[str], size: int, name: str) -> DataFrame:
    """The number of blocks per cell, one row per cell: tables times signed axes at most."""
    count = F.greatest(F.ceil(F.count(F.lit(1)) / size), F.lit(1)).cast("int")
    return rows.groupBy(*key).agg(count.alias(name))


def _met(held: DataFrame, looking: DataFrame, key: list[str], count: int) -> DataFrame:
    """The nearest rows of every block for the queries that look into its cell.

    Both have ``key``, vec_id and vector; rows have a code, queries the codes they look for.
    """
    sizes = _blocks(held, key, BLOCK_ROWS, "__rows").join(
        _blocks(looking, key, BLOCK_QUERIES, "__queries"), key
    )

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        mine = F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int")
        with_sizes = rows.join(F.broadcast(sizes), key)
        return with_sizes.withColumn(f"{own}_block", mine).withColumn(f"{other}_block", every).drop(
            "__rows", "__queries"
        )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = list(_best(left, right, count)) if len(left) and len(right) else []
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    every = [*key, "__rows_block", "__queries_block"]
    asked, there = dealt(looking, "__queries", "__rows"), dealt(held, "__rows", "__queries")
    return asked.groupBy(*every).cogroup(there.groupBy(*every)).applyInPandas(
        meet, "query_id long, vec_id long, score double"
    )


def _ranked(met: DataFrame, count: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= count)
        .select("query_id", "rank", "vec_id", "score")
    )


def search(vectors: DataFrame, queries: DataFrame, count: int) -> DataFrame:
    """The ``count`` nearest found of every query: query_id, rank, vec_id, score.

    Both sides have vec_id and embedding.  Moved are the vectors once per table
    and the queries once per table and first hash they look for.
    """
    rows = kept(hashed(usable(vectors)), "ann-cells")
    # Every vector is in one cell of the first table.
    every = rows.filter("table = 0").select("dims", "vec_id", "vector")
    there = every.groupBy("dims").agg(F.count(F.lit(1)).alias("there"))
    wanted = usable(queries).withColumn("dims", F.size("vector")).join(there, "dims")
    # Few, but much work each: dealt out, or they would share a task.
    wanted = kept(wanted.repartition(parallelism(rows.sparkSession), "vec_id"), "ann-queries")
    met = _met(rows, asked_cells(wanted), ["dims", "table", "cell"], count)
    found = kept(_ranked(met, count), "ann-found")
    got = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("__got"))
    enough = F.least(F.lit(count), F.col("there"))
    short = (
        wanted.join(got, "vec_id", "left")
        .filter(F.coalesce("__got", F.lit(0)) < enough)
        .select("dims", "vec_id", "vector")
    )
    short = kept(short, "ann-short")
    alike = F.lit(0)
    all_codes = short.withColumn("codes", F.array(alike))
    completed = _ranked(_met(every.withColumn("code", alike), all_codes, ["dims"], count), count)
    others = short.select(F.col("vec_id").alias("query_id"))
    return found.join(others, "query_id", "left_anti").unionByName(completed)
