"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

Texts are compared as bytes of a normal form: ASCII letters in lower case, and any
run of other ASCII characters but digits as one space.

A passage of m bytes with at most e = ``EDIT_RATE`` * m edits shares at least
m - q + 1 - q * e of its q-grams with the text region it became, and their
diagonals (position in the text minus position in the passage) lie within e of each
other.  So q-gram hits are counted in bands of 2 (e + 1) diagonals, each overlapping
the next by half; only where a band reaches the bound is the passage aligned with the
text, along the band.

The passages are the query set.  They go to the tasks in blocks of bounded size; more
passages mean more passes, never a larger block.

Defined results: a null or empty text holds nothing; passages that are null or
shorter than a q-gram in normal form are never found; equal passages are
reported each; rows that repeat a doc_id are judged one by one; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.llm import arrays
from streamlens.llm.arrays import U64

Q = 10
EDIT_RATE = 0.08
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
_TABLE_BITS = 24

_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[65:91] += 32
_NORMAL[[c for c in range(128) if not chr(c).isalnum()]] = 0x20


def normal_form(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normal form of consecutive texts and the offsets into it."""
    out = _NORMAL[data]
    space = out == 0x20
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[offsets[:-1][offsets[:-1] < len(out)]] = True
    return out[keep], np.append(0, np.cumsum(keep))[offsets]


def normal_bytes(text: str) -> bytes:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return normal_form(data, np.array([0, len(data)]))[0].tobytes().strip()


def q_grams(data: np.ndarray) -> np.ndarray:
    """One 64-bit code for the q bytes from every position; the last q - 1 are cut short."""
    padded = np.zeros(len(data) + 16, dtype=np.uint8)
    padded[: len(data)] = data
    first = np.ndarray((len(data),), dtype="<u8", buffer=padded, strides=(1,))
    second = np.ndarray((len(data),), dtype="<u8", buffer=padded, offset=Q - 8, strides=(1,))
    codes = first * U64(0x9E3779B97F4A7C15)
    codes ^= codes >> U64(29)
    codes += second
    codes *= U64(0xBF58476D1CE4E5B9)
    return codes


def edits_allowed(length: int) -> int:
    """As many edits as the rate allows and the lemma still asks for one q-gram."""
    return min(int(EDIT_RATE * length), (length - Q) // Q)


class Passages:
    """A block of passages with an index of their q-grams."""

    def __init__(self, rows: list[tuple[int, str]]):
        normal = [(item, normal_bytes(text)) for item, text in rows if text]
        self.items = [(item, text) for item, text in normal if len(text) >= Q]
        self.edits = np.array([edits_allowed(len(t)) for _, t in self.items], dtype=np.int64)
        lengths = np.array([len(t) for _, t in self.items], dtype=np.int64)
        self.bound = lengths - Q + 1 - Q * self.edits
        codes, owners, places = [], [], []
        for number, (_, text) in enumerate(self.items):
            own = q_grams(np.frombuffer(text, dtype=np.uint8))[: len(text) - Q + 1]
            codes.append(own)
            owners.append(np.full(len(own), number))
            places.append(np.arange(len(own)))
        flat = np.concatenate(codes) if codes else np.empty(0, dtype=U64)
        by = np.argsort(flat, kind="stable")
        self.codes, self.first, self.count = np.unique(flat[by], return_index=True, return_counts=True)
        self.owner = np.concatenate(owners)[by] if codes else flat.view(np.int64)
        self.place = np.concatenate(places)[by] if codes else flat.view(np.int64)
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[self.codes >> U64(64 - _TABLE_BITS)] = True

    def hits(self, data: np.ndarray, offsets: np.ndarray):
        """(row, passage, position in the row, position in the passage) of shared q-grams."""
        codes = q_grams(data)
        at = np.flatnonzero(self.table[codes >> U64(64 - _TABLE_BITS)])
        found = np.minimum(np.searchsorted(self.codes, codes[at]), max(len(self.codes) - 1, 0))
        real = self.codes[found] == codes[at] if len(self.codes) else np.zeros(len(at), dtype=bool)
        at, found = at[real], found[real]
        row = np.searchsorted(offsets, at, side="right") - 1
        whole = at + Q <= offsets[row + 1]
        at, found, row = at[whole], found[whole], row[whole]
        count = self.count[found]
        ahead = np.cumsum(count) - count
        every = np.arange(int(count.sum())) + np.repeat(self.first[found] - ahead, count)
        local = np.repeat(at - offsets[row], count)
        return np.repeat(row, count), self.owner[every], local, self.place[every]

    def find(self, texts: pa.Array) -> list[list[tuple[int, int]]]:
        """Per text the (item, edits) of the passages that it holds."""
        found: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
        data, offsets = normal_form(*arrays.flat_bytes(texts))
        row, owner, local, place = self.hits(data, offsets)
        if not len(row):
            return found
        width = self.edits[owner] + 1
        diagonal = local - place
        band = diagonal // width
        # Band k spans the diagonals [k, k + 2) * width: a hit counts for two bands.
        key = np.stack([np.tile(row, 2), np.tile(owner, 2), np.concatenate([band, band - 1])], axis=1)
        order = np.lexsort(key.T[::-1])
        key = key[order]
        new = np.append(True, (key[1:] != key[:-1]).any(axis=1))
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(key)))
        full = counts >= self.bound[key[first, 1]]
        best: dict[tuple[int, int], int] = {}
        for at, number, band_at in key[first[full]].tolist():
            if best.get((at, number)) == 0:
                continue
            text = data[offsets[at] : offsets[at + 1]]
            edits = self.align(text, number, band_at)
            if edits is not None:
                best[at, number] = min(edits, best.get((at, number), edits))
        for (at, number), edits in best.items():
            found[at].append((self.items[number][0], edits))
        return found

    def align(self, text: np.ndarray, number: int, band: int) -> int | None:
        """Fewest edits of the passage against the text along a band, None beyond those allowed."""
        passage, most = self.items[number][1], int(self.edits[number])
        low = band * (most + 1) - most
        high = (band + 2) * (most + 1) + most
        return banded_edits(np.frombuffer(passage, dtype=np.uint8), text, low, high, most)


def banded_edits(passage: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> int | None:
    """Least edits that turn ``passage`` into some part of ``text`` within diagonals [low, high]."""
    diagonals = np.arange(low, high + 1)
    far = most + 1
    # cost[d]: the first i bytes of the passage against text that ends before i + d.
    cost = np.where((diagonals >= 0) & (diagonals <= len(text)), 0, far)
    steps = np.arange(len(diagonals))
    for i in range(len(passage)):
        ends = diagonals + i  # the byte of the text that passage[i] meets
        inside = (ends >= 0) & (ends < len(text))
        same = np.zeros(len(diagonals), dtype=bool)
        same[inside] = text[ends[inside]] == passage[i]
        now = np.where(inside, cost + ~same, far)
        now[:-1] = np.minimum(now[:-1], cost[1:] + 1)
        valid = (ends + 1 >= 0) & (ends + 1 <= len(text))
        now = np.where(valid, now, far)
        now = np.minimum.accumulate(now - steps) + steps
        now = np.where(valid, np.minimum(now, far), far)
        if now.min() > most:
            return None
        cost = now
    return int(cost.min())


def _blocks(benchmark: DataFrame) -> Iterator[Passages]:
    """The passages in blocks of about ``BLOCK_BYTES``, one at a time."""
    rows = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("size")).first()["size"] or 0
    count = -(-size // BLOCK_BYTES)
    for block in range(count):
        here = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
        yield Passages([(r["item_id"], r["text"]) for r in here.orderBy("item_id", "text").collect()])


def find(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` with ``leaks``: item_id and edits of every benchmark passage found."""
    leak = "array<struct<item_id: long, edits: long>>"
    out = documents.withColumn("leaks", F.expr(f"cast(array() AS {leak})"))
    for passages in _blocks(benchmark):
        out = out.mapInArrow(_adding(passages), out.schema)
    return out


def _adding(passages: Passages):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.sliced(batches, "text", SLICE_BYTES):
            found = passages.find(batch.column("text"))
            before = batch.column("leaks").to_pylist()
            leaks = [
                old + [{"item_id": i, "edits": e} for i, e in new] for old, new in zip(before, found)
            ]
            at = batch.schema.get_field_index("leaks")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(leaks, kind), *batch.columns[at + 1 :]], names=batch.schema.names
            )

    return run


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage."""
    return find(documents, benchmark).filter(F.size("leaks") == 0).drop("leaks")
