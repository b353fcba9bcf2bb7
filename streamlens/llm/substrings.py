"""Removal of long repeated word sequences by recompression.

Every document is rewritten in rounds: first runs of one word, then in each round
the pairs whose left symbol falls in one half and whose right symbol in the other
half of the names, get a new name.  A name is a hash of what it stands for, so
all tasks give equal sequences equal names without asking each other.  What a
symbol is depends only on the words that were looked at to form it (its context).
So equal windows of ``WINDOW`` words hold the same symbols among those whose
context lies inside the window, wherever the windows stand.

A window is filed under the longest such symbol (ties: the largest name; if there
is none, under its own hash).  Neighbouring windows mostly share that symbol and
travel together.  Only symbols that turn up twice are looked at further: their
windows are compared by 48-bit hashes of all their words, so two windows count as
equal if the symbol (59 bits of name) and the window hash agree.

Before anything is moved, a batch of documents settles the repeats within itself:
of equal windows only the earliest is sent on.  A passage that a third of all
documents share is thus sent once per batch, not once per document.

A word is removed if some window over it has an equal one that starts earlier: in
a document with a smaller doc_id, or earlier in the same document.

Defined results: a null or empty text has no words; rows that repeat a doc_id are
documents of equal rank, neither of which precedes the other; a null doc_id
precedes all others; extra columns are ignored.  Rows of equal doc_id are told apart by 64 bits of
their texts, so copies of a row share their spans, which are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm import arrays
from streamlens.llm.arrays import U64, mix
from streamlens.llm.tables import parallelism

WINDOW = 20
ROUNDS = 8
SLICE_BYTES = 1 << 20
BATCH_WORDS = 400_000
_NAME_BITS = 59


@dataclass
class Symbols:
    """Symbols in text order: words [a, b), context [lo, hi), and their row."""

    name: np.ndarray
    a: np.ndarray
    b: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    row: np.ndarray

    def take(self, at: np.ndarray) -> "Symbols":
        return Symbols(*(getattr(self, f)[at] for f in ("name", "a", "b", "lo", "hi", "row")))


def runs(words: np.ndarray, row: np.ndarray) -> Symbols:
    """Maximal runs of one word, each under one name; both neighbours were looked at."""
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(words))
    length = b - a
    name = words[a]
    long = length > 1
    name[long] = mix(name[long] + length[long].astype(U64) * U64(0x9E3779B97F4A7C15))
    a, b = a.astype(np.int32), b.astype(np.int32)
    return Symbols(name, a, b, a - 1, b + 1, row[a])


def pairs(old: Symbols, number: int) -> tuple[Symbols, np.ndarray]:
    """One round of pair naming; also which of the symbols are new."""
    count = len(old.name)
    salt = U64((number + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    left = (mix(old.name ^ salt) & U64(1)).astype(bool)
    joined = np.zeros(count, dtype=bool)
    beside = old.row[1:] == old.row[:-1]
    joined[:-1] = left[:-1] & ~left[1:] & beside
    second = np.zeros(count, dtype=bool)
    second[1:] = joined[:-1]
    lo, hi = old.lo.copy(), old.hi.copy()
    b, name = old.b.copy(), old.name.copy()
    first = np.flatnonzero(joined)
    b[first] = old.b[first + 1]
    name[first] = mix(old.name[first] * U64(0x9FB21C651E98DF25) + old.name[first + 1])
    # Who stays alone has looked at the neighbour it could have joined; the end
    # of a row counts as a word outside.
    alone = ~joined & ~second
    to_right = joined | alone & left
    to_left = alone & ~left
    for looks, step in ((to_right, 1), (to_left, -1)):
        at = np.flatnonzero(looks)
        other = at + step
        inside = (other >= 0) & (other < count)
        inside[inside] = old.row[other[inside]] == old.row[at[inside]]
        ends = at[~inside]
        if step > 0:
            hi[ends] = np.maximum(hi[ends], old.b[ends] + 1)
        else:
            lo[ends] = np.minimum(lo[ends], old.a[ends] - 1)
        at, other = at[inside], other[inside]
        lo[at] = np.minimum(lo[at], old.lo[other])
        hi[at] = np.maximum(hi[at], old.hi[other])
    new = Symbols(name, old.a, b, lo, hi, old.row)
    stays = np.flatnonzero(~second)
    return new.take(stays), joined[stays]


def window_keys(words: np.ndarray, bounds: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """For every word position, the key of the window that starts there; 0 if it has no symbol."""
    row = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    best = np.zeros(len(words), dtype=U64)

    def file(symbols: Symbols) -> None:
        room = size - (symbols.hi - symbols.lo)
        fits = (
            (room >= 0)
            & (symbols.lo >= bounds[symbols.row])
            & (symbols.hi <= bounds[symbols.row + 1])
            & (symbols.b - symbols.a > 1)
        )
        room, hi = room[fits], symbols.hi[fits]
        rank = (symbols.b[fits] - symbols.a[fits]).astype(U64) << U64(_NAME_BITS)
        rank |= symbols.name[fits] >> U64(64 - _NAME_BITS)
        for step in range(size):
            reach = room >= step
            if not reach.any():
                break
            room, hi, rank = room[reach], hi[reach], rank[reach]
            start = hi - size + step
            held = start >= 0
            better = np.flatnonzero(held)
            better = better[rank[better] > best[start[better]]]
            best[start[better]] = rank[better]

    symbols = runs(words, row)
    file(symbols)
    for number in range(ROUNDS):
        symbols, new = pairs(symbols, number)
        file(symbols.take(np.flatnonzero(new)))
    return best


def _repeats(group: np.ndarray, rank: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which of the windows, sorted by group, rank, row and start, come too late.

    ``group`` marks the first of equal windows.  Of a document of the least rank
    the first window stays, of any other none.
    """
    first = np.flatnonzero(group)
    least = np.repeat(rank[first], np.diff(np.append(first, len(group))))
    again = np.zeros(len(group), dtype=bool)
    again[1:] = ~group[1:] & (row[1:] == row[:-1])
    return (rank > least) | again


def _spans(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring window starts as (row, first, count); sorted by row and start."""
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return row[first], start[first], np.diff(np.append(first, len(row)))


_FOUND = pa.schema(
    [("bucket", pa.int32())]
    + [(n, pa.binary()) for n in ("ids", "tags", "keys", "docs", "starts", "counts", "hashes")]
)
_LATER = pa.schema(
    [("bucket", pa.int32())] + [(n, pa.binary()) for n in ("ids", "tags", "starts", "counts")]
)
_SPANS = pa.schema([("rank", pa.int64()), ("tag", pa.int64()), ("spans", pa.binary())])
_LATE = -1  # in ``counts``: spans that are already known to come too late


class _Batch:
    """Documents gathered until there are enough words to settle among themselves."""

    def __init__(self) -> None:
        self.ids: list[np.ndarray] = []
        self.tags: list[np.ndarray] = []
        self.words: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.count = 0

    def add(self, batch: pa.RecordBatch) -> None:
        words = arrays.split_words(batch.column("text"))
        self.words.append(words.hashes())
        self.lengths.append(np.diff(words.bounds))
        self.ids.append(batch.column("rank").to_numpy(zero_copy_only=False))
        self.tags.append(batch.column("tag").to_numpy(zero_copy_only=False))
        self.count += len(words.starts)

    def settle(self, buckets: int) -> Iterator[pa.RecordBatch]:
        ids, tags = np.concatenate(self.ids), np.concatenate(self.tags)
        words, lengths = np.concatenate(self.words), np.concatenate(self.lengths)
        # In order of doc_id, so that position is precedence.
        order = np.lexsort((tags, ids))
        begins = np.cumsum(lengths) - lengths
        if len(order) and (np.diff(order) != 1).any():
            words = np.concatenate([words[begins[i] : begins[i] + lengths[i]] for i in order])
        ids, tags, lengths = ids[order], tags[order], lengths[order]
        bounds = np.append(0, np.cumsum(lengths))
        start, row = arrays.windows(bounds, WINDOW)
        if not len(start):
            return
        hashes = arrays.sequence_hashes(words, start, start + WINDOW)
        keys = window_keys(words, bounds)[start]
        keys = np.where(keys == 0, hashes, keys)
        by = np.argsort(hashes, kind="stable")
        group = np.ones(len(by), dtype=bool)
        group[1:] = hashes[by[1:]] != hashes[by[:-1]]
        late = np.zeros(len(by), dtype=bool)
        late[by] = _repeats(group, ids[row[by]], row[by])
        local = start - bounds[row]
        if late.any():
            at, first, count = _spans(row[late], local[late])
            # They only pass through; which bucket does not matter, but not all to one.
            any_bucket = int(mix(hashes[:1])[0] % U64(buckets))
            yield self._packed(any_bucket, ids, tags, at, first, _LATE * count, None, None)
        early = ~late
        row, local, keys, hashes = row[early], local[early], keys[early], hashes[early]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (
            (keys[1:] != keys[:-1]) | (row[1:] != row[:-1]) | (local[1:] != local[:-1] + 1)
        )
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(row)))
        bucket = (mix(keys[first]) >> U64(33)) % U64(buckets)
        to = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[to], np.arange(buckets + 1, dtype=U64))
        for b in range(buckets):
            own = to[edges[b] : edges[b + 1]]
            if len(own):
                picked = _expand(first[own], count[own])
                yield self._packed(
                    b, ids, tags, row[first[own]], local[first[own]], count[own], keys[first[own]], hashes[picked]
                )

    def _packed(self, bucket, ids, tags, row, start, count, keys, hashes) -> pa.RecordBatch:
        docs, at = np.unique(row, return_inverse=True)
        values = {
            "ids": ids[docs].astype("<i8"),
            "tags": tags[docs].astype("<i8"),
            "keys": np.empty(0, "<u8") if keys is None else keys.astype("<u8"),
            "docs": at.astype("<u4"),
            "starts": start.astype("<u4"),
            "counts": count.astype("<i4" if keys is None else "<u1"),
            # The upper six bytes of each.
            "hashes": np.empty(0, "u1")
            if hashes is None
            else hashes.astype("<u8").view("u1").reshape(-1, 8)[:, 2:],
        }
        columns = [pa.array([bucket], pa.int32())]
        columns += [pa.array([v.tobytes()], pa.binary()) for v in values.values()]
        return pa.RecordBatch.from_arrays(columns, schema=_FOUND)


def _expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The positions of all spans, one after the other."""
    ahead = np.cumsum(count) - count
    return np.arange(int(count.sum())) - np.repeat(ahead - first, count)


def _file(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Batch()
        for batch in arrays.sliced(batches, "text", SLICE_BYTES):
            held.add(batch)
            if held.count >= BATCH_WORDS:
                yield from held.settle(buckets)
                held = _Batch()
        if held.count:
            yield from held.settle(buckets)

    return run


def _by_document(width: int, ids, tags, row, start, count) -> Iterator[pa.RecordBatch]:
    """Spans of late windows, packed by the bucket of their document."""
    place = (mix(mix(ids[row].astype(U64)) ^ tags[row].astype(U64)) >> U64(33)) % U64(width)
    order = np.argsort(place, kind="stable")
    edges = np.searchsorted(place[order], np.arange(width + 1, dtype=U64))
    for bucket in range(width):
        at = order[edges[bucket] : edges[bucket + 1]]
        if len(at):
            values = (
                ids[row[at]].astype("<i8"), tags[row[at]].astype("<i8"), start[at].astype("<u4"), count[at].astype("<u4")
            )
            columns = [pa.array([bucket], pa.int32())]
            columns += [pa.array([v.tobytes()], pa.binary()) for v in values]
            yield pa.RecordBatch.from_arrays(columns, schema=_LATER)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with all its spans, in order."""
    found: dict[str, list[np.ndarray]] = {n: [] for n in _LATER.names[1:]}
    kinds = {"ids": "<i8", "tags": "<i8", "starts": "<u4", "counts": "<u4"}
    for batch in batches:
        for name, kind in kinds.items():
            found[name] += [np.frombuffer(b, kind) for b in batch.column(name).to_pylist()]
    if not found["ids"]:
        return
    ids, tags, start, count = (np.concatenate(found[n]) for n in kinds)
    order = np.lexsort((start, tags, ids))
    ids, tags = ids[order], tags[order]
    packed = np.stack([start[order], count[order]], axis=1)
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])
    first = np.flatnonzero(new)
    ends = np.append(first[1:], len(ids))
    spans = [packed[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist())]
    for at in range(0, len(first), 4096):
        part = slice(at, at + 4096)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[first[part]]), pa.array(tags[first[part]]), pa.array(spans[part], pa.binary())],
            schema=_SPANS,
        )


def _compare(width: int):
    """Compares the windows of a partition; spans go to ``width`` buckets of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _late_spans(batches, width)

    return run


def _late_spans(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Windows filed under the same symbol, all in this partition: the late ones."""
    ids, tags, keys, docs, starts, counts, hashes = ([] for _ in range(7))
    known = 0
    for batch in batches:
        for cells in zip(*(batch.column(n).to_pylist() for n in _FOUND.names[1:])):
            own = dict(zip(_FOUND.names[1:], cells))
            of = np.frombuffer(own["docs"], "<u4").astype(np.int64)
            at = np.frombuffer(own["starts"], "<u4").astype(np.int64)
            own_ids, own_tags = np.frombuffer(own["ids"], "<i8"), np.frombuffer(own["tags"], "<i8")
            if not own["keys"]:
                late = _LATE * np.frombuffer(own["counts"], "<i4").astype(np.int64)
                yield from _by_document(width, own_ids, own_tags, of, at, late)
                continue
            ids.append(own_ids)
            tags.append(own_tags)
            keys.append(np.frombuffer(own["keys"], "<u8"))
            docs.append((of + known).astype(np.int32))
            starts.append(at.astype(np.int32))
            counts.append(np.frombuffer(own["counts"], "<u1").astype(np.int32))
            six = np.frombuffer(own["hashes"], "u1").reshape(-1, 6)
            whole = np.zeros((len(six), 8), dtype="u1")
            whole[:, 2:] = six
            hashes.append(whole.view("<u8").reshape(-1))
            known += len(own_ids)
    if not keys:
        return
    ids, tags, keys, docs, starts, counts = map(np.concatenate, (ids, tags, keys, docs, starts, counts))
    ahead = np.cumsum(counts) - counts
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    shared = np.zeros(len(keys), dtype=bool)
    shared[order[1:][same]] = shared[order[:-1][same]] = True
    at = np.flatnonzero(shared)
    if not len(at):
        return
    every = np.concatenate(hashes)
    hashes.clear()
    span = np.repeat(at, counts[at])
    within = _expand(np.zeros(len(at), dtype=np.int64), counts[at])
    start, doc = starts[span] + within, docs[span]
    window, key = every[ahead[span] + within], keys[span]
    place = np.empty(len(ids), dtype=np.int64)
    place[np.lexsort((tags, ids))] = np.arange(len(ids))
    by = np.lexsort((start, place[doc], window, key))
    doc, start, window, key = doc[by], start[by], window[by], key[by]
    group = np.ones(len(by), dtype=bool)
    group[1:] = (window[1:] != window[:-1]) | (key[1:] != key[:-1])
    late = _repeats(group, ids[doc], doc)
    if late.any():
        doc, start = doc[late], start[late]
        order = np.lexsort((start, doc))
        yield from _by_document(width, ids, tags, *_spans(doc[order], start[order]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    for batch in batches:
        texts, spans = batch.column("text").fill_null("").to_pylist(), batch.column("spans").to_pylist()
        total, removed, digests, kept = [], [], [], []
        for text, late in zip(texts, spans):
            words = text.encode().split()
            total.append(len(words))
            if late:
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                first, count = np.frombuffer(late, "<u4").reshape(-1, 2).astype(np.int64).T
                np.add.at(edges, first, 1)
                np.add.at(edges, first + count + WINDOW - 1, -1)
                covered = np.cumsum(edges[:-1]) > 0
                words = [words[i] for i in np.flatnonzero(~covered).tolist()]
            removed.append(total[-1] - len(words))
            text = b" ".join(words)
            digests.append(hashlib.sha256(text).hexdigest())
            kept.append(text.decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(digests, pa.string()), pa.array(kept, pa.string())],
            names=names,
        )


def _tag(text: Column) -> Column:
    """Tells rows of equal doc_id apart: 64 bits of their texts."""
    return F.xxhash64(text)


def late_windows(documents: DataFrame) -> DataFrame:
    """(rank, tag, spans): per document the starts of windows that came earlier already."""
    width = parallelism(documents.sparkSession)
    # What a task compares is held in memory at once, so it gets half a partition.
    buckets = 2 * width
    kinds = "bucket int, " + ", ".join(f"{n} binary" for n in _FOUND.names[1:])
    later = "bucket int, " + ", ".join(f"{n} binary" for n in _LATER.names[1:])
    found = documents.select("rank", "tag", "text").mapInArrow(_file(buckets), kinds)
    return (
        found.repartitionById(buckets, "bucket")
        .mapInArrow(_compare(width), later)
        .repartitionById(width, "bucket")
        .mapInArrow(_gather, "rank long, tag long, spans binary")
    )


def remove_repeats(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and ``kept``, the text that is left."""
    ranked = documents.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("rank"),
        _tag(F.col("text")).alias("tag"),
        "text",
    )
    late = late_windows(ranked).hint("shuffle_hash")
    return (
        ranked.join(late, ["rank", "tag"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    )
