"""Token ids as flat binary files that can be memory-mapped.

A folder holds, for every part, ``part-00000.bin`` (the ids of its documents one
after the other, little-endian unsigned 16-bit if every id fits, else 32-bit),
``part-00000.idx`` (64-bit global start of every document, and the end) and
``part-00000.ids`` (64-bit doc_id), plus ``manifest`` (Parquet: documents, ids and
bases of every part).  Parts follow each other in ascending doc_id order; their
bases are prefix sums over the parts.

Defined results: a null or empty text is the end id alone; a null doc_id comes
first and stays null; rows with equal doc_id follow each other by text; an empty
table gives no parts.  The string of a special token inside a text is that token, as
the tokenizer has it by default.  Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamlens.llm import arrays
from streamlens.llm.tables import parallelism

SLICE_BYTES = 1 << 20
# Pieces that a worker remembers, at about 24 bytes each; beyond, it starts anew.
CACHED_PIECES = 600_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts can be cut so that the ids of the pieces are those of the text.

    The byte-level pre-tokenizer never joins anything but white space to the white
    space behind it, nor a letter to a full stop or comma behind it.  Fewer cuts are
    as right: none is made behind what may be white space beyond ASCII.  The special
    token of the vocabulary holds none of the characters at which pieces are cut.
    """
    cut = np.zeros(len(data), dtype=bool)
    if len(data) > 1:
        space = (data == 0x20) | (data == 0x0A)
        cut[1:] = space[1:] & (data[:-1] > 0x20)
        wide = np.zeros(len(data), dtype=bool)  # ends a character that may be white space
        wide[1:] = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        wide[2:] |= (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3)
        cut[1:] &= ~wide[:-1]
        cut[1:] |= ((data[1:] == 0x2E) | (data[1:] == 0x2C)) & _LETTER[data[:-1]]
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


# What may be white space beyond ASCII, as UTF-8.
_WIDE_END = re.compile(rb"(?:\xC2[\x85\xA0]|[\xE1-\xE3][\x80-\xBF]{2})\Z")


class PieceEncoder:
    """Encodes whole texts; a piece that a worker has met before is looked up by its hash.

    Pieces are known by 64-bit hashes of their bytes.
    """

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._width = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, at in vocabulary.items():
            self._width[at] = len(token)  # one character of a byte-level token is one byte
        self._dtype = np.dtype(dtype)
        self._forget()

    def _forget(self) -> None:
        self._hashes = np.empty(0, dtype=np.uint64)
        self._first = np.empty(0, dtype=np.int64)
        self._count = np.empty(0, dtype=np.int32)
        self._ids = np.empty(0, dtype=self._dtype)

    def _library(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Ids of the pieces one after the other, how many each has, and the order they are in."""
        # Pieces that start with a space or line end can stand behind each other.
        beside, alone = [], []
        for k, piece in enumerate(pieces):
            ends_wide = piece[-1] <= 0x20 or piece[-1] >= 0x80 and _WIDE_END.search(piece)
            (alone if ends_wide or piece[0] not in b" \n" else beside).append(k)
        ids, counts = [], []
        for at in range(0, len(beside), 20_000):
            part = [pieces[k] for k in beside[at : at + 20_000]]
            encoded = self._tokenizer.encode_batch_fast([b"".join(part).decode()], add_special_tokens=False)
            found = np.array(encoded[0].ids, dtype=np.int64)
            ends = np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)))
            cuts = np.searchsorted(np.cumsum(self._width[found]), ends, side="left") + 1
            ids.append(found)
            counts.append(np.diff(cuts, prepend=0))
        for one in self._tokenizer.encode_batch_fast(
            [pieces[k].decode() for k in alone], add_special_tokens=False
        ):
            ids.append(np.array(one.ids, dtype=np.int64))
            counts.append(np.array([len(one.ids)]))
        return np.concatenate(ids).astype(self._dtype), np.concatenate(counts), beside + alone

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        ids, counts, order = self._library(pieces)
        if len(self._hashes) + len(hashes) > CACHED_PIECES:
            self._forget()
        first, count = np.empty(len(order), np.int64), np.empty(len(order), np.int32)
        first[order] = len(self._ids) + np.cumsum(counts) - counts
        count[order] = counts
        at = np.searchsorted(self._hashes, hashes)
        self._hashes = np.insert(self._hashes, at, hashes)
        self._first = np.insert(self._first, at, first)
        self._count = np.insert(self._count, at, count)
        self._ids = np.concatenate([self._ids, ids])

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self._hashes):
            return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        return at, self._hashes[at] == hashes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        data, offsets = arrays.flat_bytes(texts)
        starts = piece_starts(data, offsets)
        if not len(starts):
            return np.empty(0, dtype=self._dtype), np.zeros(len(texts), dtype=np.int64)
        ends = np.append(starts[1:], len(data))
        hashes, which = np.unique(arrays.byte_hashes(data, starts, ends), return_inverse=True)
        at, known = self._find(hashes)
        if not known.all():
            sample = np.empty(len(hashes), dtype=np.int64)
            sample[which[::-1]] = np.arange(len(which))[::-1]
            new = np.flatnonzero(~known)
            whole = data.tobytes()
            before = len(self._hashes)
            self._learn(hashes[new], [whole[starts[k] : ends[k]] for k in sample[new].tolist()])
            if len(self._hashes) < before:  # it has started anew: what was known is met again
                gone = np.flatnonzero(known)
                self._learn(hashes[gone], [whole[starts[k] : ends[k]] for k in sample[gone].tolist()])
            at, _ = self._find(hashes)
        first, count = self._first[at][which], self._count[at][which].astype(np.int64)
        ahead = np.cumsum(count)
        ids = self._ids[np.arange(int(ahead[-1])) + np.repeat(first - (ahead - count), count)]
        upto = np.append(0, ahead)[np.searchsorted(starts, offsets)]
        return ids, np.diff(upto)


_ENCODERS: dict[tuple[str, str], PieceEncoder] = {}


def _encoder(path: str, dtype: str) -> PieceEncoder:
    """One encoder per worker process, kept between tasks."""
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = PieceEncoder(path, dtype)
    return _ENCODERS[path, dtype]


def id_type(tokenizer: str, end_id: int) -> str:
    from tokenizers import Tokenizer

    largest = max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) - 1, end_id)
    return "<u2" if largest < 1 << 16 else "<u4"


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _put(files: fs.FileSystem, path: str, data) -> None:
    """Write a file under another name first, so that a file that is there is whole."""
    draft = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        out.write(data)
    files.move(draft, path)


def _get(files: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped where it is local, else read."""
    if not files.get_file_info(path).size:
        return np.empty(0, dtype=dtype)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with files.open_input_stream(path) as data:
        return np.frombuffer(data.read(), dtype=dtype)


def write(documents: DataFrame, path: str, tokenizer: str, end_id: int) -> str:
    """Write the token files of all documents below ``path``; return the id type.

    Texts are moved once, to ranges of doc_id.  A task writes its own part, and
    writes the same part again if it runs again.
    """
    spark = documents.sparkSession
    dtype = id_type(tokenizer, end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _folder(path)
        part = TaskContext.get().partitionId()
        files.create_dir(base, recursive=True)
        encoder = _encoder(tokenizer, dtype)
        lengths, ids, nulls = [], [], 0
        name = f"{base}/part-{part:05d}"
        draft = f"{name}.bin.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            for batch in arrays.sliced(batches, "text", SLICE_BYTES):
                tokens, counts = encoder.encode(batch.column("text"))
                # The end id goes behind the ids of every document.
                out.write(np.insert(tokens, np.cumsum(counts), end_id).tobytes())
                lengths.append(counts + 1)
                keys = batch.column("doc_id")
                nulls += keys.null_count
                ids.append(keys.fill_null(0).to_numpy(zero_copy_only=False))
        if not lengths:
            files.delete_file(draft)
            return
        files.move(draft, f"{name}.bin")
        _put(files, f"{name}.ids", np.concatenate(ids).astype("<i8").tobytes())
        counted = np.concatenate(lengths).astype("<i8")
        _put(files, f"{name}.len", counted.tobytes())
        row = {"part": part, "docs": len(counted), "nulls": nulls, "tokens": int(counted.sum())}
        yield pa.RecordBatch.from_pylist([row], schema=_PART)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _folder(path)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{base}/part-{row['part']:05d}"
                lengths = _get(files, f"{name}.len", "<i8")
                starts = np.r_[0, np.cumsum(lengths)] + row["base"]
                _put(files, f"{name}.idx", starts.astype("<i8").tobytes())
            yield batch

    parts = parallelism(spark)
    ordered = (
        documents.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(parts, F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    )
    written = f"{path.rstrip('/')}/written"
    ordered.mapInArrow(encode, "part int, docs long, nulls long, tokens long").write.parquet(written)
    # One row per part: few enough for one task, whatever the size of the texts.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = spark.read.parquet(written).withColumn(
        "base", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))
    )
    kind = "part int, docs long, nulls long, tokens long, base long"
    bases.repartitionById(parts, "part").mapInArrow(index, kind).write.parquet(f"{path.rstrip('/')}/manifest")
    return dtype


_PART = pa.schema([("part", pa.int32())] + [(n, pa.int64()) for n in ("docs", "nulls", "tokens")])


def read(spark: SparkSession, path: str, dtype: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _folder(path)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{base}/part-{row['part']:05d}"
                tokens = _get(files, f"{name}.bin", dtype)
                starts = _get(files, f"{name}.idx", "<i8")
                keys = np.asarray(_get(files, f"{name}.ids", "<i8"))
                local = starts - row["base"]
                sums = [
                    zlib.crc32(tokens[a:b].astype("<u4").tobytes())
                    for a, b in zip(local[:-1].tolist(), local[1:].tolist())
                ]
                absent = np.arange(len(keys)) < row["nulls"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64(), mask=absent),
                        pa.array(starts[:-1], pa.int64()),
                        pa.array(np.diff(starts), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    manifest = spark.read.parquet(f"{path.rstrip('/')}/manifest")
    return manifest.repartitionById(parallelism(spark), "part").mapInArrow(
        scan, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
