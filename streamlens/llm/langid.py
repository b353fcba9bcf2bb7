"""Language of texts by compression.

For every language a raw-content dictionary is filled with the words of a
bounded sample of its documents, commonest last.  A text is compressed with
each dictionary, in blocks, so that long texts are judged by their language and
not by their own repetitions; the language with the smallest sum wins.

Texts are compared as lower-case letters; anything else is white space.  A text
is rejected if it has no letter, or if the runner-up needs less than
``LEAST_MARGIN`` more, whatever its length; of a short text that is less than a byte,
so that equal sizes are rejected.

Defined results: a null or empty text, one without any letter, and any text when
no language could be learned, is ``und`` with score 0 and rejected.  Equal sizes
go to the first language in code point order.  With one learned language the
score is 1.  Rows that repeat a doc_id are judged one by one; extra columns stay.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm import arrays

UNKNOWN = "und"
# The bounded training sample: distinct texts of a language, characters of each.
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 2000
DICTIONARY_BYTES = 60 << 10
LEVEL = 9
BLOCK_BYTES = 2048
LEAST_MARGIN = 0.005
SHORT_BYTES = 48
SLICE_BYTES = 4 << 20

_OTHER = re.compile(r"[\W\d_]+")


# What is a letter among the first 256 characters; the others become a space.
_LATIN = bytes(0x20 if _OTHER.fullmatch(chr(code)) else code for code in range(256))


def letters(text: str) -> str:
    """``text`` as lower-case words of letters."""
    low = text.lower()
    try:
        latin = low.encode("latin-1")
    except UnicodeEncodeError:
        return _OTHER.sub(" ", low).strip()
    # A table does the same as the pattern, in a tenth of the time.
    return b" ".join(latin.translate(_LATIN).split()).decode("latin-1")


def dictionary(texts: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """Words of distinct texts by how many hold them, the commonest last."""
    counts: Counter[str] = Counter()
    for text in sorted(set(texts)):
        counts.update(sorted(set(letters(text).split())))
    chosen, used = [], 0
    for word in sorted(counts, key=lambda w: (-counts[w], w)):
        used += len(word.encode()) + 1
        if used > size:
            break
        chosen.append(word)
    return " ".join(reversed(chosen)).encode()


def train(documents: DataFrame, usable: Column, label: str = "lang") -> dict[str, bytes]:
    """A dictionary per language, from about ``SAMPLE_DOCS`` distinct texts of each, or all.

    The sample is drawn by hash of the text, so it does not depend on where rows
    are.  Its share is that of the distinct texts, and a drawn text is taken once,
    however many copies there are.
    """
    labelled = documents.filter(usable & F.col(label).isNotNull() & F.col("text").isNotNull())
    labelled = labelled.withColumn("__hash", F.xxhash64("text"))
    distinct = labelled.select(label, "__hash").distinct().groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    counts = {r[label]: r["n"] for r in distinct.collect()}
    if not counts:
        return {}
    draw = F.pmod(F.col("__hash"), F.lit(1 << 30)).cast("double") / float(1 << 30)
    share = F.element_at(
        F.create_map(*(x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, SAMPLE_DOCS / n))))),
        F.col(label),
    )
    rows = (
        labelled.filter(draw < share)
        .groupBy(label, "__hash")
        .agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
        .collect()
    )
    texts = defaultdict(list)
    for row in rows:
        texts[row[label]].append(row["text"])
    built = {lang: dictionary(own) for lang, own in sorted(texts.items())}
    return {lang: data for lang, data in built.items() if data}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self._languages = sorted(dictionaries)
        self._compressors = []
        for lang in self._languages:
            # A dictionary of less than eight bytes is taken for none.
            data = dictionaries[lang].rjust(8)
            content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self._compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL,
                    dict_data=content,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the text is rejected."""
        return self.all([text])[0]

    def all(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """What a call gives for every text; a compressor takes all blocks in turn, so that its tables stay in the cache."""
        found: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
        if not self._languages:
            return found
        blocks, judged, ends = [], [], []
        for at, text in enumerate(texts):
            plain = letters(text or "")
            if not plain or not any(map(str.isalpha, plain)):
                continue
            data = plain.encode()
            if len(data) < SHORT_BYTES:
                # What is too short to be compressed at all is judged by its repetition.
                data = b" ".join([data] * (1 + SHORT_BYTES // len(data)))
            blocks += [data[start : start + BLOCK_BYTES] for start in range(0, len(data), BLOCK_BYTES)]
            judged.append(at)
            ends.append(len(blocks))
        sums = []
        for compressor in self._compressors:
            upto = [0, *accumulate(len(compressor.compress(block)) for block in blocks)]
            sums.append([upto[end] - upto[start] for start, end in zip([0, *ends], ends)])
        for at, *sizes in zip(judged, *sums):
            found[at] = self._judged(sizes)
        return found

    def _judged(self, sizes: list[int]) -> tuple[str, float, bool]:
        if len(sizes) == 1:
            return self._languages[0], 1.0, False
        best, second = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))[:2]
        margin = (sizes[second] - sizes[best]) / sizes[second]
        return self._languages[best], min(1.0, 0.5 + 2.5 * margin), margin < LEAST_MARGIN


def classify(documents: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """``documents`` with lang_pred, score and rejected; only the text is looked at."""
    added = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(dictionaries)
        for batch in arrays.sliced(batches, "text", SLICE_BYTES):
            found = judge.all(batch.column("text").to_pylist())
            columns = [pa.array(c, f.type) for c, f in zip(zip(*found), added)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, *added.names]
            )

    names = [c for c in documents.columns if c not in added.names]
    fields = documents.select(*names).schema
    schema = fields.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return documents.select(*names).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that nothing is learned from; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
