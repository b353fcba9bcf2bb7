"""Personal data: fixed patterns, and terms that give protected entities away.

Base spans are found by pattern and a check (``email``, ``ip``, ``card``,
``phone``).  Every distinct value found is a protected entity, and every word of a
document that holds one, on any line, is a term that may reveal it.  Entities of the same documents
are judged as one.  Over the whole
corpus, PMI(e; t) = log2(n(e, t) * N / (n(e) * n(t))) is taken from the numbers of
documents that hold them anywhere; a term is disclosive for an entity if
PMI >= IC(e) / alpha, with IC(e) = log2(N / n(e)).  With alpha = 1 only terms that never
occur without the entity reach it.  So that chance does not, the distinct texts that
hold both must be worth ``EVIDENCE`` bits, each IC(e): a single one is enough from
2 ** EVIDENCE documents on.  Disclosive terms become spans of kind ``term`` wherever
they stand in a document with their entity, outside base spans.

Defined results: a null or empty text has no spans; rows that repeat a doc_id are
judged one by one, and a repeated row counts again in the numbers of documents, but is
no further evidence; a null doc_id is kept; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm import arrays
from streamlens.llm.tables import kept

KINDS = ("email", "ip", "card", "phone", "term")
# Bits that the texts with entity and term must be worth.
EVIDENCE = 7.0
ALPHA = 1.0
SLICE_BYTES = 4 << 20

# The patterns.  A look-behind or a possessive repeat only spares
# starts that cannot match, so that long runs take linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (rest := _DOMAIN.match(text, at + 1)):
            done = rest.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit)
        if place % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans, by start, then kind."""
    found = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                    found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _digits(m[0])
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def _entity(kind: int, value: str) -> str:
    return f"{kind}:{value.lower() if kind == 0 else _digits(value) if kind > 1 else value}"


def _hashes(values: list[str]) -> np.ndarray:
    words = [v.encode() for v in values]
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    empty = np.empty(0, dtype=np.int64)
    if not words:
        return empty
    split = arrays.Words(data, np.r_[0, ends[:-1]], ends, empty)
    return split.hashes().view(np.int64)


_SPAN = "struct<start: long, kind: int, end: long>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))


def _terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every distinct term of every text.

    Terms are words, lower-cased and stripped of what is no letter or digit at
    their ends.
    """
    hashes, bounds, filled = _term_hashes(texts)
    rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
    hashes, rows = hashes[filled], rows[filled]
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return rows[new], hashes[new]


def _term_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word, the bounds of rows, and which words are terms."""
    words = arrays.split_words(pa.array([t.lower() for t in texts], pa.string()))
    starts, ends = _stripped(words)
    hashes = arrays.Words(words.data, starts, ends, words.bounds).hashes()
    return hashes.view(np.int64), words.bounds, ends - starts > 1


def find(documents: DataFrame) -> DataFrame:
    """Per document its base spans; with any, also its text and its distinct entities and terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.sliced(batches, "text", SLICE_BYTES):
            texts = batch.column("text").fill_null("").to_pylist()
            spans = [base_spans(t) for t in texts]
            holding = [i for i, own in enumerate(spans) if own]
            rows, terms = _terms([texts[i] for i in holding])
            ends = np.searchsorted(rows, np.arange(len(holding) + 1))
            terms_of: list = [None] * len(texts)
            entities_of: list = [None] * len(texts)
            for k, i in enumerate(holding):
                terms_of[i] = terms[ends[k] : ends[k + 1]]
                entities_of[i] = _hashes(sorted({_entity(kind, texts[i][a:b]) for a, kind, b in spans[i]}))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tag"),
                    pa.array([t if own else None for t, own in zip(texts, spans)], pa.string()),
                    pa.array([[{"start": a, "kind": k, "end": b} for a, k, b in own] for own in spans], _SPANS),
                    pa.array(entities_of, pa.list_(pa.int64())),
                    pa.array(terms_of, pa.list_(pa.int64())),
                ],
                names=["doc_id", "tag", "text", "base", "entities", "terms"],
            )

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", F.xxhash64("text").alias("tag"), "text").mapInArrow(
        run,
        f"doc_id {kind}, tag long, text string, base array<{_SPAN}>, entities array<long>, terms array<long>",
    )


def term_counts(documents: DataFrame) -> DataFrame:
    """(term hash, documents that hold the term) over all words; counted per batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.sliced(batches, "text", SLICE_BYTES):
            _, terms = _terms(batch.column("text").fill_null("").to_pylist())
            found, counts = np.unique(terms, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(counts.astype(np.int64))], names=["term", "n"]
            )

    counted = documents.select("text").mapInArrow(run, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n_term"))


_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True


def _stripped(words: arrays.Words) -> tuple[np.ndarray, np.ndarray]:
    """Word bounds without ASCII punctuation at either end."""
    starts, ends = words.starts.copy(), words.ends.copy()
    moving = np.arange(len(starts))
    while len(moving):
        moving = moving[(starts[moving] < ends[moving])]
        moving = moving[~_ALNUM[words.data[starts[moving]]]]
        starts[moving] += 1
    moving = np.arange(len(starts))
    while len(moving):
        moving = moving[(starts[moving] < ends[moving])]
        moving = moving[~_ALNUM[words.data[ends[moving] - 1]]]
        ends[moving] -= 1
    return starts, ends


def alike(found: DataFrame) -> DataFrame:
    """(row, classes): the entities of every row, those that stand in exactly the same rows as one.

    Such entities are beside the same terms in the same documents, so they are judged together:
    a list of very many addresses that occur nowhere else is one class, not a pair with each of its
    words.  A class is named by 128 bits of its rows.
    """
    seen = found.filter("text IS NOT NULL").select("row", F.explode("entities").alias("entity"))
    marks = (F.bit_xor(F.xxhash64(F.lit(salt), "row")).alias(f"mark{salt}") for salt in (1, 2))
    classes = seen.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), *marks)
    named = classes.select("entity", F.xxhash64("n", "mark1", "mark2").alias("class"))
    return seen.join(named, "entity").groupBy("row").agg(F.collect_set("class").alias("classes"))


def together(found: DataFrame, documents: DataFrame, n_all: int, alpha: float = ALPHA) -> DataFrame:
    """(row, tag, entity, term, n_term) of every term beside an entity that may be disclosive.

    ``entity`` is a class of ``alike``.

    Only documents with an entity hold pairs.  A pair has no more documents than its
    term has beside any entity, which leaves out words that are common elsewhere.
    """
    # n(e, t) / n(t) >= (n(e) / N) ** (1 - 1 / alpha), least for n(e) = 1.
    share = min(1.0, max(n_all, 1) ** (1 / alpha - 1)) - 1e-9
    holding = found.filter("text IS NOT NULL").select("row", "tag", "terms").join(alike(found), "row")
    beside = holding.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_beside"))
    possible = term_counts(documents).join(beside, "term").filter(F.col("n_beside") >= share * F.col("n_term"))
    possible = kept(possible.select("term", "n_term"), "pii-terms")
    terms = holding.select("row", "tag", "classes", F.explode("terms").alias("term"))
    # Written before pairs are counted, so that Spark can split a term of very many documents.
    return kept(
        terms.join(possible, "term").select("row", "tag", F.explode("classes").alias("entity"), "term", "n_term"),
        "pii-pairs",
    )


def disclosive(found: DataFrame, beside: DataFrame, n_all: int, alpha: float = ALPHA) -> DataFrame:
    """(entity, term) pairs whose mutual information reaches the disclosure threshold."""
    # Rows of equal text are counted, but are one text of evidence.
    texts = beside.groupBy("entity", "term", "n_term", "tag").agg(F.count(F.lit(1)).alias("n"))
    pairs = kept(
        texts.groupBy("entity", "term", "n_term").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("n_texts")),
        "pii-together",
    )
    entities = alike(found).select(F.explode("classes").alias("entity")).groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_entity")
    )
    entities = kept(entities, "pii-entities")
    information = F.log2(F.lit(float(n_all)) / F.col("n_entity"))
    pmi = F.log2(F.col("n_both") * F.lit(float(n_all)) / (F.col("n_entity") * F.col("n_term")))
    return (
        pairs.join(entities, "entity")
        .filter(pmi >= information / alpha - 1e-9)
        .filter(F.col("n_texts") * information >= EVIDENCE)
        .select("entity", "term", pmi.alias("pmi"))
    )


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of a row's disclosive terms in its text, outside its base spans."""
    for batch in arrays.sliced(batches, "text", SLICE_BYTES):
        texts = batch.column("text").fill_null("").to_pylist()
        base = batch.column("base").to_pylist()
        wanted = batch.column("revealing").to_pylist()
        rows = [i for i, own in enumerate(wanted) if own]
        places: list = [[] for _ in texts]
        hashes, bounds, filled = _term_hashes([texts[i] for i in rows])
        # Lower case may be longer, but has the same words with the same signs at their ends.
        words = arrays.split_words(pa.array([texts[i] for i in rows], pa.string()))
        starts, ends = _stripped(words)
        chars = np.append(0, np.cumsum((words.data & 0xC0) != 0x80))
        _, offsets = arrays.flat_bytes(pa.array([texts[i] for i in rows], pa.string()))
        for k, i in enumerate(rows):
            own = slice(bounds[k], bounds[k + 1])
            hit = filled[own] & np.isin(hashes[own], wanted[i])
            first = chars[offsets[k]]
            a, b = chars[starts[own][hit]] - first, chars[ends[own][hit]] - first
            # Base spans may overlap: what starts before a word's end, and the farthest end of that.
            low = np.array([s["start"] for s in base[i]])
            high = np.append(0, np.maximum.accumulate([s["end"] for s in base[i]]))
            free = high[np.searchsorted(low, b)] <= a
            places[i] = [{"start": x, "kind": 4, "end": y} for x, y in zip(a[free].tolist(), b[free].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("base"), pa.array(places, _SPANS)],
            names=["doc_id", "base", "places"],
        )


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def detect(documents: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Base spans and disclosive terms of every document."""
    found = kept(
        find(documents).withColumn("row", F.monotonically_increasing_id()), "pii-found"
    )  # written once, so a row keeps its name
    n_all = found.count()
    beside = together(found, documents, n_all, alpha)
    revealing = kept(disclosive(found, beside, n_all, alpha), "pii-revealing")
    terms = (
        beside.select("row", "entity", "term")
        .join(revealing, ["entity", "term"])
        .groupBy("row")
        .agg(F.collect_set("term").alias("revealing"))
    )
    kind = dict(documents.dtypes)["doc_id"]
    located = (
        found.select("row", "doc_id", "text", "base")
        .join(terms, "row", "left")
        .select("doc_id", "text", "base", "revealing")
        .mapInArrow(_located, f"doc_id {kind}, base array<{_SPAN}>, places array<{_SPAN}>")
    )
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = {k})) AS bigint)").alias(f"n_{KINDS[k]}")
        for k in range(4)
    ]
    return located.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "places"))).alias("spans"),
    )


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    """``text`` with base spans generalised to their kind and terms removed."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], "" if kind == "term" else f"<{kind}>"]
            at = end
        elif end > at:
            at = end
    return "".join(out) + text[at:]


def digest(text: str) -> str:
    """The digest of a text's base spans, for tests."""
    joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base_spans(text))
    return hashlib.sha256(joined.encode()).hexdigest()
