"""Offsets that were read, missed, and read twice."""

import random
from collections import Counter, defaultdict

import pytest

from streamlens.streaming import ledger
from streamlens.streaming.ledger import OffsetLedger, findings, offset_intervals

MESSAGES = "topic string, partition int, offset long, value string"


def messages(spark, rows):
    return spark.createDataFrame([(*r, "v") for r in rows], MESSAGES).repartition(3)


def runs_of(offsets):
    out = []
    for o in sorted(offsets):
        if out and out[-1][1] + 1 == o:
            out[-1][1] = o
        else:
            out.append([o, o])
    return [tuple(r) for r in out]


def some_offsets(rng, low, high):
    rows = []
    for topic, partition in (("a", 0), ("a", 1), ("b", 0), (None, 2)):
        kept = [o for o in range(low, high) if o % 97 > rng.randint(1, 9)]
        rows += [(topic, partition, o) for o in kept for _ in range(1 + (o % 50 == 0))]
    return rows + [("a", 0, None)]


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_intervals_equal_plain_runs(spark, monkeypatch, block):
    monkeypatch.setattr(ledger, "BLOCK", block)
    rows = some_offsets(random.Random(block), 0, 400) + [("c", 0, o) for o in (0, 1 << 40, (1 << 40) + 1)]
    got = sorted((tuple(r) for r in offset_intervals(messages(spark, rows)).collect()), key=str)
    counts, offsets = Counter(rows), defaultdict(set)
    for topic, partition, o in rows:
        if o is not None:
            offsets[topic, partition].add(o)
    want = [
        (*key, first, last, sum(counts[(*key, o)] for o in range(first, last + 1)))
        for key, found in offsets.items()
        for first, last in runs_of(found)
    ]
    assert got == sorted(want, key=str)


def test_gaps_and_overlaps_equal_a_plain_count(spark, tmp_path):
    rng = random.Random(4)
    book = OffsetLedger.below(str(tmp_path / "ledger"))
    parts = [some_offsets(rng, 0, 300), some_offsets(rng, 280, 500), some_offsets(rng, 290, 310)]
    for i, rows in enumerate(parts):
        book.note(messages(spark, rows), i)
    book.note(messages(spark, parts[1]), 1)  # runs again, noted once
    got = sorted((tuple(r[1:]) for r in findings(book.read(spark)).collect()), key=str)
    times = defaultdict(Counter)
    for rows in parts:
        for topic, partition, o in set(rows):
            if o is not None:
                times[topic, partition][o] += 1
    want = []
    for key, read in times.items():
        missing = [o for o in range(min(read), max(read) + 1) if o not in read]
        want += [(*key, "gap", *r) for r in runs_of(missing)]
        want += [(*key, "overlap", *r) for r in runs_of([o for o, n in read.items() if n > 1])]
    assert got == sorted(want, key=str) and want


def test_runs_are_judged_apart(spark, tmp_path):
    for run, offsets in (("one", range(5)), ("two", range(3, 9))):
        OffsetLedger.below(str(tmp_path / "l"), run).note(messages(spark, [("t", 0, o) for o in offsets]), 0)
    assert findings(OffsetLedger.below(str(tmp_path / "l")).read(spark)).collect() == []
    assert offset_intervals(messages(spark, [])).collect() == []
