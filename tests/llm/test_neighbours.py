import math

import numpy as np
import pytest

from streamlens.llm import neighbours

KIND = "vec_id long, embedding array<float>, score string"


def brute(rows, queries, count):
    found = {}
    for q in queries:
        own = np.array(rows[q], dtype=float)
        scored = sorted(
            (-float(neighbours.cosines(own, np.array([v], dtype=float))[0]), i)
            for i, v in rows.items()
            if i != q and len(v) == len(own)
        )
        found[q] = [(i, -s) for s, i in scored[:count]]
    return found


def test_hadamard_is_a_rotation():
    rows = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(neighbours.hadamard(rows), axis=1), np.linalg.norm(rows, axis=1))
    assert np.allclose(neighbours.hadamard(neighbours.hadamard(rows)), rows)


@pytest.mark.parametrize("block_rows", [8192, 40])
def test_recall_and_exact_scores(spark, monkeypatch, block_rows):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(2)
    rows = {i: rng.normal(size=32).astype(np.float32).tolist() for i in range(1500)}
    rows[77] = rows[50]  # equal vectors: the smaller vec_id first
    rows[78] = rows[50]
    bad = [(9000, None), (9050, [0.0] * 32), (9100, [math.nan] + [1.0] * 31), (9150, [None] + [1.0] * 31),
           (9200, [math.inf] + [1.0] * 31), (None, rows[1]), (9250, [])]
    data = [(i, v, "x") for i, v in rows.items()] + [(i, v, "x") for i, v in bad] + [(3, rows[3], "y")]
    df = spark.createDataFrame(data, KIND).repartition(4)
    got = neighbours.search(df, df.filter("vec_id % 50 = 0"), 5).collect()
    want = brute(rows, [i for i in rows if i % 50 == 0], 5)
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(want)
    for q, found in by.items():
        assert [r.rank for r in found] == list(range(1, len(found) + 1))
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        for r in found:
            assert r.score == neighbours.cosines(np.array(rows[q]), np.array([rows[r.vec_id]]))[0]
    hits = sum(len({i for i, _ in want[q]} & {r.vec_id for r in by[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert [r.vec_id for r in by[50]][:2] == [77, 78]


@pytest.mark.parametrize("size, dims", [(2, 64), (5, 64), (5, 2), (40, 2)])
def test_a_query_lacks_no_candidate_that_is_there(spark, size, dims):
    rng = np.random.default_rng(size)
    rows = {50 * i: rng.normal(size=dims).tolist() for i in range(size)}
    data = [(i, v, "") for i, v in rows.items()] + [(7, [1.0] * (dims + 1), "")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, score string")
    got = neighbours.search(df, df.filter("vec_id % 50 = 0"), 5).collect()
    want = brute(rows, list(rows), 5)
    counts = {q: sorted(r.rank for r in got if r.query_id == q) for q in rows}
    assert counts == {q: list(range(1, min(5, size - 1) + 1)) for q in rows}
    if size <= 5:
        by = {q: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in rows}
        assert by == want


def test_a_lone_query_beside_copies_is_completed(spark, monkeypatch):
    """All vectors but a few are copies, in one cell; queries and vectors of the cell are split."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 3)
    copy, lone = [1.0] + [0.0] * 31, [0.0] * 31 + [1.0]
    rows = {i: copy for i in range(600)} | {1000: lone, 1001: [0.0] * 30 + [0.1, 1.0]}
    df = spark.createDataFrame([(i, v, "") for i, v in rows.items()], "vec_id long, embedding array<double>, score string")
    got = neighbours.search(df, df.filter("vec_id % 50 = 0"), 5).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by == brute(rows, [i for i in rows if i % 50 == 0], 5)


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], ""), (1, [1.0, 0.1], ""), (2, [1e200, 1e200], "")],
                               "vec_id long, embedding array<double>, score string")
    got = neighbours.search(df, df.filter("vec_id = 0"), 5).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [1, 2]
    assert all(0 < r.score <= 1 for r in got)
    assert neighbours.search(df.limit(0), df.limit(0), 5).count() == 0
