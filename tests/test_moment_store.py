"""Merged moments, fits from the store, and late rows."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from streamlens.functions import moments as mo
from streamlens.operators import moment_store, regression
from streamlens.streaming.late import LateKeeper, start_late_keeper
from streamlens.sources.streams import replay_source

SAMPLES = "offset long, timestamp timestamp, label double, feature double"
DAY = dt.datetime(2024, 3, 1)


def direct(pairs):
    n = len(pairs)
    mx, my = math.fsum(x for x, _ in pairs) / n, math.fsum(y for _, y in pairs) / n
    return (
        n,
        mx,
        my,
        math.fsum((x - mx) ** 2 for x, _ in pairs) / n,
        math.fsum((y - my) ** 2 for _, y in pairs) / n,
        math.fsum((x - mx) * (y - my) for x, y in pairs) / n,
    )


@pytest.mark.parametrize("far", [0.0, 1e9])
def test_merged_moments_are_those_of_the_union(spark, far):
    """Also where the means are far from zero and from each other."""
    rng = random.Random(5)
    groups, rows = {}, []
    for key in ("a", "b", None):
        for part in range(7):
            pairs = [(far + part * 1e3 + rng.gauss(0, 1e-2), rng.gauss(part, 1)) for _ in range(rng.randint(1, 40))]
            groups.setdefault(key, []).extend(pairs)
            rows.append((key, *direct(pairs)))
    rows += [("a", 0, None, None, None, None, None), ("none", 0, None, None, None, None, None)]
    stored = spark.createDataFrame(rows, "key string, n long, mx double, my double, sxx double, syy double, sxy double")
    got = {r["key"]: r for r in mo.merge_moments(stored.repartition(3), ["key"]).collect()}
    assert set(got) == set(groups)
    for key, pairs in groups.items():
        assert [got[key][c] for c in mo.MOMENTS] == pytest.approx(direct(pairs), rel=1e-9, abs=1e-9)
    one = mo.merge_moments(stored).collect()
    every = [p for pairs in groups.values() for p in pairs]
    assert [[r[c] for c in mo.MOMENTS] for r in one] == [pytest.approx(direct(every), rel=1e-9, abs=1e-9)]
    assert mo.merge_moments(stored.limit(0)).collect() == []


def samples(spark, rows):
    return spark.createDataFrame(
        [(i, ts and DAY + dt.timedelta(hours=ts), y, x) for i, (ts, y, x) in enumerate(rows)], SAMPLES
    )


def some_rows(n, rng, first=0.0, last=240.0):
    return [(rng.uniform(first, last), rng.gauss(3, 1), rng.gauss(0, 2)) for _ in range(n)]


def same_models(got, expected, keys):
    def table(df):
        return sorted((*(r[k] for k in keys), *(round(r[c], 9) for c in regression.MODEL_COLUMNS)) for r in df.collect())

    assert table(got) == table(expected)


def test_any_batches_and_windows_equal_a_fit_of_their_samples(spark, tmp_path):
    rng = random.Random(2)
    store = moment_store.MomentStore.below(str(tmp_path / "m"), "1 day")
    parts = [some_rows(80, rng) + [(5.0, float("nan"), 1.0), (6.0, 1.0, math.inf)] for _ in range(3)]
    for i, rows in enumerate(parts):
        store.add(samples(spark, rows), "timestamp", i)
    store.add(samples(spark, parts[1]), "timestamp", 1)  # runs again
    every = samples(spark, [r for rows in parts for r in rows])
    stored = store.read(spark)
    same_models(moment_store.stored_fit(stored, 0.01), regression.ridge_fit(every, 0.01), [])
    two = samples(spark, parts[0] + parts[2])
    same_models(
        moment_store.stored_fit(stored.filter("batch_id <> 1"), 0.01), regression.ridge_fit(two, 0.01), []
    )
    raw = regression.ridge_fit(every, 0.01, [F.window("timestamp", "3 days", "1 day").alias("w")]).select(
        F.col("w.start").alias("window_start"), *regression.MODEL_COLUMNS
    )
    same_models(moment_store.sliding_fit(stored, "3 days", "1 day", 0.01), raw, ["window_start"])


def test_late_rows_are_told_apart_and_counted_in(spark, tmp_path):
    rng = random.Random(3)
    first = some_rows(50, rng, 0, 100) + [(101.0, 1.0, 1.0)]
    second = some_rows(30, rng, 0, 100) + [(102.0, 2.0, 1.0), (None, 2.0, 1.0)]
    third = some_rows(30, rng, 150, 200)
    folder = str(tmp_path / "in")
    schema = samples(spark, first).schema
    keeper = LateKeeper.below(str(tmp_path / "out"), schema, "timestamp", "24 HOURS")
    for rows in (first, second, third):
        samples(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream = replay_source(spark, folder, schema)
        start_late_keeper(stream, keeper, str(tmp_path / "c"), availableNow=True).awaitTermination()

    def late_labels():
        return sorted((r.batch_id, r.label) for r in keeper.late.read(spark).collect())

    expected = sorted((1, y) for ts, y, _ in second if ts is not None and ts < 101 - 24)
    assert late_labels() == expected and expected
    # A batch that runs again judges its rows by the batches before it, as it did.
    keeper(samples(spark, second), 1)
    assert late_labels() == expected
    every = samples(spark, [r for r in first + second + third if r[0] is not None])
    days = regression.ridge_fit(every, 0.01, [F.window("timestamp", "1 day").alias("w")]).select(
        F.col("w.start").alias("slot"), *regression.MODEL_COLUMNS
    )
    stored = keeper.store.read(spark)
    same_models(moment_store.stored_fit(stored, 0.01, ["slot"]), days, ["slot"])
    on_time = sum(r.n for r in stored.filter("NOT late").collect())
    assert on_time == every.count() - len(expected)
