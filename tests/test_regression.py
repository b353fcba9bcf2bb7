import hashlib
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD
from pyspark.sql import functions as F

from streamlens.operators import regression
from streamlens.operators.joins import join_settled

QUIET = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
FEATURES = st.floats(-1e3, 1e3, allow_nan=False, width=32)
PAIRS = st.lists(st.tuples(FEATURES, FEATURES), min_size=1, max_size=40)


def fit(samples, reg=1e-4):
    return regression.ridge_fit(samples, reg).first()


@pytest.mark.parametrize(
    "pairs, reg, weight, intercept",
    [
        ([(52.5 + 0.0001 * x, x) for x in range(1, 6)], 1e-4, 0.0079702728, 52.4711420674),
        ([(52.5, 1)], 1e-4, 26.2486875656, 26.2486875656),
        ([(52.5, 1)], 0.0, 26.25, 26.25),
        ([(4, 3), (6, 3)], 0.0, 1.5, 0.5),
    ],
)
def test_known_fits(samples_from, pairs, reg, weight, intercept):
    row = fit(samples_from(pairs), reg)
    assert row.n == len(pairs)
    assert row.weight == pytest.approx(weight, abs=1e-9)
    assert row.intercept == pytest.approx(intercept, abs=1e-9)


@QUIET
@given(PAIRS, st.sampled_from([1e-4, 0.1, 2.0]))
def test_gradient_is_zero_at_the_fit(samples_from, pairs, reg):
    row = fit(samples_from(pairs), reg)
    errors = [(row.weight * x + row.intercept - y, x) for y, x in pairs]
    n = len(pairs)
    scale = 1 + sum(abs(y) * (1 + abs(x)) + x * x for y, x in pairs) / n
    slope = sum(e * x for e, x in errors) / n + reg * row.weight
    level = sum(e for e, _ in errors) / n + reg * row.intercept
    assert abs(slope) / scale < 1e-9 and abs(level) / scale < 1e-9
    loss = sum(e * e for e, _ in errors) / (2 * n) + reg / 2 * (
        row.weight**2 + row.intercept**2
    )
    assert row.final_loss == pytest.approx(loss, rel=1e-6, abs=1e-9 * scale * scale)
    assert row.initial_loss == pytest.approx(
        sum(y * y for y, _ in pairs) / (2 * n), rel=1e-9, abs=1e-12
    )


@QUIET
@given(PAIRS, st.integers(0, 9))
def test_row_order_and_partitions_do_not_matter(samples_from, pairs, seed):
    shuffled = list(pairs)
    random.Random(seed).shuffle(shuffled)
    one = fit(samples_from(pairs).coalesce(1), 0.5)
    other = fit(samples_from(shuffled).repartition(5), 0.5)
    assert one.weight == pytest.approx(other.weight, rel=1e-9, abs=1e-9)
    assert one.intercept == pytest.approx(other.intercept, rel=1e-9, abs=1e-9)


def test_groups_fit_like_separate_batches(samples_from):
    batches = {b: [(b + 2.0 * x + x % 3, x) for x in range(3 + b)] for b in range(4)}
    union = None
    for b, pairs in batches.items():
        df = samples_from(pairs, b)
        union = df if union is None else union.union(df)
    got = {r.batch_id: r for r in regression.ridge_fit(union, 0.1, ["batch_id"]).collect()}
    for b, pairs in batches.items():
        alone = fit(samples_from(pairs), 0.1)
        assert got[b].weight == pytest.approx(alone.weight, rel=1e-9)
        assert got[b].n == alone.n


def test_nothing_to_fit(samples_from):
    assert regression.ridge_fit(samples_from([])).collect() == []
    assert regression.ridge_fit(samples_from([(math.nan, 1), (1, math.inf)])).collect() == []


def test_non_finite_samples_are_left_out(samples_from):
    clean = [(2.0, 1.0), (4.0, 2.0)]
    dirty = clean + [(math.nan, 1.0), (1.0, -math.inf)]
    assert fit(samples_from(dirty)) == fit(samples_from(clean))


def sgd_samples():
    return [(2 * x / 10 + 1, x / 10) for x in range(1, 21)]


def test_sgd_known_values(samples_from):
    row = regression.sgd_fit(
        samples_from(sgd_samples()),
        num_iterations=100,
        step_size=0.5,
        convergence_tol=1e-5,
        reg_param=1e-6,
        intercept=True,
    ).first()
    assert row.weight == pytest.approx(1.79615244302549, abs=1e-12)
    assert row.intercept == pytest.approx(1.25039904189437, abs=1e-12)


@pytest.mark.parametrize("intercept", [True, False])
@pytest.mark.parametrize("tol", [1e-5, 1e-2])
@pytest.mark.parametrize("reg", [0.0, 0.05])
def test_sgd_equals_stock_sgd(spark, samples_from, intercept, tol, reg):
    pairs = [(3 * x - 1 + math.sin(x), x) for x in (i / 7 for i in range(15))]
    points = spark.sparkContext.parallelize([LabeledPoint(y, [x]) for y, x in pairs], 2)
    stock = LinearRegressionWithSGD.train(
        points,
        iterations=60,
        step=0.3,
        initialWeights=[0.25],
        regParam=reg,
        regType="l2",
        intercept=intercept,
        convergenceTol=tol,
    )
    row = regression.sgd_fit(
        samples_from(pairs),
        num_iterations=60,
        step_size=0.3,
        convergence_tol=tol,
        init_weight=0.25,
        reg_param=reg,
        intercept=intercept,
    ).first()
    assert row.weight == pytest.approx(stock.weights[0], rel=1e-9)
    assert row.intercept == pytest.approx(stock.intercept, rel=1e-9, abs=1e-12)


def test_predictions_and_triples(samples_from):
    found = samples_from([(1, 0), (3, 1), (5, 2)])
    model = regression.ridge_fit(found, 0.0)
    predicted = regression.predict(found, model)
    triples = regression.prediction_triples(predicted).orderBy("label").collect()
    assert [(round(r.prediction, 9), r.label, r.features) for r in triples] == [
        (1.0, 1.0, [0.0]),
        (3.0, 3.0, [1.0]),
        (5.0, 5.0, [2.0]),
    ]


def test_grouped_predictions_by_broadcast_and_by_shuffle(spark, samples_from):
    hot = samples_from([(2.0 * x + 1, x) for x in range(60)], 0)
    rest = samples_from([(x % 5, x) for x in range(30)], 1).withColumn(
        "batch_id", 1 + F.col("offset") % 6
    )
    found = hot.union(rest)
    model = regression.ridge_fit(found, 0.1, ["batch_id"])
    lines = model.select("batch_id", "weight", "intercept")
    salt_by = ["offset"]
    small = join_settled(found, lines, ["batch_id"], salt_by)
    large = join_settled(found, lines, ["batch_id"], salt_by, max_rows=0)
    assert small.count() == large.count() == 90
    assert small.exceptAll(large.select(small.columns)).isEmpty()
    predicted = regression.predict(found, model, ["batch_id"])
    assert predicted.filter("batch_id = 0").agg(F.max(F.abs(F.expr("prediction - label")))).first()[0] < 1


def test_first_and_last_record(spark):
    rows = [
        ("b", 0, 0, 0, 1.0, 1.0),
        ("a", 1, 5, 0, 2.0, 2.0),
        ("a", 0, 9, 1, 3.0, 3.0),
        ("a", 0, 9, 0, 4.0, 4.0),
        ("a", 0, 8, 0, math.nan, 1.0),
        ("b", 0, 0, 1, 5.0, 5.0),
    ]
    df = spark.createDataFrame(
        rows,
        "topic string, partition int, offset long, pos int, label double, feature double",
    ).repartition(4)
    row = regression.fit_with_ends(df, 0.01).first()
    assert (row.first_label, row.last_label) == (4.0, 5.0)
    assert row.first_prediction == pytest.approx(row.weight * 4 + row.intercept)
    assert row.last_prediction == pytest.approx(row.weight * 5 + row.intercept)


@pytest.mark.parametrize("intercept", [True, False])
def test_sgd_losses_are_those_of_the_rows(samples_from, intercept):
    pairs = [(2 * x + 1, x) for x in (k / 10 for k in range(1, 21))]
    options = dict(step_size=0.5, convergence_tol=0.0, init_weight=0.7, reg_param=0.05, intercept=intercept)

    def loss(w, b):
        errors = sum((w * x + b - y) ** 2 for y, x in pairs) / len(pairs) / 2
        return errors + 0.05 / 2 * (w * w + b * b)

    got = regression.sgd_fit(samples_from(pairs), num_iterations=6, **options).first()
    start = (0.7, 1.0 if intercept else 0.0)
    assert got.initial_loss == pytest.approx(loss(*start))
    assert got.final_loss == pytest.approx(loss(got.weight, got.intercept))
    lines = [start]
    for n in range(1, 6):
        row = regression.sgd_fit(samples_from(pairs), num_iterations=n, **options).first()
        lines.append((row.weight, row.intercept))
    assert got.losses == pytest.approx([loss(*line) for line in lines])


def test_predict_refuses_several_models_without_keys(samples_from):
    found = samples_from([(1.0, 1.0), (2.0, 2.0)])
    one = regression.ridge_fit(found)
    assert regression.predict(found, one).count() == 2
    assert regression.predict(found, one.limit(0)).count() == 0
    with pytest.raises(Exception, match="several rows"):
        regression.predict(found, one.unionAll(one)).collect()


# --- mini-batches -------------------------------------------------------------


def plain_descent(rows, fraction, iterations, step, reg):
    """Row by row; the rows of an iteration are drawn by two numbers from the position."""
    w, b, losses = 0.0, 1.0, []
    for t in range(1, iterations + 1):
        batch = []
        for offset, y, x in rows:
            digest = hashlib.md5(f"t/0/{offset}/0".encode()).hexdigest()
            h, g = int(digest[:8], 16), int(digest[8:16], 16) | 1
            if (h + t * g) % 2**32 < round(fraction * 2**32):
                batch.append((y, x))
        if not batch:
            continue
        errors = [(w * x + b - y, x) for y, x in batch]
        losses.append(sum(e * e for e, _ in errors) / len(batch) / 2 + reg / 2 * (w * w + b * b))
        eta = step / math.sqrt(t)
        gw = sum(e * x for e, x in errors) / len(batch)
        gb = sum(e for e, _ in errors) / len(batch)
        w, b = w * (1 - eta * reg) - eta * gw, b * (1 - eta * reg) - eta * gb
    return w, b, losses


@pytest.mark.parametrize("size, fraction", [(60, 0.9), (60, 0.3), (3, 0.1), (1, 0.02)])
def test_mini_batches_equal_a_plain_descent(samples_from, size, fraction):
    rng = random.Random(size)
    pairs = [(2 * x + rng.gauss(0, 0.1), x) for x in (rng.uniform(-1, 1) for _ in range(size))]
    options = {"num_iterations": 25, "step_size": 0.3, "convergence_tol": 0.0, "reg_param": 0.01, "intercept": True}
    row = regression.sgd_fit(samples_from(pairs), mini_batch_fraction=fraction, **options).first()
    w, b, losses = plain_descent([(i, y, x) for i, (y, x) in enumerate(pairs)], fraction, 25, 0.3, 0.01)
    assert (row.n, row.iterations) == (size, 25)
    assert [row.weight, row.intercept] == pytest.approx([w, b], rel=1e-9)
    assert row.losses == pytest.approx(losses, rel=1e-9)


def test_a_whole_fraction_is_the_full_batch(samples_from, spark):
    pairs = [(2 * x / 10 + 1, x / 10) for x in range(30)]
    both = samples_from(pairs, 0).union(samples_from(pairs[:7], 1))
    full = regression.sgd_fit(both, ["batch_id"], step_size=0.1)
    assert full.collect() == regression.sgd_fit(both, ["batch_id"], step_size=0.1, mini_batch_fraction=1.0).collect()
    # Almost all rows: the same to a few digits, per group and in the same columns.
    part = regression.sgd_fit(both, ["batch_id"], step_size=0.1, mini_batch_fraction=1 - 1e-9)
    assert part.columns == full.columns
    for got, want in zip(part.orderBy("batch_id").collect(), full.orderBy("batch_id").collect()):
        assert (got.batch_id, got.n) == (want.batch_id, want.n)
        assert got.weight == pytest.approx(want.weight, rel=1e-9)
    assert regression.sgd_fit(both.limit(0), mini_batch_fraction=0.5).collect() == []
    for bad in (0.0, 1.5):
        with pytest.raises(ValueError):
            regression.sgd_fit(both, mini_batch_fraction=bad)
