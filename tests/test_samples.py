import pytest
from pyspark.sql import functions as F

from streamlens.operators.samples import finite_samples, parse_samples, parse_tokens

GOOD = {"52.5,1": (52.5, 1.0), "1,2,3": (1.0, 2.0), "1.0d,2": (1.0, 2.0), "\t5 ,\t6": (5.0, 6.0)}
BAD = {
    "": "no feature",
    "5": "no feature",
    "5,": "no feature",
    "5,,7": "no feature",
    ",": "no feature",
    ",5": "bad label",
    "abc,1": "bad label",
    "nan,1": "bad label",
    "inf,1": "bad label",
    "1_0,1": "bad label",
    "1,abc": "bad feature",
    "1,\t": "bad feature",
}
NOT_FINITE = ["NaN,1", "1,Infinity", "1e400,2"]


@pytest.fixture
def tokens(spark):
    def build(texts):
        rows = [("t", 0, 0, i, text) for i, text in enumerate(texts)]
        return spark.createDataFrame(
            rows, "topic string, partition int, offset long, pos int, token string"
        )

    return build


def test_verdict_of_every_token(tokens):
    parsed = {r.token: r for r in parse_tokens(tokens([*GOOD, *BAD, *NOT_FINITE])).collect()}
    assert {t: parsed[t].verdict for t in BAD} == BAD
    assert {t: (parsed[t].label, parsed[t].feature) for t in GOOD} == GOOD
    assert {parsed[t].verdict for t in [*GOOD, *NOT_FINITE]} == {"ok"}


def test_drop(tokens):
    kept, quarantined = parse_samples(tokens([*GOOD, *BAD]), "drop")
    assert quarantined is None
    assert {(r.label, r.feature) for r in kept.collect()} == set(GOOD.values())


def test_quarantine_splits_without_loss(tokens):
    kept, quarantined = parse_samples(tokens([*GOOD, *BAD]), "quarantine")
    assert kept.count() == len(GOOD)
    assert {r.token: r.verdict for r in quarantined.collect()} == BAD


@pytest.mark.parametrize("text", BAD)
def test_fail(tokens, text):
    kept, _ = parse_samples(tokens([*GOOD, text]), "fail")
    with pytest.raises(Exception, match="malformed token"):
        kept.collect()


def test_fail_passes_good_tokens(tokens):
    kept, _ = parse_samples(tokens(GOOD), "fail")
    assert kept.agg(F.sum("label")).first()[0] == 59.5


def test_unknown_policy(tokens):
    with pytest.raises(ValueError):
        parse_samples(tokens(GOOD), "ignore")


def test_only_finite_samples_enter_a_fit(tokens):
    kept, _ = parse_samples(tokens([*GOOD, *NOT_FINITE]), "drop")
    assert kept.count() == len(GOOD) + len(NOT_FINITE)
    assert finite_samples(kept).count() == len(GOOD)


def test_a_filter_does_not_repeat_the_parsing(tokens):
    kept, _ = parse_samples(tokens(GOOD), "drop")
    plan = finite_samples(kept)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") == 2
