import pytest

import __spark_entry__ as contract
from oracle_check import SMALL, connect, spark_rows, sql_rows

LLM = {n for n in contract.queries() if n.startswith("op") and n[2].isdigit() or n == "pipeline"}
# Beyond SQL; tests/llm compares them with brute force.
WITHOUT_SQL = LLM - set(contract.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["reviewer_id", "category", "lat", "lng", "avg_rating"]
    assert df.count() == 5


def test_every_query_has_sql():
    assert set(contract.queries()) - set(contract.oracle_sql()) == WITHOUT_SQL
    assert not set(contract.oracle_sql()) - set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - LLM))
def test_query_equals_its_sql(spark, con, name):
    got = spark_rows(contract.queries()[name](spark, SMALL))
    assert got == sql_rows(con, contract.oracle_sql()[name])
    assert got[1]


# Not streams: those run a job.
PLAIN = sorted(
    n for n in set(contract.queries()) - LLM if n[:7] != "stream_" and n != "two_runs_one_table"
)

# These pair every row with one row: a global model or a global deviation.
ONE_ROW_SIDE = {
    "ridge_predictions",
    "prediction_triples",
    "in_sample_metrics",
    "holdout_metrics",
    "scaled_features",
    "fit_of_days_from_store",
    "sgd_fit",
}


@pytest.mark.parametrize("name", PLAIN)
def test_no_query_compares_every_pair(spark, name):
    plan = contract.queries()[name](spark, SMALL)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert ("BroadcastNestedLoopJoin" in plan) == (name in ONE_ROW_SIDE)
    assert "Python" not in plan
