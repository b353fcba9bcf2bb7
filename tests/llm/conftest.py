import pytest

from streamlens.llm.queries import importable_on_workers


@pytest.fixture(autouse=True)
def workers(spark):
    importable_on_workers(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) and columns that clash with added ones."""

    def build(*rows, clashing=()):
        full = [(*r, *(None,) * (4 - len(r)), None) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        for name in clashing:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return build
