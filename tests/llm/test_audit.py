"""The audit of filters against a plain count in every order."""

import random
import re
from itertools import permutations

import pytest

from oracle_check import SMALL, connect, spark_rows, sql_rows
from streamlens.llm import audit
from streamlens.llm.queries import ORACLE, QUERIES

LABELS = "doc_id long, quality int, toxic int, source string"


def plain(rows, labels):
    """Rows of (doc_id, text, source) and (doc_id, quality, toxic), order by order."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    judged = []
    for doc_id, text, source in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > least[text],
        }
        good = any(d == doc_id and q == 1 for d, q, _ in labels if d is not None)
        toxic = any(d == doc_id and t == 1 for d, _, t in labels if d is not None)
        judged.append((source or "", {k for k, v in fails.items() if v}, good, toxic))
    out = {}
    for order in permutations("ABCDE"):
        for step, letter in enumerate(order, 1):
            for part, failed, good, toxic in judged:
                row = out.setdefault((part, "".join(order), step), [0] * 6)
                gone = bool(failed & set(order[: step - 1]))
                here = letter in failed and not gone
                row[0] += not gone and not here
                row[1] += here
                row[2] += gone and letter in failed
                row[3] += failed == {letter}
                row[4] += here and good
                row[5] += here and toxic
    shapley = {}
    for (part, order, step), row in out.items():
        key = part, order[step - 1]
        shapley[key] = shapley.get(key, 0) + row[1]
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def documents_of(rng):
    words = ["The", "a", "of", "ABC", "x#", "é", "日本", "50%", "word"] + [f"w{i}" for i in range(80)]
    texts = [None, "", " \n\t", "ONE", "|"]
    texts += [" ".join(rng.choices(words[: rng.randint(1, 89)], k=rng.randint(1, 120))) for _ in range(40)]
    texts += ["\x0b".join(f"w{i}" for i in range(60)), "long " * 30000]
    sources = [None, "", "s1", "s2"]
    return [
        (rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(sources)) for _ in range(160)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_plain_count(spark, seed):
    rng = random.Random(seed)
    rows = documents_of(rng)
    rows += [(0, "hot text", "s1")] * 30 + [(None, "hot text", "s1")] * 30 + [(7, "hot text", None)] * 9
    labels = [(rng.choice([None, *range(45)]), rng.choice([None, 0, 1, 2]), rng.choice([None, 0, 1])) for _ in range(60)]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, source string, part string, n int, h int")
    marks = spark.createDataFrame([(*r, "x") for r in labels], LABELS)
    got = sorted(tuple(r) for r in audit.report(docs.repartition(5), marks).collect())
    assert got == plain(rows, labels)


def test_texts_in_doubt_are_compared_whole(spark, monkeypatch):
    """All texts share the few cells of a page, so all are in doubt; results are the same."""
    monkeypatch.setattr(audit, "MAX_PAGES", 1)
    monkeypatch.setattr(audit, "_cells", lambda: [audit.F.lit(3).cast("long")] * 2)
    rows = documents_of(random.Random(3))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = spark.createDataFrame([], LABELS)
    got = sorted(tuple(r) for r in audit.report(docs, marks).collect())
    assert got == plain(rows, [])


def test_sketch_clears_unique_texts(spark):
    texts = [f"text {i}" for i in range(3000)] + ["copy"] * 500
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'s' AS source")
    found = audit.facts(docs)
    pages = audit.sketch(found, 1)
    doubt = audit.with_doubt(found, pages, 1).filter("doubt")
    assert 500 <= doubt.count() < 500 + 0.05 * 3000
    # Texts are read by the side of the sketch: the only shuffle behind it carries those in doubt.
    plan = audit.with_doubt(audit._hashed(docs), pages, 1)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert audit.report(docs, spark.createDataFrame([], LABELS)).collect() == []


def test_query_equals_its_sql(spark):
    name = "op11_filter_audit"
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(connect(SMALL), ORACLE[name])
