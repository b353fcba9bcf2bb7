"""Detections and their suppression against plain matching, rule by rule."""

import random
import re

import pytest

from streamlens.llm import licenses

PHRASES = [
    "MIT License", "the MIT license", "Apache License, Version 2.0", "apache software licence 1.1", "Apache-2.0",
    "GNU General Public License version 3", "gnu lesser general public license v2.1", "GPLv3", "GPL-2.0-or-later",
    "SPDX-License-Identifier: Apache-2.0", "SPDX-License-Identifier: MIT", "spdx-license-identifier: GPL-3.0-only",
    "BSD 3-clause license", "2-Clause BSD", "new BSD license", "cc-by 4.0", "CC BY-SA 3.0", "cc by-nc-nd 2.0",
    "Creative Commons Attribution-ShareAlike 4.0", "https://creativecommons.org/licenses/by-sa/4.0/",
    "Mozilla Public License 2.0", "mpl 2.0", "Eclipse Public License", "all rights reserved", "public domain",
    "Permission is hereby granted, free of charge, to any person", "Permission is hereby  granted,\nfree of charge",
]


def plain_detections(text):
    low, hits = text.lower(), []
    for at, rule in enumerate(licenses.rules()):
        if all(word in low for word in rule.keyword.split()):
            pattern = licenses._BEFORE + "(?:" + licenses._spaced(rule.pattern) + ")" + licenses._AFTER
            found = re.finditer(pattern.replace(r"\z", r"\Z"), text, re.I | re.S | re.A)
            hits += [(m.start(), -m.end(), -rule.priority, at, rule.label) for m in found if m.end() > m.start()]
    kept, ends = [], []
    for start, end, priority, _, label in sorted(hits):
        if not any(p <= priority and e <= end for p, e in ends):
            kept.append((label, -priority, start, -end))
        ends.append((priority, end))
    return kept


def texts(rng):
    words = ["software", "under", "the", "of", "License", "é", "日本", "2.0", "GNU", "x"]
    for size in (0, 1, 3, 10, 40, 150, 400):
        parts = [rng.choice(PHRASES if rng.random() < 0.6 else words) for _ in range(size)]
        yield rng.choice([" ", "\n", ", ", " * "]).join(parts)
    yield "MIT license" * 3
    yield " ".join(["mit license"] * 300)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_detections_equal_plain_matching(spark, seed):
    rows = list(enumerate(texts(random.Random(seed)))) + [(99, None)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, label string")
    got = {r.doc_id: [tuple(d) for d in r.detections] for r in licenses.detections(df).collect()}
    assert got == {i: plain_detections(t or "") for i, t in rows}
    assert max(map(len, got.values())) > 3 * licenses.CHUNK


def test_words_are_counted_in_blocks(spark):
    rng = random.Random(4)
    signs = ["a", "Z", "0", "é", "日", "😀", "\u00a0", " ", "\n", ".", "_", "-", "\x7f", "\x00"]
    rows = ["".join(rng.choice(signs) for _ in range(n)) for n in range(0, 400, 7)]
    rows += [" ".join(["w"] * n) for n in (1, 63, 64, 65, 128, 129, 1000)] + ["", ".", "..", ".a", "a.", "x" * 5000]
    # Long runs of signs or letters are looked at once, not from each of their places.
    rows += ["." * 1_000_000, "a" + " " * 1_000_000, "." * 1_000_000 + "a" * 1_000_000]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.n for r in df.select("doc_id", licenses._word_count("text").alias("n")).collect()}
    assert got == {i: len(re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text)) for i, text in enumerate(rows)}


def test_rules_are_looked_at_in_groups():
    """What a text is searched for does not grow with the number of versions of a license."""
    rules = licenses.rules()
    groups = {(r.gate, r.keyword, r.stem) for r in rules}
    assert 4 * len(groups) < len(rules)
    assert licenses._rule_table().count("'keywords'") == len(groups)
    for rule in rules:
        words = (rule.gate or rule.keyword).split()
        assert any(all(any(w in own for own in words) for w in gate) for gate in licenses._gates())
        # The start of a pattern, or with one choice of it, is what is looked for.
        if rule.stem and not rule.stem.endswith(("[0-9]", "by", "attribution")):
            assert rule.pattern.startswith(rule.stem)
    for word in {w for gate in licenses._gates() for w in gate}:
        assert word.endswith(end := licenses._rare_end(word)) and len(end) >= min(3, len(word))


def test_each_rule_finds_its_own_text(spark):
    """One text for every rule, made from its pattern: no gate, keyword or stem keeps it from being found."""
    rows = []
    for at, rule in enumerate(licenses.rules()):
        text = re.sub(r"\[cs\]", "c", rule.pattern).replace(r"\.", ".").replace(".{1,80}?", "me").replace(r"['\"]?", "").replace(r"\(", "").replace(r"\)", "")
        text = re.sub(r"\[- ?\]\??", "-", text).replace("[0-9.]+", "3").replace("[;,]?", "").replace(r"\+", "+")
        while "(" in text:
            text = re.sub(r"\((?:\?:)?([^()|]*)(?:\|[^()]*)?\)\??", r"\1", text)
        text = re.sub(r"(.)\?", r"\1", text).upper()
        rows.append((at, f"Under {text} here."))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: {(d.start, d.priority) for d in r.detections} for r in licenses.detections(df).collect()}
    want = {i: {(d[2], d[1]) for d in plain_detections(t)} for i, t in rows}
    assert got == want and sum(map(bool, got.values())) > 0.9 * len(rows)


def test_long_texts_take_time_in_proportion(spark):
    """A megabyte of matches; by appending to one list it would take minutes."""
    one = "Released under the MIT License or GNU General Public License version 3. "
    df = spark.createDataFrame([(1, one * 14_000)], "doc_id long, text string")
    row = licenses.scan(df).selectExpr("size(detections) AS n", "n_base").first()
    assert (row.n, row.n_base) == (28_000, 28_000)
