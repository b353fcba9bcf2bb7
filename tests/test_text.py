import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamlens.functions.text import pair_text, parse_double, split_line
from streamlens.functions.time import epoch_day, utc_instant, utc_wall_clock
from streamlens.operators.tokens import (
    count_tokens,
    explode_tokens,
    message_values,
    preview_tokens,
)

LINES = {
    "": [""],
    " ": [],
    "   ": [],
    " a": ["", "a"],
    "a ": ["a"],
    "a  b ": ["a", "", "b"],
    "a\tb": ["a\tb"],
    "a\n b": ["a\n", "b"],
}


def test_lines_split_on_single_spaces(spark):
    df = spark.createDataFrame([(line,) for line in LINES], "line string")
    got = {r.line: r.t for r in df.select("line", split_line(F.col("line")).alias("t")).collect()}
    assert got == LINES


def java_split(line):
    """String.split of Java by its documentation: trailing empty strings are dropped."""
    if line == "":
        return [""]
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" a,\t1é", max_size=12), min_size=1, max_size=30))
def test_lines_split_like_java(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    rows = df.select("line", split_line(F.col("line")).alias("t")).collect()
    assert [r.t for r in rows] == [java_split(r.line) for r in rows]


def test_null_value_gives_no_token(spark):
    df = spark.createDataFrame([(None,), ("x y",)], "value string")
    assert [(r.pos, r.token) for r in explode_tokens(df).collect()] == [(0, "x"), (1, "y")]


def test_message_value_is_text_without_key(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray(b"5,1"))], "key binary, value binary")
    got = message_values(df)
    assert got.columns == ["value"] and got.first().value == "5,1"


NUMBERS = {
    "1.0d": 1.0,
    "1f": 1.0,
    "1D": 1.0,
    "0x1p3": 8.0,
    "0x1.8p1": 3.0,
    " 2 ": 2.0,
    "\t5 ": 5.0,
    "+5": 5.0,
    "-.5": -0.5,
    "5.": 5.0,
    "1e3": 1000.0,
    "1e400": math.inf,
    "Infinity": math.inf,
    "-Infinity": -math.inf,
    "\tInfinity": math.inf,
    "1_0": None,
    "1L": None,
    "abc": None,
    "": None,
    " ": None,
    "\t": None,
    ".": None,
    "nan": None,
    "Nan": None,
    "inf": None,
    "+inf": None,
    "-INF": None,
    "Inf": None,
    "INFINITY": None,
    "infinity": None,
    "\tinf": None,
    " nan\n": None,
    "5x\n": None,
    "٣": None,
}


def test_doubles_read_by_java_rules(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    got = {r.t: r.v for r in df.select("t", parse_double(F.col("t")).alias("v")).collect()}
    assert got == NUMBERS


@pytest.mark.parametrize("text", ["NaN", "+NaN", "-NaN"])
def test_nan_is_accepted(spark, text):
    assert math.isnan(spark.range(1).select(parse_double(F.lit(text))).first()[0])


def test_pair_text(spark):
    row = spark.range(1).select(
        pair_text(F.lit(52.5003), F.lit(52.5)), pair_text(F.lit(1e7), F.lit(1e-4))
    )
    assert tuple(row.first()) == ("(52.5003,52.5)", "(1.0E7,1.0E-4)")


def test_preview_keeps_stream_order(spark):
    rows = [("t", 0, i, p, f"{i}.{p}") for i in range(9) for p in range(2)]
    df = spark.createDataFrame(
        rows, "topic string, partition int, offset long, pos int, token string"
    )
    got = [r.token for r in preview_tokens(df.repartition(3)).collect()]
    assert got == [r[4] for r in rows[:10]]


def test_token_count(spark):
    df = spark.createDataFrame([("a b a",), ("a",), (" ",)], "value string")
    got = {r.token: r.n for r in count_tokens(explode_tokens(df)).collect()}
    assert got == {"a": 3, "b": 1}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_does_not_follow_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ts = F.expr("TIMESTAMP_NTZ '2024-03-10 02:30:00.5'")
        row = spark.range(1).select(
            F.unix_micros(utc_instant(ts)).alias("micros"),
            utc_wall_clock(utc_instant(ts)).cast("string").alias("wall"),
            epoch_day(ts).alias("day"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (1710037800500000, "2024-03-10 02:30:00.5", 19792)
