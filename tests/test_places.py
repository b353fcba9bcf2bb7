"""Restaurants stored by place."""

import math
import random

import pytest
from pyspark.sql import functions as F

from streamlens.operators.lookup import within_band
from streamlens.sources import places

SCHEMA = "id int, category string, lat double, lng double"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(1)
    rows = [(i, f"c{i % 3}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(8000)]
    rows += [(9000, "x", None, 1.0), (9001, "x", 1.0, float("nan")), (9002, "x", math.inf, 1.0), (None, "x", 52.0, 13.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path_factory.mktemp("places"))
    places.store_by_place(df, path, 64)
    return df, path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plain(x, y):
    return sum(((x >> b & 1) << 2 * b) | ((y >> b & 1) << 2 * b + 1) for b in range(places.BITS))


def test_bits_take_turns(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(1 << 16), rng.randrange(1 << 16)) for _ in range(200)] + [(0, 0), (65535, 65535)]
    df = spark.createDataFrame(pairs, "x long, y long")
    got = df.select(places.z_value(F.col("x"), F.col("y")).alias("z")).collect()
    assert [r.z for r in got] == [plain(x, y) for x, y in pairs]


@pytest.mark.parametrize("lat, lng", [((52.0, 56.0), (13.0, 21.0)), ((-90.0, 90.0), (5.0, 9.0)), ((60.0, 61.0), (-180.0, 180.0)), ((95.0, 99.0), (0.0, 1.0))])
def test_a_band_opens_few_files_and_misses_no_row(spark, stored, lat, lng):
    df, path = stored
    found = places.restaurants_in_band(spark, path, df.schema, lat, lng)
    assert rows(found) == rows(within_band(df, lat, lng))
    files = places.files_in_band(spark, path, lat, lng)
    # A box of a fiftieth of both directions meets a few of 64 files, a strip about 8 or 16.
    assert len(files) <= (20 if lat[1] - lat[0] < 100 and lng[1] - lng[0] < 100 else 24)
    if lat == (52.0, 56.0):
        assert 1 <= len(files) <= 6
    if files:
        assert {f.split("/")[-1] for f in found.inputFiles()} == {f.split("/")[-1] for f in files}
        assert "PushedFilters: [" in found._jdf.queryExecution().toString()


def test_storing_again_replaces(spark, tmp_path):
    for n in (50, 30, 0):
        df = spark.range(n).selectExpr("CAST(id AS INT) AS id", "'c' AS category", "id * 1.0D AS lat", "1.0D AS lng")
        before = df.schema
        places.store_by_place(df, str(tmp_path / "p"), 4)
        assert places.restaurants_in_band(spark, str(tmp_path / "p"), before, (0.0, 99.0), (0.0, 2.0)).count() == n
