"""Stored tables whose join moves nothing."""

import pytest

from streamlens.operators import lookup
from streamlens.sources import colocated
from streamlens.sources.tables import catalog_table


@pytest.fixture(scope="module")
def tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS colocated")
    restaurants = [(i % 90, f"c{i % 4}", 50.0 + i % 30, 13.0 + i % 3) for i in range(140)]
    restaurants += [(5, "c1", 55.0, 13.5)] * 2 + [(None, "c0", 50.0, 13.0)]
    # A third of the reviews on one restaurant; ratings that count for nothing among them.
    ratings = [None, float("nan"), 1.0, 3.0, 3.5, 4.0, 5.0]
    reviews = [(f"u{i % 300}", 5 if i % 3 == 0 else i % 95, ratings[i % 7]) for i in range(6000)]
    reviews += [("u1", None, 5.0), (None, 5, 4.0), (None, 6, 4.5)]
    reviews = spark.createDataFrame(reviews, "reviewer_id string, restaurant_id int, rating double")
    restaurants = spark.createDataFrame(restaurants, "id int, category string, lat double, lng double")
    colocated.store_reviews(reviews, "colocated.reviews", 8)
    colocated.store_restaurants(restaurants, "colocated.restaurants", 8)
    yield reviews, restaurants
    spark.sql("DROP DATABASE colocated CASCADE")


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("lat, lng", [(None, None), ((55.0, 60.0), (13.0, 14.0)), ((90.0, 91.0), (0.0, 1.0))])
def test_equals_the_lookup_that_shuffles(spark, tables, lat, lng):
    reviews, restaurants = tables
    near = restaurants if lat is None else lookup.within_band(restaurants, lat, lng)
    want = lookup.rated_groups(reviews, near, broadcast_bytes=0)
    got = colocated.colocated_groups(spark, "colocated.reviews", "colocated.restaurants", lat, lng)
    assert rows(lookup.top_groups(got, None)) == rows(lookup.top_groups(want, None))


def test_the_join_moves_nothing(spark, tables):
    stored = [catalog_table(spark, f"colocated.{n}") for n in ("reviews", "restaurants")]
    matched = colocated.colocated_matches(*stored)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan
    assert "Exchange" not in plan and "Sort" not in plan
    # Behind it, group sums are what is shuffled, once.
    groups = colocated.colocated_groups(spark, "colocated.reviews", "colocated.restaurants")
    assert groups._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_a_hot_restaurant_is_spread_over_buckets(spark, tables):
    stored = catalog_table(spark, "colocated.reviews").filter("restaurant_id = 5")
    parts = [r["count"] for r in stored.groupBy("part").count().collect()]
    assert len(parts) == colocated.PARTS and max(parts) < 2 * sum(parts) / len(parts)
    assert len(stored.inputFiles()) > 1
