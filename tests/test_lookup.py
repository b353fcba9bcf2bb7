import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from streamlens.operators import joins, lookup
from streamlens.sources.tables import nearby_by_sql

REVIEWS = "reviewer_id string, restaurant_id int, rating double"
RESTAURANTS = "id int, category string, lat double, lng double"


def brute_force(reviews, restaurants, lat, lng, min_rating=3.0):
    """The lookup by nested loops; ``{(reviewer, category, lat, lng): average}``."""
    groups = defaultdict(list)
    for who, where, rating in reviews:
        if where is None or rating is None or math.isnan(rating) or not rating > min_rating:
            continue
        for key, category, at, along in restaurants:
            if key == where and lat[0] <= at <= lat[1] and lng[0] <= along <= lng[1]:
                groups[who, category, at, along].append(rating)
    return {key: sum(found) / len(found) for key, found in groups.items()}


def as_dict(df):
    rows = df.collect()
    found = {(r.reviewer_id, r.category, r.lat, r.lng): r.avg_rating for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="module")
def skewed(spark):
    """Tables in which one restaurant has a third of all reviews, and one pair of it too."""
    draw = random.Random(5)
    reviews = [(f"u{draw.randrange(40)}", draw.randrange(60), draw.randrange(1, 11) / 2) for _ in range(1500)]
    reviews += [(f"u{draw.randrange(40)}", 7, draw.randrange(1, 11) / 2) for _ in range(600)]
    reviews += [("u1", 7, 4.0)] * 600
    reviews += [("u2", None, 5.0), ("u3", 9, None), (None, 11, 5.0), ("u4", 12, math.nan), ("u5", 13, 3.0)]
    restaurants = [
        (i, f"c{i % 4}", 52.0 + draw.randrange(20) / 10, 13.2 + draw.randrange(30) / 100)
        for i in range(50)
    ]
    restaurants += restaurants[5:9] + [(7, "other", 52.5, 13.35), (None, "c1", 52.5, 13.35)]
    return (
        reviews,
        restaurants,
        spark.createDataFrame(reviews, REVIEWS).repartition(4),
        spark.createDataFrame(restaurants, RESTAURANTS).repartition(3),
    )


def test_known_lookup(spark):
    reviews = spark.createDataFrame(
        [("r1", 10, 4.0), ("r2", 10, 2.0), ("r3", 11, 5.0), ("r1", 10, 5.0)], REVIEWS
    )
    restaurants = spark.createDataFrame(
        [(10, "pizza", 52.5002, 13.35), (11, "cafe", 52.6001, 13.5)], RESTAURANTS
    )
    got = lookup.nearby_rated(reviews, restaurants, (52.0, 53.0), (13.3, 13.4))
    assert got.columns == ["reviewer_id", "category", "lat", "lng", "avg_rating"]
    assert [tuple(r) for r in got.collect()] == [("r1", "pizza", 52.5002, 13.35, 4.5)]


def test_ends_are_inside_and_the_threshold_is_outside(spark):
    restaurants = spark.createDataFrame(
        [(1, "a", 52.0, 13.3), (2, "a", 53.0, 13.4), (3, "a", 53.1, 13.35), (4, "a", 52.5, 13.41)],
        RESTAURANTS,
    )
    reviews = spark.createDataFrame(
        [("r", i, 3.5) for i in range(1, 5)] + [("s", 1, 3.0), ("s", 2, None)], REVIEWS
    )
    got = lookup.nearby_rated(reviews, restaurants, (52.0, 53.0), (13.3, 13.4))
    assert sorted((r.reviewer_id, r.lat) for r in got.collect()) == [("r", 52.0), ("r", 53.0)]


def test_empty_band(skewed):
    assert lookup.nearby_rated(skewed[2], skewed[3], (10.0, 11.0), (13.3, 13.4)).isEmpty()


@pytest.mark.parametrize(
    "broadcast_bytes, hot_parts",
    [(1 << 20, 1000), (0, 1000), (1000, 10), (0, 1)],
    ids=["broadcast", "salted", "hot broadcast", "none hot"],
)
def test_lookup_equals_nested_loops(skewed, monkeypatch, broadcast_bytes, hot_parts):
    monkeypatch.setattr(joins, "HOT_PARTS", hot_parts)
    reviews, restaurants, reviews_df, restaurants_df = skewed
    lat, lng = (52.3, 53.2), (13.25, 13.45)
    got = as_dict(
        lookup.nearby_rated(
            reviews_df, restaurants_df, lat, lng, limit=None, broadcast_bytes=broadcast_bytes
        )
    )
    want = brute_force(reviews, restaurants, lat, lng)
    assert got == pytest.approx(want) and len(want) > 100


def test_hot_keys_are_found_and_spread(skewed):
    _, _, reviews, restaurants = skewed
    hot = joins.hot_keys(reviews.select("restaurant_id"), ["restaurant_id"])
    of_seven = reviews.select(F.xxhash64(F.lit(7))).first()[0]
    assert of_seven in hot
    records = lookup.weighted_restaurants(restaurants).withColumnRenamed("id", "restaurant_id")
    plain = reviews.join(records, "restaurant_id")
    for limit in (0, 1 << 20):
        spread = joins.spread_join(
            reviews,
            records,
            ["restaurant_id"],
            ["reviewer_id", "rating"],
            [of_seven],
            broadcast_bytes=limit,
        ).select(plain.columns)
        assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_keys_of_other_integer_types_still_meet(spark, skewed):
    reviews, restaurants, reviews_df, restaurants_df = skewed
    long_ids = restaurants_df.withColumn("id", F.col("id").cast("long"))
    out_of_range = spark.createDataFrame([(1 << 40, "x", 52.5, 13.35)], long_ids.schema)
    lat, lng = (52.0, 54.0), (13.0, 14.0)
    got = lookup.nearby_rated(
        reviews_df, long_ids.union(out_of_range), lat, lng, limit=None, broadcast_bytes=0
    )
    assert as_dict(got) == pytest.approx(brute_force(reviews, restaurants, lat, lng))


def test_keys_of_unlike_types_are_refused(skewed):
    texts = skewed[3].withColumn("id", F.col("id").cast("string"))
    with pytest.raises(TypeError, match="cast one of them"):
        lookup.rated_groups(skewed[2], texts)


def test_limit_takes_the_first_groups_in_key_order(skewed):
    lat, lng = (52.0, 54.0), (13.0, 14.0)
    whole = lookup.nearby_rated(skewed[2], skewed[3], lat, lng, limit=None)
    first = lookup.nearby_rated(skewed[2], skewed[3], lat, lng, limit=5)
    want = sorted((tuple(r) for r in whole.filter("reviewer_id is not null").collect()))
    got = [tuple(r) for r in first.filter("reviewer_id is not null").collect()]
    nulls = whole.filter("reviewer_id is null").count()
    assert got == want[: 5 - min(nulls, 5)]


@pytest.mark.parametrize("shuffle", [False, True])
@pytest.mark.parametrize("limit", [None, 3])
def test_many_bands_equal_one_by_one(spark, skewed, monkeypatch, shuffle, limit):
    reviews, restaurants, reviews_df, restaurants_df = skewed
    if shuffle:
        bounded = joins.join_settled
        monkeypatch.setattr(
            lookup, "join_settled", lambda *a, **k: bounded(*a, **{**k, "max_rows": 0})
        )
    half, lng = 0.15, (13.25, 13.45)
    centres = [52.0, 52.05, 52.5, 52.5, 53.35, 60.0, -7.0]
    bands = spark.createDataFrame(
        [(i, c - half, c + half) for i, c in enumerate(centres)]
        + [(90, math.nan, math.nan), (91, math.inf, math.inf), (92, None, None)],
        "batch_id long, lat_low double, lat_high double",
    )
    got = lookup.nearby_rated_per_batch(
        reviews_df,
        restaurants_df,
        bands,
        lng,
        half,
        limit_per_batch=limit,
        broadcast_bytes=0 if shuffle else 1 << 20,
    ).collect()
    for i, c in enumerate(centres):
        want = brute_force(reviews, restaurants, (c - half, c + half), lng)
        found = {(r.reviewer_id, r.category, r.lat, r.lng): r.avg_rating for r in got if r.batch_id == i}
        if limit is not None:
            first = sorted(want, key=lambda k: (k[0] is not None, k))[:limit]
            want = {k: want[k] for k in first}
        assert found == pytest.approx(want)
    assert {r.batch_id for r in got} <= set(range(len(centres)))


def test_no_band_gives_no_row(spark, skewed):
    bands = spark.createDataFrame([], "batch_id long, lat_low double, lat_high double")
    got = lookup.nearby_rated_per_batch(skewed[2], skewed[3], bands, (13.0, 14.0), 0.1)
    assert got.isEmpty()


def test_sql_statement_equals_the_dataframe(spark, skewed):
    _, _, reviews, restaurants = skewed
    spark.sql("CREATE DATABASE IF NOT EXISTS restaurants")
    assert not reviews.filter("isnan(rating)").isEmpty()
    reviews.write.format("orc").mode("overwrite").saveAsTable("restaurants.reviews")
    restaurants.write.format("orc").mode("overwrite").saveAsTable("restaurants.restaurants")
    lat, lng = (52.3, 53.2), (13.3, 13.4)
    by_sql = nearby_by_sql(spark, lat)
    assert by_sql.columns == list(lookup.RESULT_COLUMNS)
    by_frame = lookup.nearby_rated(reviews, restaurants, lat, lng, limit=None)
    assert as_dict(by_sql) == pytest.approx(as_dict(by_frame))


def test_band_reaches_the_orc_scan(spark, skewed, tmp_path):
    path = str(tmp_path / "restaurants")
    skewed[3].withColumn("unused", F.lit("x")).write.orc(path)
    near = lookup.within_band(spark.read.orc(path), (52.3, 53.2), (13.3, 13.4))
    plan = near.select("id")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(lat,52.3)" in plan and "LessThanOrEqual(lat,53.2)" in plan
    assert "ReadSchema: struct<id:int,lat:double,lng:double>" in plan


def scans_of(df, column):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(column in line for line in plan.splitlines() if "FileScan" in line)


def test_few_ids_reach_the_scan_of_the_reviews(spark, skewed, tmp_path):
    skewed[2].write.parquet(str(tmp_path / "reviews"))
    reviews = spark.read.parquet(str(tmp_path / "reviews"))
    found = lookup.nearby_rated(reviews, skewed[3], (52.3, 52.6), (13.25, 13.45), limit=None)
    plan = found._jdf.queryExecution().toString()
    assert "In(restaurant_id" in plan
    assert as_dict(found) == pytest.approx(
        brute_force(skewed[0], skewed[1], (52.3, 52.6), (13.25, 13.45))
    )


def test_skewed_shuffle_path_reads_the_reviews_once(spark, skewed, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "HOT_PARTS", 1000)
    monkeypatch.setattr(lookup, "SCANNED_IDS", 0)
    skewed[2].write.parquet(str(tmp_path / "reviews"))
    reads = []
    folded = lookup.settle
    monkeypatch.setattr(
        lookup, "settle", lambda df: reads.append(scans_of(df, "restaurant_id")) or folded(df)
    )
    found = lookup.rated_groups(
        spark.read.parquet(str(tmp_path / "reviews")), skewed[3], broadcast_bytes=0
    )
    # Once to fold them; what follows starts from the settled sums.
    assert reads == [1]
    assert scans_of(found, "restaurant_id") == 0
    assert found.count() > 100


def test_bands_wider_than_a_bin_are_counted(spark, skewed):
    reviews, restaurants, reviews_df, restaurants_df = skewed
    bands = spark.createDataFrame([(0, 52.0, 54.0)], "batch_id long, lat_low double, lat_high double")
    got = lookup.nearby_rated_per_batch(reviews_df, restaurants_df, bands, (13.25, 13.45), 0.01)
    want = brute_force(reviews, restaurants, (52.0, 54.0), (13.25, 13.45))
    assert as_dict(got.drop("batch_id")) == pytest.approx(want)


def test_large_limits_are_ranked_by_ranges(spark):
    rows = [(b, f"r{i:05d}", "c", 1.0, 2.0, 3.0) for b in (0, 1) for i in range(3000)]
    found = spark.createDataFrame(
        rows, "batch_id long, reviewer_id string, category string, lat double, lng double, avg_rating double"
    ).repartition(8)
    got = sorted(tuple(r) for r in lookup.first_per_batch(found, 1500).collect())
    assert got == sorted(r for r in rows if int(r[1][1:]) < 1500)
