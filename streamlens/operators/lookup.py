"""Search bands and the rated lookup they drive."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlens.functions.text import is_finite
from streamlens.operators.joins import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    aligned,
    hot_keys,
    join_settled,
    rows_and_bytes,
    spread_join,
)
from streamlens.sources.scratch import settle

GROUP_KEYS = ("reviewer_id", "category", "lat", "lng")
RESULT_COLUMNS = (*GROUP_KEYS, "avg_rating")
# Up to so many restaurants, their ids are a predicate on the scan of the reviews.
SCANNED_IDS = 1000


def search_band(prediction: Column, half_width: float) -> tuple[Column, Column]:
    """Both ends of the band around a prediction."""
    return prediction - F.lit(half_width), prediction + F.lit(half_width)


def within_band(restaurants: DataFrame, lat: tuple, lng: tuple) -> DataFrame:
    """Rows inside both bands, ends included.

    Plain numbers as bounds reach the file scan as typed predicates.
    """
    return restaurants.filter(F.col("lat").between(*lat) & F.col("lng").between(*lng))


def rated_above(reviews: DataFrame, min_rating: float) -> DataFrame:
    """Reviews rated strictly above; null and NaN ratings are left out."""
    rating = F.col("rating")
    return reviews.filter((rating > F.lit(float(min_rating))) & ~F.isnan(rating))


def weighted_restaurants(restaurants: DataFrame) -> DataFrame:
    """Distinct restaurant records with the number of their ``copies``.

    Joined in place of the records, they keep a repeated record from
    multiplying the review rows.
    """
    known = restaurants.filter(F.col("id").isNotNull())
    return known.groupBy("id", "category", "lat", "lng").agg(
        F.count(F.lit(1)).cast("long").alias("copies")
    )


def rated_matches(
    reviews: DataFrame,
    restaurants: DataFrame,
    min_rating: float = 3.0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rated reviews with their restaurant records (inner join on the id).

    A row may stand for several equal matches: ``times`` of them with ratings
    that sum to ``total``.  ``restaurants`` may be weighted already.

    * If the restaurants are proven small they are broadcast and the reviews
      stay where they are; of very few restaurants the ids reach the scan.
    * Otherwise the reviews are folded to sums per restaurant and reviewer, which
      spreads a hot restaurant over its reviewers and reads them once; the sums are
      settled and shuffled on the id, and hot ids are spread, see ``spread_join``.
    """
    weighted = "copies" in restaurants.columns
    if not weighted:
        restaurants = restaurants.select("id", "category", "lat", "lng")
    rows, size = rows_and_bytes(restaurants)
    small = size <= broadcast_bytes
    records = restaurants if weighted else weighted_restaurants(restaurants)
    rated = rated_above(reviews, min_rating).filter(F.col("restaurant_id").isNotNull())
    if rows <= SCANNED_IDS:
        ids = [row["id"] for row in records.select("id").distinct().orderBy("id").collect()]
        rated = rated.filter(F.col("restaurant_id").isin(ids))
    rated = rated.select("reviewer_id", "restaurant_id", "rating")
    on = ["restaurant_id"]
    records = aligned(records.withColumnRenamed("id", "restaurant_id"), rated, on)
    if small:
        matched = rated.join(F.broadcast(records), on).withColumn("times", F.lit(1))
    else:
        folded, _ = settle(
            rated.groupBy("restaurant_id", "reviewer_id").agg(
                F.sum("rating").alias("rating"), F.count(F.lit(1)).alias("times")
            )
        )
        matched = spread_join(
            folded, records, on, ["reviewer_id"], hot_keys(folded, on), broadcast_bytes=broadcast_bytes
        )
    return matched.select(
        *GROUP_KEYS,
        (F.col("rating") * F.col("copies")).alias("total"),
        (F.col("times") * F.col("copies")).alias("times"),
    )


def rated_groups(
    reviews: DataFrame,
    restaurants: DataFrame,
    min_rating: float = 3.0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Average rating per reviewer and restaurant record."""
    matched = rated_matches(reviews, restaurants, min_rating, broadcast_bytes)
    return matched.groupBy(*GROUP_KEYS).agg(
        (F.sum("total") / F.sum("times")).alias("avg_rating")
    )


def top_groups(groups: DataFrame, limit: int | None) -> DataFrame:
    """The result columns, and the first ``limit`` groups in key order if one is given."""
    result = groups.select(*RESULT_COLUMNS)
    return result if limit is None else result.orderBy(*GROUP_KEYS).limit(limit)


def nearby_rated(
    reviews: DataFrame,
    restaurants: DataFrame,
    lat: tuple[float, float],
    lng: tuple[float, float],
    min_rating: float = 3.0,
    limit: int | None = 5,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rated groups of the restaurants inside one band."""
    near = within_band(restaurants, lat, lng)
    return top_groups(rated_groups(reviews, near, min_rating, broadcast_bytes), limit)


def first_column_list(result: DataFrame) -> DataFrame:
    """The reviewers of a result, as a table."""
    return result.select("reviewer_id")


def _bins(low: Column, high: Column, width: float) -> Column:
    return F.sequence(F.floor(low / width), F.floor(high / width))


def nearby_rated_per_batch(
    reviews: DataFrame,
    restaurants: DataFrame,
    bands: DataFrame,
    lng: tuple[float, float],
    half_width: float,
    min_rating: float = 3.0,
    limit_per_batch: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The lookup for many bands ``(batch_id, lat_low, lat_high)`` at once.

    A band is never compared with every restaurant: latitudes are cut into
    bins of twice ``half_width``, so a band of that width touches three at most and the
    comparison becomes an equality of bins, checked exactly afterwards.  Wider bands
    touch more; the bins are counted before they are broadcast.

    Averages do not depend on the band, so reviews are joined and averaged
    once, for the restaurants some band can reach.  Only finished groups are
    then matched with bands, and every pair that comes out is a row of the
    result.
    """
    width = 2 * half_width
    usable = bands.filter(is_finite(F.col("lat_low")) & is_finite(F.col("lat_high")))
    bands = usable.select("batch_id", "lat_low", "lat_high")
    binned, binned_rows = settle(
        bands.withColumn("bin", F.explode(_bins(F.col("lat_low"), F.col("lat_high"), width)))
    )

    def with_bin(df: DataFrame) -> DataFrame:
        return df.withColumn("bin", F.floor(F.col("lat") / width))

    edges = binned.agg(F.min("lat_low").alias("low"), F.max("lat_high").alias("high")).first()
    if edges["low"] is None:
        reachable = restaurants.limit(0)
    else:
        span = within_band(restaurants, (edges["low"], edges["high"]), lng)
        reachable = join_settled(
            with_bin(weighted_restaurants(span)),
            binned.select("bin").distinct(),
            ["bin"],
            ("id", "lat", "lng"),
            known_rows=binned_rows,
        ).drop("bin")
        # Counted, joined and looked through for hot keys: computed once.
        reachable, _ = settle(reachable)
    groups = rated_groups(reviews, reachable, min_rating, broadcast_bytes)
    if binned_rows > BROADCAST_ROWS:
        # The shuffle join looks at its input twice: for hot bins and to join.
        groups, _ = settle(groups)
    inside = F.col("lat").between(F.col("lat_low"), F.col("lat_high"))
    found = join_settled(
        with_bin(groups),
        binned,
        ["bin"],
        ("reviewer_id", "lng", "category"),
        condition=inside,
        known_rows=binned_rows,
    ).select("batch_id", *RESULT_COLUMNS)
    return found if limit_per_batch is None else first_per_batch(found, limit_per_batch)


# Up to this limit Spark itself cuts every partition before it ranks a batch.
_CUT_BY_SPARK = 999


def first_per_batch(
    found: DataFrame, limit: int, keys: Sequence[str] = GROUP_KEYS
) -> DataFrame:
    """The first ``limit`` rows of each batch in key order.

    For a small limit Spark cuts every partition down to ``limit`` rows per batch
    before the shuffle.  For a larger one the rows are dealt to ranges of batch and
    keys, ranked inside their range, and a range starts where those before it ended.
    No batch gathers in one task either way.
    """
    if limit <= _CUT_BY_SPARK:
        rank = F.row_number().over(Window.partitionBy("batch_id").orderBy(*keys))
        return found.withColumn("__rank", rank).filter(F.col("__rank") <= limit).drop("__rank")
    dealt = found.repartitionByRange("batch_id", *keys).withColumn("__range", F.spark_partition_id())
    dealt, _ = settle(dealt)
    counts = dealt.groupBy("batch_id", "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("batch_id").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "batch_id", "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    ).filter(F.col("__start") < limit)
    inside = F.row_number().over(Window.partitionBy("batch_id", "__range").orderBy(*keys))
    return (
        dealt.join(starts, ["batch_id", "__range"])
        .withColumn("__rank", inside + F.col("__start"))
        .filter(F.col("__rank") <= limit)
        .drop("__rank", "__range", "__start")
    )
