"""Reviews and restaurants stored so that their join moves nothing.

Both tables are bucketed on the restaurant and on a part of it, in equally many buckets.  A part
holds some of the reviewers, so a restaurant with very many reviews is spread over ``PARTS``
buckets; restaurants, of which there are few, are stored once per part.  A lookup joins bucket by
bucket where the files are.  Storing is paid once, every batch afterwards shuffles group sums only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.operators.lookup import GROUP_KEYS, rated_above, weighted_restaurants, within_band
from streamlens.sources.tables import catalog_table

PARTS = 8
BUCKET_KEYS = ("restaurant_id", "part")


def _store(rows: DataFrame, name: str, buckets: int) -> None:
    # Dealt like the buckets, so every bucket is written as one file.
    dealt = rows.repartition(buckets, *BUCKET_KEYS)
    dealt.write.format("parquet").bucketBy(buckets, *BUCKET_KEYS).sortBy(*BUCKET_KEYS).saveAsTable(name)


def store_reviews(reviews: DataFrame, name: str, buckets: int) -> None:
    """Write the catalog table ``name``; reviews without a restaurant are in no join and are left out.

    Restaurant ids are stored as ``long``, in both tables.
    """
    part = F.pmod(F.xxhash64("reviewer_id"), F.lit(PARTS)).cast("int")
    rows = reviews.filter("restaurant_id IS NOT NULL").select(
        F.col("restaurant_id").cast("long").alias("restaurant_id"),
        part.alias("part"),
        "reviewer_id",
        "rating",
    )
    _store(rows, name, buckets)


def store_restaurants(restaurants: DataFrame, name: str, buckets: int) -> None:
    """Write the catalog table ``name``: distinct records with their copies, once per part."""
    records = weighted_restaurants(restaurants).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    )
    rows = records.select(
        F.col("id").cast("long").alias("restaurant_id"), "part", "category", "lat", "lng", "copies"
    )
    _store(rows, name, buckets)


def colocated_matches(reviews: DataFrame, restaurants: DataFrame, min_rating: float = 3.0) -> DataFrame:
    """Rated reviews with their restaurant records, without an exchange of either table.

    A bucket of restaurants is hashed, the reviews of the bucket pass by it.  ``total`` is the
    rating times the copies of the record, ``times`` the copies.
    """
    rated = rated_above(reviews, min_rating).select(*BUCKET_KEYS, "reviewer_id", "rating")
    matched = rated.join(restaurants.hint("shuffle_hash"), list(BUCKET_KEYS))
    return matched.select(
        *GROUP_KEYS,
        (F.col("rating") * F.col("copies")).alias("total"),
        F.col("copies").alias("times"),
    )


def colocated_groups(
    spark: SparkSession,
    reviews: str,
    restaurants: str,
    lat: tuple[float, float] | None = None,
    lng: tuple[float, float] | None = None,
    min_rating: float = 3.0,
) -> DataFrame:
    """Average rating per reviewer and restaurant record, from two stored tables, inside a band."""
    records = catalog_table(spark, restaurants)
    if lat is not None and lng is not None:
        records = within_band(records, lat, lng)
    matched = colocated_matches(catalog_table(spark, reviews), records, min_rating)
    return matched.groupBy(*GROUP_KEYS).agg((F.sum("total") / F.sum("times")).alias("avg_rating"))
