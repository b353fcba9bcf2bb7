"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamlens.operators.lookup import GROUP_KEYS

REVIEW_COLUMNS = ("reviewer_id", "restaurant_id", "rating")
RESTAURANT_COLUMNS = ("id", "category", "lat", "lng")


def orc_table(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """An ORC folder, also registered as a temporary view if a name is given."""
    df = spark.read.orc(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog, by its database-qualified name, as it is now.

    A session keeps the list of a table's files; without the refresh it would not see
    what others have added since it opened the table first.
    """
    spark.catalog.refreshTable(name)
    return spark.table(name)


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``<folder>/<name>.parquet``, a file or a folder of files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


# One statement with the meaning of ``operators.lookup``: repeated restaurant records
# weigh as often as they occur, null and NaN ratings count for nothing.
NEARBY_SQL = f"""
WITH near AS (
  SELECT id AS restaurant_id, category, lat, lng, count(*) AS copies
  FROM IDENTIFIER(:restaurants)
  WHERE id IS NOT NULL AND lat >= :lat_low AND lat <= :lat_high
    AND lng >= :lng_low AND lng <= :lng_high
  GROUP BY ALL
), rated AS (
  SELECT restaurant_id, reviewer_id, sum(rating) AS total, count(*) AS times
  FROM IDENTIFIER(:reviews)
  WHERE rating > :min_rating AND NOT isnan(rating)
  GROUP BY ALL
)
SELECT {", ".join(GROUP_KEYS)}, sum(total * copies) / sum(times * copies) AS avg_rating
FROM rated JOIN near USING (restaurant_id)
GROUP BY {", ".join(GROUP_KEYS)}
"""


def nearby_by_sql(
    spark: SparkSession,
    lat: tuple[float, float],
    lng: tuple[float, float] = (13.3, 13.4),
    min_rating: float = 3.0,
    reviews: str = "restaurants.reviews",
    restaurants: str = "restaurants.restaurants",
) -> DataFrame:
    """The lookup as a SQL statement over catalog tables, with typed parameters."""
    return spark.sql(
        NEARBY_SQL,
        args={
            "reviews": reviews,
            "restaurants": restaurants,
            "min_rating": float(min_rating),
            "lat_low": float(lat[0]),
            "lat_high": float(lat[1]),
            "lng_low": float(lng[0]),
            "lng_high": float(lng[1]),
        },
    )
