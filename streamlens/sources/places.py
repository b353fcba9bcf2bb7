"""Restaurants stored by place, so that a narrow band opens few of their files.

Rows are sorted along a Z-order curve of latitude and longitude and dealt to files by ranges of it.
What lies together is stored together in both directions.  A manifest beside the files has the box
of each; a band reads the files whose boxes it meets, and the bounds go to their scan as well.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamlens.functions.schemas import flat_schema
from streamlens.operators.lookup import within_band
from streamlens.sinks.log import LoggedFolder

BITS = 16
MANIFEST_SCHEMA = flat_schema(
    file="string", lat_low="double", lat_high="double", lng_low="double", lng_high="double", n="long"
)


def z_value(x: Column, y: Column) -> Column:
    """The bits of two whole numbers of ``BITS`` bits, one of each in turn."""
    found = F.lit(0).cast("long")
    for bit in range(BITS):
        for at, number in ((2 * bit, x), (2 * bit + 1, y)):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("long"))
            found = found.bitwiseOR(F.shiftleft(one, at))
    return found


def _cell(value: Column, low: float | None, high: float | None) -> Column:
    """Where a value lies between the ends, in 2 ** BITS steps; what has no place comes first."""
    if low is None or not low < high:
        return F.lit(0).cast("long")
    step = F.floor((value - F.lit(low)) / F.lit((high - low)) * F.lit(float(2**BITS - 1)))
    return F.when(F.isnan(value) | value.isNull(), 0).otherwise(
        F.least(F.greatest(step, F.lit(0)), F.lit(2**BITS - 1))
    ).cast("long")


def store_by_place(restaurants: DataFrame, path: str, files: int) -> None:
    """Write ORC files below ``path`` and their manifest; a table that is there is replaced.

    Readers follow the manifest, so they see the old files or the new ones.  Rows without a place
    are stored too, and are in no band.
    """
    spark = restaurants.sparkSession
    usable = restaurants.filter(F.abs("lat") < float("inf")).filter(F.abs("lng") < float("inf"))
    ends = usable.agg(
        *(f(c).cast("double").alias(f"{c}_{n}") for c in ("lat", "lng") for n, f in (("low", F.min), ("high", F.max)))
    ).first()
    place = z_value(*(_cell(F.col(c), ends[f"{c}_low"], ends[f"{c}_high"]) for c in ("lat", "lng")))
    ordered = restaurants.withColumn("__z", place).repartitionByRange(files, "__z", "id")
    folder = f"{path}/rows-{uuid.uuid4().hex}"
    ordered.sortWithinPartitions("__z").drop("__z").write.orc(folder)
    boxes = spark.read.orc(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("lat").alias("lat_low"),
        F.max("lat").alias("lat_high"),
        F.min("lng").alias("lng_low"),
        F.max("lng").alias("lng_high"),
        F.count(F.lit(1)).alias("n"),
    )
    LoggedFolder(f"{path}/manifest", MANIFEST_SCHEMA).write(boxes, 0)


def files_in_band(spark: SparkSession, path: str, lat: tuple, lng: tuple) -> list[str]:
    """The files whose boxes meet the band; NaN counts as beyond any number."""
    manifest = LoggedFolder(f"{path}/manifest", MANIFEST_SCHEMA).read(spark)
    met = (
        (F.col("lat_low") <= lat[1]) & (F.col("lat_high") >= lat[0])
        & (F.col("lng_low") <= lng[1]) & (F.col("lng_high") >= lng[0])
    )
    return sorted(r["file"] for r in manifest.filter(met).select("file").collect())


def restaurants_in_band(
    spark: SparkSession, path: str, schema: StructType, lat: tuple, lng: tuple
) -> DataFrame:
    """The stored restaurants inside both bands, from the files that can hold any."""
    files = files_in_band(spark, path, lat, lng)
    if not files:
        return spark.createDataFrame([], schema)
    return within_band(spark.read.schema(schema).orc(files), lat, lng)
