"""How the test tables play messages, reviews and restaurants."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.functions.time import epoch_day, utc_instant, utc_wall_clock
from streamlens.operators.samples import parse_samples
from streamlens.operators.tokens import explode_tokens, message_values
from streamlens.sources.tables import parquet_table

# Fixed values of the mapping.
REG_PARAM = 0.0001
HALF_WIDTH = 0.5
MIN_RATING = 3.0
PART_LNG = (10.0, 40.0)
SIZE_LNG = (900.0, 950.0)


def _as_message(
    df: DataFrame, value: Column, topic: Column, partition: Column, offset: Column, ts: Column
) -> DataFrame:
    return df.select(
        offset.cast("string").alias("key"),
        value.alias("value"),
        topic.alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        ts.alias("timestamp"),
    )


def _pair(label: Column, feature: Column) -> Column:
    return F.concat(label.cast("string"), F.lit(","), feature.cast("string"))


def event_messages(events: DataFrame) -> DataFrame:
    """An event is a message of two readings: its value at its minute and at its second."""
    value, ts = F.col("value"), F.col("ts")
    readings = F.concat(
        _pair(value, F.minute(ts)), F.lit(" "), _pair(value, F.second(ts)), F.lit(" ")
    )
    return _as_message(
        events,
        readings,
        F.col("event_type"),
        F.pmod(F.col("user_id"), F.lit(4)),
        F.col("event_id"),
        utc_instant(ts),
    )


def noisy_event_messages(events: DataFrame) -> DataFrame:
    """Messages of good readings between words, bare numbers and unfinished pairs."""
    value, minute = F.col("value").cast("string"), F.minute("ts").cast("string")
    line = F.concat_ws(
        " ",
        F.concat_ws(",", value, minute),
        F.concat_ws(",", F.col("event_type"), minute),
        F.concat_ws(",", value, F.col("event_type")),
        value,
        F.lit(""),
        F.concat(value, F.lit(",")),
        F.concat_ws(",", F.concat(value, F.lit("d")), F.concat(F.lit("+"), minute), F.lit("x")),
        F.concat_ws(",", F.lit("inf"), minute),
        F.concat_ws(",", value, F.lit("NaN")),
        F.col("props"),
    )
    return _as_message(
        events,
        line,
        F.col("event_type"),
        F.pmod(F.col("user_id"), F.lit(4)),
        F.col("event_id"),
        utc_instant(F.col("ts")),
    )


def part_messages(part: DataFrame) -> DataFrame:
    """A part is a message of one reading: its price at its size."""
    return _as_message(
        part,
        _pair(F.col("p_retailprice"), F.col("p_size")),
        F.lit("part"),
        F.lit(0),
        F.col("p_partkey"),
        F.lit(None).cast("timestamp"),
    )


def text_messages(df: DataFrame, topic: str, offset: str, value: Column) -> DataFrame:
    """Stored texts as messages."""
    return _as_message(
        df, value, F.lit(topic), F.lit(0), F.col(offset), F.lit(None).cast("timestamp")
    )


def samples_of(messages: DataFrame, on_malformed: str = "fail") -> DataFrame:
    """Positions, labels and features of messages."""
    tokens = explode_tokens(message_values(messages))
    return parse_samples(tokens, on_malformed)[0]


def event_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Readings of the events, with the day of the event as ``batch_id``."""
    events = parquet_table(spark, folder, "events")
    parsed = samples_of(event_messages(events))
    return parsed.withColumn("batch_id", epoch_day(utc_wall_clock(F.col("timestamp"))))


def part_samples(spark: SparkSession, folder: str) -> DataFrame:
    return samples_of(part_messages(parquet_table(spark, folder, "part")))


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as reviews: suppliers rate parts by quantity."""
    return parquet_table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("reviewer_id"),
        F.col("l_partkey").alias("restaurant_id"),
        F.col("l_quantity").alias("rating"),
    )


def nan_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """The reviews with NaN for the rating of the first line of every order."""
    rating = F.when(F.col("l_linenumber") == 1, float("nan")).otherwise(F.col("l_quantity"))
    return parquet_table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("reviewer_id"),
        F.col("l_partkey").alias("restaurant_id"),
        rating.alias("rating"),
    )


def restaurants(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as restaurants: price is the latitude, size the longitude."""
    return parquet_table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("lat"),
        F.col("p_size").cast("double").alias("lng"),
    )


def sized_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as restaurants the other way round: size is the latitude.

    Event predictions lie near 50, as the largest sizes do.
    """
    return parquet_table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("double").alias("lat"),
        F.col("p_retailprice").alias("lng"),
    )


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals: sums of doubles differ in the last digits with their order."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


Query = Callable[[SparkSession, str], DataFrame]
