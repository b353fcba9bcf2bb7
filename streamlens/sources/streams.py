"""Message streams: Kafka, or a replay of files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamlens.config import JobConfig
from streamlens.functions.schemas import flat_schema

MESSAGE_SCHEMA = flat_schema(
    key="string",
    value="string",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
)


def kafka_read_options(cfg: JobConfig) -> dict[str, str]:
    """Reader options; offsets only apply to a query without a checkpoint."""
    options = {
        "kafka.bootstrap.servers": cfg.brokers,
        "subscribe": ",".join(cfg.topic_list),
        "startingOffsets": cfg.starting_offsets,
    }
    if cfg.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    return options


def kafka_source(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """The topics as a streaming frame of messages."""
    raw = spark.readStream.format("kafka").options(**kafka_read_options(cfg)).load()
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def replay_source(
    spark: SparkSession,
    path: str,
    schema: StructType = MESSAGE_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files as a stream.

    Without ``max_files_per_trigger`` an ``availableNow`` run takes all files
    as one micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
