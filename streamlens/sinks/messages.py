"""Publishing one text record per batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.config import JobConfig
from streamlens.functions.schemas import flat_schema
from streamlens.sinks.batches import FolderSink

PUBLISHED_SCHEMA = flat_schema(value="string")


def kafka_write_options(cfg: JobConfig) -> dict[str, str]:
    return {"kafka.bootstrap.servers": cfg.brokers, "topic": cfg.output_topic}


@dataclass(frozen=True)
class KafkaPublisher:
    """Sends the records, without a key; the write returns once they are acknowledged."""

    cfg: JobConfig

    def write(self, values: DataFrame, batch_id: int) -> None:
        self._save(values.select("value"))

    def send(self, records: DataFrame) -> None:
        """The records with their keys."""
        self._save(records.select("key", "value"))

    def has(self, spark: SparkSession, key: str) -> bool:
        """Whether the topic holds a record of this key; reads the topic as far as it is kept."""
        options = {
            "kafka.bootstrap.servers": self.cfg.brokers,
            "subscribe": self.cfg.output_topic,
            "startingOffsets": "earliest",
        }
        records = spark.read.format("kafka").options(**options).load()
        return not records.filter(F.col("key").cast("string") == key).isEmpty()

    def _save(self, records: DataFrame) -> None:
        records.write.format("kafka").options(**kafka_write_options(self.cfg)).save()


@dataclass(frozen=True)
class FolderPublisher:
    """Keeps the records in a folder, for replays."""

    path: str
    run_id: str = "run"

    def write(self, values: DataFrame, batch_id: int) -> None:
        FolderSink(self.path, PUBLISHED_SCHEMA, self.run_id).write(values, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return FolderSink(self.path, PUBLISHED_SCHEMA).read(spark)
