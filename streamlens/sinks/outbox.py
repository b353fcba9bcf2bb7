"""Publishing once: what is to be sent is written down before, and that it was sent after.

A batch runs again if a job dies before its checkpoint knows of it.  What was sent by then is not
sent again, and what was written down to be sent is sent as it was.  Between sending and noting
it, a job may die too; then the target is asked whether it has the record, by its key.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.functions.schemas import flat_schema
from streamlens.sinks.log import LoggedFolder

RECORD_SCHEMA = flat_schema(key="string", value="string")
OUTBOX_SCHEMA = flat_schema(key="string", value="string", sent="boolean")


class Target(Protocol):
    """Where records go; each has a key that tells whether it is there."""

    def send(self, records: DataFrame) -> None: ...

    def has(self, spark: SparkSession, key: str) -> bool: ...


@dataclass(frozen=True)
class TopicFolder:
    """A folder that every sending adds to, as to a topic."""

    path: str

    def send(self, records: DataFrame) -> None:
        records.select("key", "value").coalesce(1).write.mode("append").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(RECORD_SCHEMA).parquet(self.path)

    def has(self, spark: SparkSession, key: str) -> bool:
        try:
            return not self.read(spark).filter(F.col("key") == key).isEmpty()
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            return False


@dataclass(frozen=True)
class PublishOnce:
    """A publisher of one record per run and batch; ``outbox`` keeps what was sent.

    The key of a record is its run and batch.  A batch without a record publishes nothing.
    """

    target: Target
    outbox: LoggedFolder

    @classmethod
    def below(cls, path: str, target: Target, run_id: str = "run") -> "PublishOnce":
        return cls(target, LoggedFolder(path, OUTBOX_SCHEMA, run_id))

    def write(self, values: DataFrame, batch_id: int) -> None:
        spark, run_id = values.sparkSession, self.outbox.run_id
        key = f"{run_id}/{int(batch_id)}"
        mine = (F.col("run_id") == run_id) & (F.col("batch_id") == int(batch_id))
        noted = self.outbox.read(spark).filter(mine).select("value", "sent").first()
        if noted is not None and noted["sent"]:
            return
        if noted is None:
            value = values.select("value").first()
            if value is None:
                return
            self._note(spark, batch_id, key, value["value"], False)
            known = False
        else:
            value, known = noted, self.target.has(spark, key)
        if not known:
            self.target.send(spark.createDataFrame([(key, value["value"])], RECORD_SCHEMA))
        self._note(spark, batch_id, key, value["value"], True)

    def _note(self, spark: SparkSession, batch_id: int, key: str, value: str, sent: bool) -> None:
        self.outbox.write(spark.createDataFrame([(key, value, sent)], OUTBOX_SCHEMA), batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """What was written down, sent or not, with ``RUN_KEYS``."""
        return self.outbox.read(spark)
