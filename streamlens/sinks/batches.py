"""Batch output that may be written twice and is stored once.

Batches are numbered from 0 for every checkpoint, so outputs are kept by run and
batch: a run is what one checkpoint has seen, however often it was restarted.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

RUN_KEYS = ("run_id", "batch_id")


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint stands for, made once and kept beside it."""
    path = f"{checkpoint.rstrip('/')}-run"
    try:
        known = spark.read.schema("run_id string").parquet(path).first()
    except AnalysisException:
        known = None
    if known:
        return known["run_id"]
    name = uuid.uuid4().hex
    one = spark.range(0, 1, 1, 1).select(F.lit(name).alias("run_id"))
    one.write.mode("overwrite").parquet(path)
    return name


@dataclass(frozen=True)
class FolderSink:
    """One folder per run and batch below ``path``.

    A batch that runs again replaces its own folder, also when it has become
    empty.  ``schema`` is that of the rows without ``RUN_KEYS``.
    """

    path: str
    schema: StructType
    run_id: str = "run"

    def write(self, df: DataFrame, batch_id: int) -> None:
        ordered = df.select(*self.schema.fieldNames())
        folder = f"{self.path}/run_id={self.run_id}/batch_id={batch_id}"
        ordered.write.mode("overwrite").parquet(folder)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of all runs and batches."""
        keys = [StructField("run_id", StringType()), StructField("batch_id", LongType())]
        return spark.read.schema(StructType([*self.schema.fields, *keys])).parquet(self.path)


@dataclass(frozen=True)
class TableSink:
    """A catalog table.

    ``replace_batch`` keeps one partition per run and batch and drops it before
    writing; ``append`` adds rows blindly, so a repeated batch shows twice.  A table
    that is there and is not partitioned so can only be appended to, by the names of
    its own columns.
    """

    name: str
    semantics: str = "replace_batch"
    run_id: str = "run"

    def write(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        there = spark.catalog.tableExists(self.name)
        with_keys = df.withColumns(
            {"run_id": F.lit(self.run_id), "batch_id": F.lit(int(batch_id)).cast("long")}
        )
        if there:
            columns = spark.catalog.listColumns(self.name)
            parted = {c.name for c in columns if c.isPartition}
            if self.semantics == "append" or not parted.issuperset(RUN_KEYS):
                with_keys.select(*(c.name for c in columns)).write.insertInto(self.name)
                return
            spark.sql(
                f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION"
                f" (run_id = '{self.run_id}', batch_id = {int(batch_id)})"
            )
        elif self.semantics == "append":
            df.write.mode("append").saveAsTable(self.name)
            return
        with_keys.write.mode("append").partitionBy(*RUN_KEYS).saveAsTable(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)
