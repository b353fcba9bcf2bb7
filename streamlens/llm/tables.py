"""Reading the tables, and results kept in shared storage between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamlens.sources.scratch import fresh_folder


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so it is computed once.

    It survives lost executors, and its lineage ends there.
    """
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
