"""Run the Kafka job: the eight positional settings, then a shared output folder."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from streamlens.config import JobConfig
from streamlens.sources.scratch import shared_folder
from streamlens.streaming.job import run_kafka_job


def main(argv: list[str]) -> None:
    try:
        cfg = JobConfig.from_args(argv)
    except ValueError as problem:
        raise SystemExit(str(problem))
    spark = SparkSession.builder.appName("streamlens").enableHiveSupport().getOrCreate()
    base = argv[8] if len(argv) > 8 else f"{shared_folder(spark)}/streamlens/job"
    run_kafka_job(spark, cfg, base).awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
