"""Where intermediate and temporary tables go, and how small results are settled."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session or its context names it.

    Only a session that runs in one process on this machine and names none gets a
    temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get(_CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="streamlens-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/streamlens/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> tuple[DataFrame, int]:
    """Compute ``df`` once into reliable storage; return it with its row count."""
    shared_folder(df.sparkSession)
    settled = df.checkpoint(eager=True)
    return settled, settled.count()
