"""Fits of any range of batches or times from stored moments, without the samples.

A stored row is what one batch has of one slot of time.  Rows add up, so a fit over any batches
and any whole number of slots reads some numbers per batch and slot, however many samples they
stand for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.functions import moments as mo
from streamlens.functions.schemas import flat_schema
from streamlens.operators.regression import MODEL_COLUMNS, ridge_columns
from streamlens.operators.samples import finite_samples
from streamlens.sinks.log import LoggedFolder

STORE_SCHEMA = flat_schema(
    slot="timestamp",
    late="boolean",
    n="long",
    mx="double",
    my="double",
    sxx="double",
    syy="double",
    sxy="double",
)


def slot_moments(samples: DataFrame, ts: str, slot: str, late: Column | None = None) -> DataFrame:
    """Rows to store: the moments of ``samples`` per slot of time, late ones apart."""
    marked = finite_samples(samples).select(
        F.window(ts, slot)["start"].alias("slot"),
        (F.lit(False) if late is None else late).alias("late"),
        "feature",
        "label",
    )
    return marked.groupBy("slot", "late").agg(
        *mo.moment_aggregates(F.col("feature"), F.col("label"))
    )


@dataclass(frozen=True)
class MomentStore:
    """Moments by run, batch and slot of time, kept in a logged folder."""

    sink: LoggedFolder
    slot: str = "1 day"

    @classmethod
    def below(cls, path: str, slot: str = "1 day", run_id: str = "run") -> "MomentStore":
        return cls(LoggedFolder(path, STORE_SCHEMA, run_id), slot)

    def add(self, samples: DataFrame, ts: str, batch_id: int, late: Column | None = None) -> None:
        """Store the samples of a batch; a batch that runs again replaces its rows."""
        self.sink.write(slot_moments(samples, ts, self.slot, late), batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.sink.read(spark)


def stored_fit(
    stored: DataFrame, reg_param: float = 0.0001, by: Sequence[str] = ()
) -> DataFrame:
    """One model, or one per ``by``, of all samples behind the stored rows."""
    fitted = ridge_columns(mo.merge_moments(stored, by), reg_param)
    return fitted.select(*by, *MODEL_COLUMNS)


def sliding_fit(
    stored: DataFrame, width: str, slide: str, reg_param: float = 0.0001
) -> DataFrame:
    """A model per sliding window; ``width`` and ``slide`` are whole numbers of slots."""
    windows = stored.withColumn("window", F.window("slot", width, slide))
    spread = windows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *mo.MOMENTS
    )
    return stored_fit(spread, reg_param, ("window_start", "window_end"))
