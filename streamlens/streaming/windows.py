"""Fits per tumbling event-time window, batch or streaming."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlens.operators.regression import MODEL_COLUMNS, ridge_fit
from streamlens.sinks.batches import RUN_KEYS, FolderSink


def windowed_fit(
    samples: DataFrame,
    ts: str,
    width: str,
    reg_param: float = 0.0001,
    watermark: str | None = None,
) -> DataFrame:
    """One model per window of ``width``; the state per window is a few numbers.

    On a stream give a ``watermark``: later rows are dropped and closed windows
    leave the state.  In append mode a window is only emitted once it is closed,
    so the last open one is missing; update mode emits it as it grows.
    """
    timed = samples.withWatermark(ts, watermark) if watermark else samples
    fitted = ridge_fit(timed, reg_param, by=[F.window(ts, width).alias("window")])
    return fitted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *MODEL_COLUMNS,
    )


def start_windowed_fit(
    fitted: DataFrame, sink: FolderSink, checkpoint: str, **trigger
) -> StreamingQuery:
    """Write every changed window of every micro-batch to the sink."""
    return (
        fitted.writeStream.outputMode("update")
        .foreachBatch(sink.write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def latest(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last written version of each row of an update stream."""
    values = [c for c in batches.columns if c not in (*keys, *RUN_KEYS)]
    kept = batches.groupBy(*keys).agg(
        F.max_by(F.struct(*values), "batch_id").alias("__row")
    )
    return kept.select(*keys, "__row.*")
