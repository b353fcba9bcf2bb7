"""A stream that keeps its late rows: they are told apart, stored, and counted in.

Spark's watermark drops rows that come too late.  Here every batch notes the latest time it has
seen, and what lies further than ``delay`` behind all batches before it is late.  Late rows go to
a table of their own, and their moments into the store beside the others, so fits of closed
windows are brought up to date by merging a few numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from streamlens.functions.schemas import flat_schema
from streamlens.operators.moment_store import MomentStore
from streamlens.sinks.log import LoggedFolder

MARK_SCHEMA = flat_schema(latest="timestamp")


@dataclass(frozen=True)
class LateKeeper:
    """What happens to a micro-batch of samples with their times in ``ts``.

    The watermark of a batch comes from the batches of its run before it, so a batch that runs
    again judges its rows as before.  Rows without a time are neither late nor in a slot.
    """

    store: MomentStore
    late: LoggedFolder
    marks: LoggedFolder
    ts: str
    delay: str

    @classmethod
    def below(
        cls, path: str, schema: StructType, ts: str, delay: str, slot: str = "1 day", run_id: str = "run"
    ) -> "LateKeeper":
        """Stores below ``path``; ``schema`` is that of the samples."""
        return cls(
            MomentStore.below(f"{path}/moments", slot, run_id),
            LoggedFolder(f"{path}/late", schema, run_id),
            LoggedFolder(f"{path}/marks", MARK_SCHEMA, run_id),
            ts,
            delay,
        )

    def _is_late(self, spark: SparkSession, batch_id: int) -> Column:
        run = self.marks.run_id
        before = self.marks.read(spark).filter(
            (F.col("run_id") == run) & (F.col("batch_id") < int(batch_id))
        )
        # Seconds, as a driver's time zone has no say in them.
        behind = F.max("latest") - F.expr(f"INTERVAL {self.delay}")
        mark = before.agg(F.unix_micros(behind).alias("mark")).first()["mark"]
        if mark is None:
            return F.lit(False)
        return F.coalesce(F.unix_micros(self.ts) < F.lit(mark), F.lit(False))

    def __call__(self, samples: DataFrame, batch_id: int) -> None:
        spark = samples.sparkSession
        samples = samples.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            late = self._is_late(spark, batch_id)
            self.late.write(samples.filter(late), batch_id)
            self.store.add(samples, self.ts, batch_id, late)
            # Last: a batch counts for the next ones once its rows are stored.
            self.marks.write(samples.agg(F.max(self.ts).alias("latest")), batch_id)
        finally:
            samples.unpersist()


def start_late_keeper(
    samples: DataFrame, keeper: LateKeeper, checkpoint: str, **trigger
) -> StreamingQuery:
    """Start the stream; a restart with the same checkpoint resumes it."""
    return (
        samples.writeStream.foreachBatch(keeper)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
