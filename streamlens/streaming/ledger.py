"""What a run has read of its topics, as intervals of offsets, and what it missed or read twice.

Every batch notes its intervals per topic and partition.  Consecutive offsets make one interval,
so a note stays small however many messages a batch has.  Offsets are folded in blocks first: a
block is bounded, and only the ends of its intervals go on, so no task holds a whole partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamlens.functions.schemas import flat_schema
from streamlens.sinks.log import LoggedFolder

SOURCE_KEYS = ("topic", "partition")
LEDGER_SCHEMA = flat_schema(topic="string", partition="integer", first="long", last="long", messages="long")
BLOCK = 4096


def _islands(intervals: DataFrame, by: list[str]) -> DataFrame:
    """Intervals that touch or overlap as one; ``messages`` add up."""
    ordered = Window.partitionBy(*by).orderBy("first", "last")
    before = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (F.col("first") > before + 1), 1).otherwise(0)
    numbered = intervals.withColumn("__new", starts).withColumn(
        "__island", F.sum("__new").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy(*by, "__island").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("messages").alias("messages")
    ).drop("__island")


def _block_intervals(counted: Column) -> Column:
    """Sorted ``struct(offset, n)`` of a block as an array of ``struct(first, last, messages)``."""
    empty = F.array().cast("array<struct<first:bigint,last:bigint,messages:bigint>>")

    def take(found: Column, one: Column) -> Column:
        last = F.try_element_at(found, F.lit(-1))
        joins = F.coalesce(last["last"] + 1 == one["offset"], F.lit(False))
        longer = F.struct(
            last["first"].alias("first"),
            one["offset"].alias("last"),
            (last["messages"] + one["n"]).alias("messages"),
        )
        alone = F.struct(
            one["offset"].alias("first"), one["offset"].alias("last"), one["n"].alias("messages")
        )
        shorter = F.slice(found, F.lit(1), F.size(found) - 1)
        return F.when(joins, F.array_append(shorter, longer)).otherwise(F.array_append(found, alone))

    return F.aggregate(counted, empty, take)


def offset_intervals(messages: DataFrame) -> DataFrame:
    """``topic, partition, first, last, messages``: intervals of offsets without a hole.

    A message read twice counts twice in ``messages``.  Messages without an offset are left out.
    """
    placed = messages.filter("offset IS NOT NULL").select(
        *SOURCE_KEYS, "offset", F.floor(F.col("offset") / BLOCK).alias("block")
    )
    # Repeated offsets are combined before the shuffle; a block then has BLOCK of them at most.
    counted = placed.groupBy(*SOURCE_KEYS, "block", "offset").agg(F.count(F.lit(1)).alias("n"))
    blocks = counted.groupBy(*SOURCE_KEYS, "block").agg(
        F.sort_array(F.collect_list(F.struct("offset", "n"))).alias("counted")
    )
    found = blocks.select(*SOURCE_KEYS, F.inline(_block_intervals(F.col("counted"))))
    return _islands(found, list(SOURCE_KEYS)).select(*LEDGER_SCHEMA.fieldNames())


@dataclass(frozen=True)
class OffsetLedger:
    """The intervals of every batch, by run and batch."""

    sink: LoggedFolder

    @classmethod
    def below(cls, path: str, run_id: str = "run") -> "OffsetLedger":
        return cls(LoggedFolder(path, LEDGER_SCHEMA, run_id))

    def note(self, messages: DataFrame, batch_id: int) -> None:
        """Write down what a batch has read; a batch that runs again replaces its note."""
        self.sink.write(offset_intervals(messages), batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.sink.read(spark)


def findings(ledger: DataFrame) -> DataFrame:
    """Gaps and overlaps of every run, as ``run_id, topic, partition, kind, first, last``.

    A ``gap`` lies between intervals and belongs to none.  An ``overlap`` belongs to two intervals
    or more: what is in three of them shows once.
    """
    by = ["run_id", *SOURCE_KEYS]
    ordered = Window.partitionBy(*by).orderBy("first", "last")
    before = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = ledger.select(*by, "first", "last", "messages").withColumn("__before", before)
    gaps = marked.filter(F.col("first") > F.col("__before") + 1).select(
        *by,
        F.lit("gap").alias("kind"),
        (F.col("__before") + 1).alias("first"),
        (F.col("first") - 1).alias("last"),
    )
    twice = marked.filter(F.col("first") <= F.col("__before")).select(
        *by, "first", F.least("last", "__before").alias("last"), "messages"
    )
    overlaps = _islands(twice, by).select(*by, F.lit("overlap").alias("kind"), "first", "last")
    return gaps.unionByName(overlaps)
