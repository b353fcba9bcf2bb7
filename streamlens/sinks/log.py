"""A stored table whose batches are replaced and compacted while it is read.

Rows lie in folders that never change.  A log says which folder holds a batch; one entry is one
file, so it is there as a whole or not at all.  Readers take the log as it is when they start and
open what it names, so they see every batch once, whatever is written meanwhile.

An entry has one row per batch: how often the batch was written (``attempt``), how often it has
been compacted since (``generation``), and where it is.  The greatest of a batch counts.  So
entries may be read in any order, and may repeat: no lock is needed between a job that writes, a
compaction and a reader.  A batch that runs again while it is being compacted stays as it was
written last; what the compaction holds of it is passed over.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from streamlens.functions.schemas import flat_schema
from streamlens.sinks.batches import RUN_KEYS

_KEY_SCHEMA = flat_schema(run_id="string", batch_id="long")
_STATE = ("attempt", "generation", "folder", "rows")
ENTRY_SCHEMA = flat_schema(
    run_id="string", batch_id="long", attempt="long", generation="long", folder="string", rows="long"
)


@dataclass(frozen=True)
class Snapshot:
    """The log as it was at one moment."""

    entries: DataFrame

    def batches(self) -> DataFrame:
        """Where every batch is: ``run_id, batch_id, attempt, generation, folder, rows``."""
        newest = F.max(F.struct(*_STATE)).alias("__state")
        return self.entries.groupBy(*RUN_KEYS).agg(newest).select(*RUN_KEYS, "__state.*")

    def folders(self) -> DataFrame:
        """Folders in use: ``folder, rows, passed``; ``passed`` of their batches are elsewhere now."""
        held = self.entries.select(*RUN_KEYS, *_STATE).distinct()
        live = self.batches().select(*RUN_KEYS, F.col("folder").alias("now"))
        here = F.col("folder") == F.col("now")
        found = held.join(live, list(RUN_KEYS)).groupBy("folder").agg(
            F.sum(F.when(here, F.col("rows")).otherwise(0)).alias("rows"),
            F.count_if(~here).alias("passed"),
        )
        return found.filter("rows > 0")


@dataclass(frozen=True)
class LoggedFolder:
    """A table below ``path`` with one state per run and batch; ``schema`` is without ``RUN_KEYS``."""

    path: str
    schema: StructType
    run_id: str = "run"

    def snapshot(self, spark: SparkSession) -> Snapshot:
        """The entries that are there now; the files are listed once, here."""
        try:
            return Snapshot(spark.read.schema(ENTRY_SCHEMA).parquet(f"{self.path}/log/*"))
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            return Snapshot(spark.createDataFrame([], ENTRY_SCHEMA))

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Store a batch, or replace it; readers see the old rows until all new ones are there."""
        spark = df.sparkSession
        mine = (F.col("run_id") == self.run_id) & (F.col("batch_id") == int(batch_id))
        before = self.snapshot(spark).entries.filter(mine).agg(F.max("attempt")).first()[0]
        keys = (F.lit(self.run_id).alias("run_id"), F.lit(int(batch_id)).cast("long").alias("batch_id"))
        folder, rows = self._store(df.select(*self.schema.fieldNames(), *keys))
        entry = [(self.run_id, int(batch_id), (before or 0) + 1, 0, folder, rows)]
        self._commit(spark.createDataFrame(entry, ENTRY_SCHEMA))

    def read(self, spark: SparkSession) -> DataFrame:
        """Every batch of every run once, with ``RUN_KEYS``."""
        return self._open(spark, self.snapshot(spark))

    def compact(self, spark: SparkSession, small: int = 1_000_000, per_file: int = 4_000_000) -> int:
        """Put the batches of all folders with fewer than ``small`` rows into one; return how many folders.

        ``per_file`` rows are about one file.  Old folders stay, for readers that are under way.
        """
        snapshot = self.snapshot(spark)
        few = [r["folder"] for r in snapshot.folders().filter(F.col("rows") < small).collect()]
        if len(few) < 2:
            return 0
        moved = snapshot.batches().filter(F.col("folder").isin(few))
        total = moved.agg(F.sum("rows")).first()[0]
        rows = self._open(spark, snapshot, few).coalesce(max(1, -(-total // per_file)))
        folder, _ = self._store(rows.select(*self.schema.fieldNames(), *RUN_KEYS))
        entry = moved.withColumns(
            {"generation": F.col("generation") + 1, "folder": F.lit(folder)}
        )
        self._commit(entry)
        return len(few)

    def vacuum(self, spark: SparkSession, older_than: float) -> int:
        """Fold the log to one entry and delete what is out of use since ``older_than`` seconds.

        That must be longer than any reader or writer takes: they may still use what the log no
        longer names, or not yet.  Returns the number of deleted folders and entries.
        """
        names = {kind: self._listed(spark, kind, older_than) for kind in ("data", "log")}
        snapshot = self.snapshot(spark)
        live = snapshot.batches().select("folder").distinct()
        used = {f"folder={r['folder']}" for r in live.collect()}
        gone = [f"data/{name}" for name in names["data"] if name not in used]
        if names["log"]:
            # Also what is elsewhere now: readers must know to pass over it.
            self._commit(snapshot.entries.distinct().join(live, "folder", "left_semi"))
            gone += [f"log/{name}" for name in names["log"]]
        for name in gone:
            path, system = _hadoop(spark, f"{self.path}/{name}")
            system.delete(path, True)
        return len(gone)

    def _listed(self, spark: SparkSession, kind: str, older_than: float) -> list[str]:
        path, system = _hadoop(spark, f"{self.path}/{kind}")
        if not system.exists(path):
            return []
        before = (time.time() - older_than) * 1000
        found = system.listStatus(path)
        return [s.getPath().getName() for s in found if s.getModificationTime() <= before]

    def _store(self, rows: DataFrame) -> tuple[str, int]:
        name = uuid.uuid4().hex
        folder = f"{self.path}/data/folder={name}"
        rows.write.parquet(folder)
        return name, rows.sparkSession.read.schema(_KEY_SCHEMA).parquet(folder).count()

    def _commit(self, entry: DataFrame) -> None:
        """One file, which the writer moves into place when it is complete."""
        entry.select(*ENTRY_SCHEMA.fieldNames()).coalesce(1).write.parquet(
            f"{self.path}/log/{uuid.uuid4().hex}"
        )

    def _open(
        self, spark: SparkSession, snapshot: Snapshot, only: list[str] | None = None
    ) -> DataFrame:
        folders = [r for r in snapshot.folders().collect() if only is None or r["folder"] in only]
        full = StructType([*self.schema.fields, *_KEY_SCHEMA.fields])
        if not folders:
            return spark.createDataFrame([], full)
        paths = [f"{self.path}/data/folder={r['folder']}" for r in folders]
        with_folder = StructType([*full.fields, StructField("folder", StringType())])
        reader = spark.read.schema(with_folder).option("basePath", f"{self.path}/data")
        rows = reader.parquet(*paths)
        if any(r["passed"] for r in folders):
            live = snapshot.batches().select(*RUN_KEYS, "folder")
            rows = rows.join(live, [*RUN_KEYS, "folder"], "left_semi")
        return rows.select(*full.fieldNames())


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system, as Spark reaches it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
