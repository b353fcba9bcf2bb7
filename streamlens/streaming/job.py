"""The streaming job: fit, predict, look up and publish per micro-batch."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from streamlens.config import JobConfig
from streamlens.functions import moments as mo
from streamlens.functions.schemas import flat_schema
from streamlens.functions.text import is_finite, pair_text
from streamlens.operators.lookup import nearby_rated
from streamlens.operators.regression import ridge_columns, sgd_columns
from streamlens.operators.samples import malformed, parse_tokens, well_formed
from streamlens.operators.stats import split_part
from streamlens.operators.tokens import (
    MESSAGE_POSITION,
    TOKEN_POSITION,
    explode_tokens,
    message_values,
    preview_tokens,
)
from streamlens.sinks.batches import FolderSink, TableSink, run_name
from streamlens.sinks.log import LoggedFolder
from streamlens.sinks.messages import FolderPublisher, KafkaPublisher
from streamlens.sinks.outbox import PublishOnce, Target
from streamlens.sources.streams import kafka_source
from streamlens.sources.tables import catalog_table, orc_table

_POSITION = {"topic": "string", "partition": "integer", "offset": "long", "pos": "integer"}
MODEL_SCHEMA = flat_schema(
    n="long",
    weight="double",
    intercept="double",
    initial_loss="double",
    final_loss="double",
    tokens="long",
    malformed="long",
)
PREDICTION_SCHEMA = flat_schema(**_POSITION, prediction="double", label="double")
RESULT_SCHEMA = flat_schema(
    reviewer_id="string", category="string", lat="double", lng="double", avg_rating="double"
)
STATISTICS_SCHEMA = flat_schema(
    n="long",
    mean_label="double",
    mean_feature="double",
    deviation="double",
    correlation="double",
    mse="double",
    rmse="double",
    r2="double",
    test_n="long",
    test_mse="double",
    test_rmse="double",
    test_r2="double",
)
QUARANTINE_SCHEMA = flat_schema(**_POSITION, token="string", verdict="string")


class MalformedBatch(ValueError):
    """A batch holds tokens that are no samples and the policy is to fail."""


@dataclass(frozen=True)
class Outputs:
    """Where each kind of output goes."""

    models: FolderSink
    predictions: FolderSink
    results: FolderSink | TableSink | LoggedFolder
    quarantine: FolderSink
    published: FolderPublisher | KafkaPublisher | PublishOnce
    statistics: FolderSink | None = None

    @classmethod
    def in_folder(
        cls,
        base: str,
        results: TableSink | LoggedFolder | None = None,
        published: KafkaPublisher | PublishOnce | None = None,
        run_id: str = "run",
    ) -> "Outputs":
        """Folders below ``base``; ``run_id`` tells runs with checkpoints of their own apart."""
        return cls(
            models=FolderSink(f"{base}/models", MODEL_SCHEMA, run_id),
            predictions=FolderSink(f"{base}/predictions", PREDICTION_SCHEMA, run_id),
            results=results or FolderSink(f"{base}/results", RESULT_SCHEMA, run_id),
            quarantine=FolderSink(f"{base}/quarantine", QUARANTINE_SCHEMA, run_id),
            published=published or FolderPublisher(f"{base}/published", run_id),
            statistics=FolderSink(f"{base}/statistics", STATISTICS_SCHEMA, run_id),
        )


def parsed_stream(messages: DataFrame) -> DataFrame:
    """Messages to parsed tokens; row by row, so it runs on the stream itself."""
    tokens = explode_tokens(message_values(messages).drop("timestamp"))
    return parse_tokens(tokens.select(*TOKEN_POSITION, "token"))


# So many messages are worth a task of their own.
DEAL_ROWS = 50_000


def dealt(messages: DataFrame, rows: int = DEAL_ROWS) -> DataFrame:
    """The messages of one batch, dealt out by a hash to a task per ``rows`` of them.

    A file of one row group is read by one task, and what follows without a shuffle stays
    in it.  A batch of up to ``rows`` is left as it is, with the order its sums are taken in.
    """
    tasks = -(-messages.count() // rows)
    return messages.repartition(tasks, *MESSAGE_POSITION, "value") if tasks > 1 else messages


_MOMENTS = ("n", "mx", "my", "sxx", "syy", "sxy")


def batch_report(parsed: DataFrame, cfg: JobConfig) -> Row:
    """All the driver needs of a batch, as one row from one pass.

    The fit is algebra over the moments of the samples that are not held out, and so is
    scaling: ``deviation`` is what features are divided by (1 unless they are scaled).
    """
    usable = (
        (F.col("verdict") == "ok") & is_finite(F.col("label")) & is_finite(F.col("feature"))
    )
    part = F.lit("train")
    if cfg.holdout:
        part = split_part(F.concat_ws("/", *TOKEN_POSITION), 1 - cfg.holdout)
    pairs = parsed.select(
        *TOKEN_POSITION, "verdict", "label", "feature", F.when(usable, part).alias("part")
    )

    def moments(side: str, name: str) -> list[Column]:
        label, feature = (F.when(F.col("part") == side, F.col(c)) for c in ("label", "feature"))
        _, *found = mo.moment_aggregates(feature, label)
        counted = [F.count_if(F.col("part") == side), *found]
        return [c.alias(f"{name}{m}") for c, m in zip(counted, _MOMENTS)]

    found = pairs.agg(
        F.count(F.lit(1)).alias("tokens"),
        F.count_if(F.col("verdict") != "ok").alias("malformed"),
        *moments("train", ""),
        *(moments("test", "test_") if cfg.holdout else ()),
        F.min_by(
            F.struct("label", "feature"),
            F.when(F.col("part").isNotNull(), F.struct(*TOKEN_POSITION)),
        ).alias("first"),
    )
    deviation = F.lit(1.0)
    if cfg.scale:
        # A constant feature becomes 0, as if divided by infinity.
        spread = F.sqrt(F.col("sxx") * F.col("n") / F.greatest(F.col("n") - 1, F.lit(1)))
        deviation = F.when(spread > 0, spread).otherwise(float("inf"))
    found = found.withColumn("raw", F.struct(*_MOMENTS)).withColumn("deviation", deviation)
    found = found.withColumns(
        {
            "mx": F.col("mx") / F.col("deviation"),
            "sxx": F.col("sxx") / F.col("deviation") / F.col("deviation"),
            "sxy": F.col("sxy") / F.col("deviation"),
        }
    )
    if cfg.solver == "sgd":
        fitted = sgd_columns(
            found,
            num_iterations=cfg.num_iterations,
            step_size=cfg.step_size,
            convergence_tol=cfg.convergence_tol,
            init_weight=cfg.init_weight,
            reg_param=cfg.sgd_reg_param,
            intercept=True,
        )
    else:
        fitted = ridge_columns(found, cfg.reg_param)
    prediction = (
        F.col("weight") * (F.col("first.feature") / F.col("deviation")) + F.col("intercept")
    )
    return fitted.withColumn("first_prediction", prediction).first()


def _errors(weight: float, intercept: float, scale: float, m: dict, name: str) -> dict:
    """``mse``, ``rmse`` and ``r2`` of the line on samples with the moments ``m``."""
    if not m["n"]:
        return {f"{name}mse": None, f"{name}rmse": None, f"{name}r2": None}
    slope = weight / scale
    bias = slope * m["mx"] + intercept - m["my"]
    mse = max(m["syy"] + slope * slope * m["sxx"] - 2 * slope * m["sxy"] + bias * bias, 0.0)
    r2 = 1 - mse / m["syy"] if m["syy"] > 0 else None
    return {f"{name}mse": mse, f"{name}rmse": math.sqrt(mse), f"{name}r2": r2}


def batch_statistics(report: Row) -> dict:
    """A row of ``STATISTICS_SCHEMA``: means, correlation, and the errors of the fitted line."""
    raw = report["raw"].asDict()
    spread = math.sqrt(raw["sxx"] * raw["syy"])
    test = {m: report[f"test_{m}"] for m in _MOMENTS} if "test_n" in report else {"n": 0}
    line = (report["weight"], report["intercept"], report["deviation"])
    return {
        "n": raw["n"],
        "mean_label": raw["my"],
        "mean_feature": raw["mx"],
        "deviation": report["deviation"],
        "correlation": raw["sxy"] / spread if spread > 0 else math.nan,
        **_errors(*line, raw, ""),
        "test_n": test["n"],
        **_errors(*line, test, "test_"),
    }


@dataclass(frozen=True)
class BatchJob:
    """What happens to one micro-batch of parsed tokens.

    The driver takes one row from the batch.  Model and band then are plain
    numbers: predictions need no join and the band reaches the file scan of
    the restaurants.  Each output is written from one evaluation.

    The tables are opened for every batch, so that a long-running stream sees
    what was added to them.
    """

    cfg: JobConfig
    reviews: Callable[[], DataFrame]
    restaurants: Callable[[], DataFrame]
    outputs: Outputs

    def __call__(self, parsed: DataFrame, batch_id: int) -> None:
        if self.cfg.on_malformed != "quarantine" and not self.cfg.preview_rows:
            parsed = parsed.withColumn("token", F.lit(None).cast("string"))
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._run(parsed, batch_id)
        finally:
            parsed.unpersist()

    def _run(self, parsed: DataFrame, batch_id: int) -> None:
        cfg, out = self.cfg, self.outputs
        report = batch_report(parsed, cfg)
        if report["tokens"] == 0:
            return
        if cfg.preview_rows:
            # From the batch as it is kept: the source is not read again.
            first = preview_tokens(parsed.select(*TOKEN_POSITION, "token"), cfg.preview_rows)
            first.select("token").show(cfg.preview_rows, truncate=False)
        if cfg.on_malformed == "fail" and report["malformed"]:
            raise MalformedBatch(f"batch {batch_id}: {report['malformed']} malformed tokens")
        if cfg.on_malformed == "quarantine":
            out.quarantine.write(malformed(parsed), batch_id)
        if report["n"] == 0:
            return

        centre = report["first_prediction"]
        # One row is one task, however many cores the cluster has.
        one_row = parsed.sparkSession.range(0, 1, 1, 1)

        def write_predictions() -> None:
            feature = F.col("feature") / F.lit(report["deviation"])
            line = F.lit(report["weight"]) * feature + F.lit(report["intercept"])
            out.predictions.write(well_formed(parsed).withColumn("prediction", line), batch_id)

        def write_results() -> None:
            found = nearby_rated(
                self.reviews(),
                self.restaurants(),
                (centre - cfg.half_width, centre + cfg.half_width),
                (cfg.lng_low, cfg.lng_high),
                cfg.min_rating,
                cfg.result_limit,
                cfg.broadcast_bytes,
            )
            out.results.write(found, batch_id)

        def write_model() -> None:
            out.models.write(one_row.select(*_literals(report.asDict(), MODEL_SCHEMA)), batch_id)

        def write_statistics() -> None:
            row = _literals(batch_statistics(report), STATISTICS_SCHEMA)
            out.statistics.write(one_row.select(*row), batch_id)

        writes = [write_predictions, write_results, write_model]
        if cfg.statistics and out.statistics is not None:
            writes.append(write_statistics)
        _together(parsed.sparkSession, *writes)
        # Last, so that nothing is announced of a batch whose tables failed.
        pair = pair_text(F.lit(centre), F.lit(report["first"]["label"]))
        out.published.write(one_row.select(pair.alias("value")), batch_id)


def _literals(values: dict, schema: StructType) -> list[Column]:
    return [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema]


def _together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent writes at once; the first failure is raised after all have ended."""
    with ThreadPoolExecutor(len(writes)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in started:
        write.result()


def start_job(
    messages: DataFrame,
    job: BatchJob,
    checkpoint: str,
    available_now: bool = False,
    deal: bool = False,
) -> StreamingQuery:
    """Start the stream; a restart with the same checkpoint resumes it.

    ``deal`` is for sources that bring a batch in fewer tasks than there are cores.
    """
    trigger = {"availableNow": True} if available_now else {
        "processingTime": job.cfg.batch_interval
    }

    def run_dealt(batch: DataFrame, batch_id: int) -> None:
        job(parsed_stream(dealt(batch)), batch_id)

    # How many messages there are is known of a batch, not of a stream.
    stream, run = (messages, run_dealt) if deal else (parsed_stream(messages), job)
    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_preview(messages: DataFrame, batch_interval: str, rows: int = 10) -> StreamingQuery:
    """Print the first tokens of every batch to the console, by a stream of its own.

    A job prints those of its own batches if ``preview_rows`` is set.
    """
    return (
        explode_tokens(message_values(messages))
        .select("token")
        .writeStream.format("console")
        .option("numRows", rows)
        .trigger(processingTime=batch_interval)
        .start()
    )


def stored_tables(
    spark: SparkSession, cfg: JobConfig
) -> tuple[Callable[[], DataFrame], Callable[[], DataFrame]]:
    """How a job opens reviews and restaurants: by catalog name or from ORC folders."""
    if cfg.tables_from == "catalog":
        return (
            lambda: catalog_table(spark, cfg.reviews_table),
            lambda: catalog_table(spark, cfg.restaurants_table),
        )
    return (
        lambda: orc_table(spark, cfg.reviews_path, "reviews"),
        lambda: orc_table(spark, cfg.restaurants_path, "restaurants"),
    )


def run_kafka_job(spark: SparkSession, cfg: JobConfig, base: str) -> StreamingQuery:
    """The whole job between Kafka topics and stored tables."""
    return run_job(spark, cfg, base, kafka_source(spark, cfg), KafkaPublisher(cfg))


def run_job(
    spark: SparkSession,
    cfg: JobConfig,
    base: str,
    messages: DataFrame,
    target: Target | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """The job over any stream of messages, with checkpoint and outputs below ``base``.

    Records go to ``target`` once per batch; without one they are kept in a folder.
    """
    checkpoint, output = f"{base}/checkpoint", f"{base}/output"
    run_id = run_name(spark, checkpoint)
    if cfg.semantics == "logged":
        results = LoggedFolder(f"{output}/results", RESULT_SCHEMA, run_id)
    else:
        results = TableSink(cfg.results_table, cfg.semantics, run_id)
    published = PublishOnce.below(f"{output}/outbox", target, run_id) if target else None
    outputs = Outputs.in_folder(output, results, published, run_id)
    job = BatchJob(cfg, *stored_tables(spark, cfg), outputs)
    return start_job(messages, job, checkpoint, available_now)
