import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from streamlens.config import JobConfig
from streamlens.operators import lookup, regression, stats
from streamlens.operators.samples import parse_samples
from streamlens.operators.tokens import (
    TOKEN_POSITION,
    count_tokens,
    explode_tokens,
    message_values,
)
from streamlens.plans import queries
from streamlens.sinks.batches import RUN_KEYS, FolderSink, TableSink
from streamlens.sinks.log import LoggedFolder
from streamlens.sinks.outbox import TopicFolder
from streamlens.sources.streams import MESSAGE_SCHEMA, replay_source
from streamlens.sources.tables import catalog_table
from streamlens.streaming import windows
from streamlens.streaming.job import (
    batch_report,
    BatchJob,
    MalformedBatch,
    Outputs,
    RESULT_SCHEMA,
    dealt,
    parsed_stream,
    run_job,
    start_job,
    start_preview,
    stored_tables,
)

BATCHES = [
    ["52.5,1 52.5001,2", "52.5002,3"],
    ["52.6,1 52.6001,2 ", "52.6002,3"],
    ["52.7,1", "  "],
]
BAD_BATCH = ["bad 5, ,5 52.7,1"]


class Replay:
    """A folder of message files, one micro-batch each, and a job over them."""

    def __init__(self, spark, base, **settings):
        self.spark, self.base = spark, base
        self.offset = 0
        self.cfg = JobConfig(half_width=0.2, lng_low=13.0, lng_high=14.0, **settings)
        restaurants = [(i, f"c{i % 2}", 50.0 + i / 50, 13.3) for i in range(150)]
        reviews = [(f"u{i % 7}", i % 150, 1.0 + i % 5) for i in range(900)]
        self.restaurants = spark.createDataFrame(
            restaurants, "id int, category string, lat double, lng double"
        )
        self.reviews = spark.createDataFrame(
            reviews, "reviewer_id string, restaurant_id int, rating double"
        )
        self.outputs = Outputs.in_folder(f"{base}/output")

    def arrive(self, lines):
        rows = []
        for line in lines:
            rows.append((None, line, "t", 0, self.offset, dt.datetime(2024, 1, 1)))
            self.offset += 1
        df = self.spark.createDataFrame(rows, MESSAGE_SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{self.base}/messages")

    def run(self):
        messages = replay_source(
            self.spark, f"{self.base}/messages", max_files_per_trigger=1
        )
        job = BatchJob(self.cfg, lambda: self.reviews, lambda: self.restaurants, self.outputs)
        query = start_job(messages, job, f"{self.base}/checkpoint", available_now=True)
        query.awaitTermination()
        return query

    def rows(self, kind):
        found = getattr(self.outputs, kind).read(self.spark)
        return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.fixture
def replay(spark, tmp_path):
    return lambda **settings: Replay(spark, str(tmp_path), **settings)


def samples_of(spark, lines):
    rows = [("t", 0, i, line) for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    return parse_samples(explode_tokens(df), "drop")[0]


def test_stream_equals_batch(spark, replay):
    job = replay()
    for lines in BATCHES:
        job.arrive(lines)
    job.run()
    models = {r.batch_id: r for r in job.outputs.models.read(spark).collect()}
    assert sorted(models) == [0, 1, 2]
    for batch, lines in enumerate(BATCHES):
        want = regression.fit_with_ends(samples_of(spark, lines)).first()
        got = models[batch]
        assert (got.n, got.malformed) == (want.n, 0)
        assert got.weight == pytest.approx(want.weight, rel=1e-9)
        assert got.intercept == pytest.approx(want.intercept, rel=1e-9)
        assert got.final_loss == pytest.approx(want.final_loss, rel=1e-6, abs=1e-9)
        centre = want.first_prediction
        near = lookup.nearby_rated(
            job.reviews, job.restaurants, (centre - 0.2, centre + 0.2), (13.0, 14.0)
        )
        found = job.outputs.results.read(spark).filter(F.col("batch_id") == batch)
        assert sorted(tuple(r) for r in near.collect()) == sorted(
            tuple(r) for r in found.drop(*RUN_KEYS).collect()
        )
        (published,) = job.outputs.published.read(spark).filter(F.col("batch_id") == batch).collect()
        prediction, label = published.value.strip("()").split(",")
        assert published.value == f"({prediction},{label})"
        assert float(prediction) == pytest.approx(centre, rel=1e-9)
        assert float(label) == want.first_label
        predictions = job.outputs.predictions.read(spark).filter(F.col("batch_id") == batch)
        assert predictions.count() == want.n


def test_restart_resumes_and_adds_no_rows(replay):
    job = replay()
    job.arrive(BATCHES[0])
    job.run()
    before = {k: job.rows(k) for k in ("models", "predictions", "results", "published")}
    job.run()
    assert before == {k: job.rows(k) for k in before}
    job.arrive(BATCHES[1])
    job.run()
    assert len(job.rows("models")) == 2
    assert [r for r in job.rows("models") if r[-1] == 0] == before["models"]


def test_a_batch_that_runs_twice_is_stored_once(spark, replay):
    job = replay()
    batch = BatchJob(job.cfg, lambda: job.reviews, lambda: job.restaurants, job.outputs)
    job.arrive(BATCHES[0])
    messages = spark.read.schema(MESSAGE_SCHEMA).parquet(f"{job.base}/messages")
    batch(parsed_stream(messages), 0)
    before = {k: job.rows(k) for k in ("models", "predictions", "results", "published")}
    batch(parsed_stream(messages), 0)
    assert before == {k: job.rows(k) for k in before}


def test_empty_batch_writes_nothing(spark, replay, tmp_path):
    job = replay()
    batch = BatchJob(job.cfg, lambda: job.reviews, lambda: job.restaurants, job.outputs)
    for lines in ([], ["   "]):
        rows = [(None, line, "t", 0, 0, None) for line in lines]
        batch(parsed_stream(spark.createDataFrame(rows, MESSAGE_SCHEMA)), 0)
    assert not (tmp_path / "output").exists()


def test_malformed_batch_fails_before_writing(spark, replay, tmp_path):
    job = replay()
    job.arrive(BAD_BATCH)
    with pytest.raises(Exception, match="MalformedBatch"):
        job.run()
    assert not (tmp_path / "output").exists()
    assert issubclass(MalformedBatch, ValueError)


@pytest.mark.parametrize("policy", ["drop", "quarantine"])
def test_malformed_tokens_are_set_aside(replay, tmp_path, policy):
    job = replay(on_malformed=policy)
    job.arrive(BAD_BATCH)
    job.run()
    ((n, *_, tokens, malformed, _, _),) = job.rows("models")
    assert (n, tokens, malformed) == (1, 4, 3)
    if policy == "quarantine":
        assert [(r[3], r[4], r[5]) for r in job.rows("quarantine")] == [
            (0, "bad", "no feature"),
            (1, "5,", "no feature"),
            (2, ",5", "bad label"),
        ]
    else:
        assert not (tmp_path / "output" / "quarantine").exists()


def test_batch_without_a_usable_sample(replay, tmp_path):
    job = replay(on_malformed="quarantine")
    job.arrive(["abc NaN,1"])
    job.run()
    assert len(job.rows("quarantine")) == 1
    assert not (tmp_path / "output" / "models").exists()


def test_results_in_a_catalog_table(spark, replay):
    spark.sql("CREATE DATABASE IF NOT EXISTS restaurants")
    job = replay()
    job.outputs = Outputs.in_folder(f"{job.base}/output", TableSink("restaurants.results"))
    job.arrive(BATCHES[0])
    job.arrive(BATCHES[1])
    job.run()
    table = spark.table("restaurants.results")
    assert table.columns == [*lookup.RESULT_COLUMNS, *RUN_KEYS]
    assert table.filter("batch_id = 0").count() == 5


def test_statistics_holdout_and_scaling(spark, replay):
    lines = [f"{2.0 * x + (x % 7) / 10 + 1},{x}" for x in range(200)]
    job = replay(statistics=True, holdout=0.25, scale=True)
    job.arrive(lines)
    job.run()
    row = job.outputs.statistics.read(spark).first()
    every = samples_of(spark, lines).withColumn("topic", F.lit("t"))
    key = F.concat_ws("/", *TOKEN_POSITION)
    parts = every.withColumn("part", stats.split_part(key, 0.75))
    train = parts.filter("part = 'train'")
    deviation = train.agg(F.stddev_samp("feature")).first()[0]
    assert (row.n, row.test_n) == (train.count(), 200 - train.count())
    assert row.deviation == pytest.approx(deviation)
    scaled = parts.withColumn("feature", F.col("feature") / F.lit(deviation))
    model = regression.ridge_fit(scaled.filter("part = 'train'"), job.cfg.reg_param)
    measured = stats.regression_metrics(regression.predict(scaled, model), ["part"]).collect()
    for want in measured:
        name = "" if want.part == "train" else "test_"
        got = tuple(row[f"{name}{m}"] for m in ("mse", "rmse", "r2"))
        assert got == pytest.approx((want.mse, want.rmse, want.r2), rel=1e-6)
    (corr,) = stats.correlation_matrix(train).filter("i = 0 and j = 1").collect()
    assert row.correlation == pytest.approx(corr.corr)
    means = train.agg(F.avg("label"), F.avg("feature")).first()
    assert (row.mean_label, row.mean_feature) == pytest.approx(tuple(means))
    predicted = {r.offset: r.prediction for r in job.outputs.predictions.read(spark).collect()}
    want = {r.offset: r.prediction for r in regression.predict(scaled, model).collect()}
    assert predicted == pytest.approx(want)


def test_tokens_can_be_previewed(replay):
    job = replay()
    job.arrive(BATCHES[0])
    query = start_preview(replay_source(job.spark, f"{job.base}/messages"), "1 second", 3)
    query.processAllAvailable()
    progress = query.lastProgress
    query.stop()
    assert progress["numInputRows"] == len(BATCHES[0])
    assert "Console" in progress["sink"]["description"]


def test_rows_that_another_application_adds_are_seen(spark, tmp_path):
    """The other application writes files of the table without this session's knowledge."""
    spark.sql("CREATE DATABASE IF NOT EXISTS shared")
    spark.range(3).write.mode("overwrite").format("orc").saveAsTable("shared.reviews")
    assert catalog_table(spark, "shared.reviews").count() == 3
    described = spark.sql("DESCRIBE EXTENDED shared.reviews").collect()
    (path,) = (r.data_type for r in described if r.col_name == "Location")
    other = spark.newSession()
    other.range(2).write.mode("append").orc(path)
    assert catalog_table(spark, "shared.reviews").count() == 5


def test_a_day_of_many_events_is_parsed_by_several_tasks(spark, tmp_path):
    """A day is one file; a large one must not stay in the task that reads it, a small one may."""
    folder, many, few = str(tmp_path), 150_000, 3
    first_day = "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 86400)"
    events = spark.range(many + few).selectExpr(
        "id AS event_id",
        f"IF(id < {many}, {first_day}, TIMESTAMP_NTZ'2024-01-02 10:00:00') AS ts",
        "id % 997 AS user_id",
        "IF(id % 2 = 0, 'view', 'click') AS event_type",
        "round(rand(7) * 100, 2) AS value",
    )
    events.write.parquet(f"{folder}/events.parquet")
    spark.range(4).selectExpr(
        "id AS p_partkey", "'t' AS p_type", "50 AS p_size", "920.0D AS p_retailprice"
    ).write.parquet(f"{folder}/part.parquet")
    spark.range(8).selectExpr(
        "id AS l_suppkey", "id % 4 AS l_partkey", "5.0D AS l_quantity"
    ).write.parquet(f"{folder}/lineitem.parquet")
    out = queries._many_batches(spark, folder)
    found = out.predictions.read(spark).withColumn("file", F.input_file_name())
    per_batch = found.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("file").alias("files")
    )
    large, small = sorted(per_batch.collect(), key=lambda r: -r.rows)
    assert (large.rows, small.rows, small.files) == (2 * many, 2 * few, 1)
    assert large.files > 1
    # Once each, as if they had stayed in their file.
    assert found.select(*TOKEN_POSITION).distinct().count() == 2 * (many + few)


def test_dealt_rows_are_those_of_the_batch(spark):
    """Also messages without a place or a value, and equal ones; few are left as they are."""
    rows = [(None, v, t, p, o, None) for v, t, p, o in [
        ("1,2", "t", 0, 1), ("1,2", "t", 0, 1), (None, "t", 0, 2), ("3,4", None, None, None),
        ("", "t", 1, None),
    ]]
    df = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    assert sorted(map(repr, dealt(df, 2).collect())) == sorted(map(repr, df.collect()))
    assert dealt(df, 5) is df
    assert dealt(df.limit(0), 5).count() == 0


def test_sgd_solver(spark, replay):
    job = replay(solver="sgd", step_size=0.1)
    job.arrive(BATCHES[0])
    job.run()
    want = regression.sgd_fit(
        samples_of(spark, BATCHES[0]),
        num_iterations=100,
        step_size=0.1,
        convergence_tol=1e-5,
        reg_param=1e-6,
        intercept=True,
    ).first()
    got = job.outputs.models.read(spark).first()
    assert (got.weight, got.intercept) == pytest.approx((want.weight, want.intercept), rel=1e-9)


def test_tables_are_opened_by_name_or_folder(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS stored")
    spark.range(3).write.mode("overwrite").format("orc").saveAsTable("stored.reviews")
    spark.range(4).write.mode("overwrite").format("orc").saveAsTable("stored.restaurants")
    reviews, restaurants = stored_tables(
        spark, JobConfig(reviews_table="stored.reviews", restaurants_table="stored.restaurants")
    )
    assert (reviews().count(), restaurants().count()) == (3, 4)
    spark.range(1).write.insertInto("stored.reviews")
    assert reviews().count() == 4
    for name, rows in (("reviews", 5), ("restaurants", 6)):
        spark.range(rows).write.orc(str(tmp_path / name))
    reviews, restaurants = stored_tables(
        spark,
        JobConfig(
            tables_from="orc",
            reviews_path=str(tmp_path / "reviews"),
            restaurants_path=str(tmp_path / "restaurants"),
        ),
    )
    assert (reviews().count(), restaurants().count()) == (5, 6)
    assert spark.table("reviews").count() == 5


def test_report_is_one_row_whatever_the_batch(spark):
    df = spark.createDataFrame(
        [(None, "1,1 x 2,2", "t", 0, 1, None), (None, "3,3", "s", 5, 9, None)], MESSAGE_SCHEMA
    )
    row = batch_report(parsed_stream(df), JobConfig())
    assert (row["tokens"], row["malformed"], row["n"], row["first"]["label"]) == (4, 1, 3, 3.0)


def timed_samples(spark, rows, path):
    data = [(dt.datetime(2024, 1, day, hour), float(y), float(x)) for day, hour, y, x in rows]
    df = spark.createDataFrame(data, "ts timestamp, label double, feature double")
    df.coalesce(1).write.mode("append").parquet(path)


def test_windows_as_batch_and_as_stream(spark, tmp_path):
    path = str(tmp_path / "samples")
    timed_samples(spark, [(1, 1, 1, 1), (1, 5, 3, 2), (2, 2, 5, 1)], path)
    timed_samples(spark, [(1, 23, 4, 3), (2, 3, 6, 2), (3, 1, 9, 9)], path)
    schema = spark.read.parquet(path).schema
    want = windows.windowed_fit(spark.read.parquet(path), "ts", "1 day", 0.1)
    stream = replay_source(spark, path, schema, max_files_per_trigger=1)
    fitted = windows.windowed_fit(stream, "ts", "1 day", 0.1, watermark="5 days")
    sink = FolderSink(str(tmp_path / "models"), fitted.schema)
    windows.start_windowed_fit(
        fitted, sink, str(tmp_path / "checkpoint"), availableNow=True
    ).awaitTermination()
    got = windows.latest(sink.read(spark), ("window_start", "window_end"))
    rows = [sorted(tuple(r) for r in df.collect()) for df in (got, want.select(got.columns))]
    assert len(rows[0]) == 3
    for left, right in zip(*rows):
        assert left[:3] == right[:3]
        assert left[3:] == pytest.approx(right[3:], rel=1e-9, abs=1e-12)


def test_append_mode_leaves_out_the_open_window(spark, tmp_path):
    path = str(tmp_path / "samples")
    timed_samples(spark, [(1, 1, 1, 1), (2, 2, 5, 1), (3, 1, 9, 9)], path)
    stream = replay_source(spark, path, spark.read.parquet(path).schema)
    fitted = windows.windowed_fit(stream, "ts", "1 day", 0.1, watermark="1 hour")
    query = (
        fitted.writeStream.outputMode("append")
        .format("memory")
        .queryName("closed_windows")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    closed = [r.window_start.day for r in spark.table("closed_windows").collect()]
    assert sorted(closed) == [1, 2]


def test_streaming_token_count(spark, replay):
    job = replay()
    job.arrive(["a b a"])
    job.arrive(["b  a "])
    messages = replay_source(spark, f"{job.base}/messages", max_files_per_trigger=1)
    query = (
        count_tokens(explode_tokens(message_values(messages)))
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("token_counts")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert {r.token: r.n for r in spark.table("token_counts").collect()} == {"a": 3, "b": 2, "": 1}


def test_nothing_is_published_of_a_batch_that_failed(spark, replay, tmp_path):
    job = replay()
    job.arrive(BATCHES[0])
    messages = spark.read.schema(MESSAGE_SCHEMA).parquet(f"{job.base}/messages")

    def unreadable():
        raise OSError("no such table")

    batch = BatchJob(job.cfg, unreadable, lambda: job.restaurants, job.outputs)
    with pytest.raises(OSError):
        batch(parsed_stream(messages), 0)
    assert not (tmp_path / "output" / "published").exists()
    BatchJob(job.cfg, lambda: job.reviews, lambda: job.restaurants, job.outputs)(
        parsed_stream(messages), 0
    )
    assert len(job.rows("published")) == 1 and len(job.rows("models")) == 1


def test_a_whole_job_logs_results_publishes_once_and_prints_its_tokens(spark, replay, tmp_path, capsys):
    job = replay(semantics="logged", result_limit=None, preview_rows=2, tables_from="orc")
    job.restaurants.write.orc(str(tmp_path / "restaurants"))
    job.reviews.write.orc(str(tmp_path / "reviews"))
    cfg = dataclasses.replace(
        job.cfg, reviews_path=str(tmp_path / "reviews"), restaurants_path=str(tmp_path / "restaurants")
    )
    target = TopicFolder(str(tmp_path / "topic"))
    for lines in BATCHES[:2]:
        job.arrive(lines)
        messages = replay_source(spark, f"{tmp_path}/messages")
        run_job(spark, cfg, str(tmp_path / "job"), messages, target, available_now=True).awaitTermination()
    job.run()
    run_id = target.read(spark).first().key.split("/")[0]
    logged = LoggedFolder(f"{tmp_path}/job/output/results", RESULT_SCHEMA, run_id)
    assert logged.compact(spark) == 2

    def rows(df):
        return sorted(tuple(r) for r in df.drop("run_id").collect())

    assert rows(logged.read(spark)) == rows(job.outputs.results.read(spark))
    sent = sorted(r.value for r in target.read(spark).collect())
    assert sent == sorted(r.value for r in job.outputs.published.read(spark).collect())
    printed = capsys.readouterr().out
    assert "52.5,1" in printed and "52.5001,2" in printed and "52.5002,3" not in printed
