"""The registered queries; each takes the session and the folder of the tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.config import JobConfig
from streamlens.functions.text import pair_text
from streamlens.functions.time import epoch_day, utc_wall_clock
from streamlens.operators import lookup, moment_store, regression, samples, stats, tokens
from streamlens.plans import mapping as mp
from streamlens.sinks.batches import RUN_KEYS, FolderSink
from streamlens.sinks.log import LoggedFolder
from streamlens.sinks.outbox import PublishOnce, TopicFolder
from streamlens.sources import colocated, places
from streamlens.sources.scratch import fresh_folder, settle
from streamlens.sources.streams import replay_source
from streamlens.sources.tables import (
    catalog_table,
    nearby_by_sql,
    orc_table,
    parquet_table,
)
from streamlens.streaming import late, ledger, windows
from streamlens.streaming.job import BatchJob, Outputs, run_job, start_job

MODEL_DOUBLES = ("weight", "intercept", "initial_loss", "final_loss")
_FIT_BY_DAY = ("batch_id",)


# --- lookup -----------------------------------------------------------------


def _part_band(spark: SparkSession, folder: str) -> tuple[float, float]:
    """The band around the first prediction: one row of two numbers."""
    fitted = regression.fit_with_ends(mp.part_samples(spark, folder), mp.REG_PARAM)
    low, high = lookup.search_band(F.col("first_prediction"), mp.HALF_WIDTH)
    row = fitted.select(low.alias("low"), high.alias("high")).first()
    return row["low"], row["high"]


def _nearby(spark: SparkSession, folder: str, limit: int | None) -> DataFrame:
    found = lookup.nearby_rated(
        mp.reviews(spark, folder),
        mp.restaurants(spark, folder),
        _part_band(spark, folder),
        mp.PART_LNG,
        mp.MIN_RATING,
        limit,
    )
    return mp.rounded(found, "avg_rating")


def nearby_top_rated(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: fit, predict, take the band of the first record, look up, rank."""
    return _nearby(spark, folder, 5)


def nearby_all_groups(spark: SparkSession, folder: str) -> DataFrame:
    return _nearby(spark, folder, None)


def top_reviewers_list(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.first_column_list(_nearby(spark, folder, 5))


def rated_join(spark: SparkSession, folder: str) -> DataFrame:
    """Rated reviews per category of their restaurant."""
    matched = lookup.rated_matches(
        mp.reviews(spark, folder), mp.restaurants(spark, folder), mp.MIN_RATING
    )
    return matched.groupBy("category").agg(
        F.sum("times").alias("n"), F.round(F.sum("total"), 6).alias("sum_rating")
    )


def band_filter(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.within_band(mp.restaurants(spark, folder), (905.0, 920.0), mp.PART_LNG)


def avg_rating_by_reviewer(spark: SparkSession, folder: str) -> DataFrame:
    groups = lookup.rated_groups(
        mp.reviews(spark, folder), mp.restaurants(spark, folder), mp.MIN_RATING
    )
    return mp.rounded(lookup.top_groups(groups, None), "avg_rating")


@contextmanager
def _orc_database(spark: SparkSession, reviews: DataFrame, restaurants: DataFrame) -> Iterator[str]:
    """A database of its own with both tables stored as ORC; dropped afterwards."""
    name = f"streamlens_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_folder(spark, 'database')}'")
    try:
        reviews.write.format("orc").saveAsTable(f"{name}.reviews")
        restaurants.write.format("orc").saveAsTable(f"{name}.restaurants")
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _sql_lookup(spark: SparkSession, reviews: DataFrame, restaurants: DataFrame) -> DataFrame:
    with _orc_database(spark, reviews, restaurants) as database:
        found = nearby_by_sql(
            spark,
            (905.0, 920.0),
            mp.PART_LNG,
            mp.MIN_RATING,
            f"{database}.reviews",
            f"{database}.restaurants",
        )
        # Computed before the tables go.
        settled, _ = settle(found)
    return mp.rounded(settled, "avg_rating")


def catalog_sql_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The SQL statement over stored ORC tables by their database-qualified names."""
    return _sql_lookup(spark, mp.reviews(spark, folder), mp.restaurants(spark, folder))


def catalog_orc_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup by operators over stored ORC tables by their database-qualified names."""
    reviews, restaurants = mp.reviews(spark, folder), mp.restaurants(spark, folder)
    with _orc_database(spark, reviews, restaurants) as database:
        found = lookup.nearby_rated(
            catalog_table(spark, f"{database}.reviews"),
            catalog_table(spark, f"{database}.restaurants"),
            (905.0, 920.0),
            mp.PART_LNG,
            mp.MIN_RATING,
            None,
        )
        settled, _ = settle(found)
    return mp.rounded(settled, "avg_rating")


def nan_ratings_sql_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The SQL statement where the first line of every order has NaN for a rating."""
    return _sql_lookup(spark, mp.nan_reviews(spark, folder), mp.restaurants(spark, folder))


def nan_ratings_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The same by operators."""
    found = lookup.nearby_rated(
        mp.nan_reviews(spark, folder),
        mp.restaurants(spark, folder),
        (905.0, 920.0),
        mp.PART_LNG,
        mp.MIN_RATING,
        None,
    )
    return mp.rounded(found, "avg_rating")


def orc_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Restaurants written as an ORC table and scanned by path, view and catalog name."""
    path = fresh_folder(spark, "restaurants-orc")
    mp.restaurants(spark, folder).write.orc(path)
    orc_table(spark, path, view="streamlens_restaurants")
    return catalog_table(spark, "streamlens_restaurants")


def colocated_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup in one band, joined bucket by bucket from stored tables."""
    return _colocated(spark, folder, (905.0, 920.0), mp.PART_LNG)


def colocated_all_groups(spark: SparkSession, folder: str) -> DataFrame:
    """All averages, joined bucket by bucket from stored tables."""
    return _colocated(spark, folder, None, None)


def _colocated(
    spark: SparkSession, folder: str, lat: tuple[float, float] | None, lng: tuple[float, float] | None
) -> DataFrame:
    name = f"streamlens_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_folder(spark, 'database')}'")
    try:
        colocated.store_reviews(mp.reviews(spark, folder), f"{name}.reviews", buckets)
        colocated.store_restaurants(mp.restaurants(spark, folder), f"{name}.restaurants", buckets)
        groups = colocated.colocated_groups(
            spark, f"{name}.reviews", f"{name}.restaurants", lat, lng, mp.MIN_RATING
        )
        settled, _ = settle(lookup.top_groups(groups, None))
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
    return mp.rounded(settled, "avg_rating")


def band_by_place(spark: SparkSession, folder: str) -> DataFrame:
    """Restaurants of a narrow band, from files along a Z-order curve."""
    path = fresh_folder(spark, "places")
    restaurants = mp.restaurants(spark, folder)
    places.store_by_place(restaurants, path, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return places.restaurants_in_band(spark, path, restaurants.schema, (905.0, 920.0), (10.0, 20.0))


# --- tokens and samples -----------------------------------------------------


def message_tokens(spark: SparkSession, folder: str) -> DataFrame:
    messages = mp.event_messages(parquet_table(spark, folder, "events"))
    found = tokens.explode_tokens(tokens.message_values(messages))
    return found.select(*tokens.TOKEN_POSITION, "token")


def padded_text_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Whole conversation texts with spaces added before, between and after sentences."""
    padded = F.concat(F.lit("  "), F.replace("text", F.lit("."), F.lit(".  ")), F.lit("   "))
    turns = parquet_table(spark, folder, "conversations").select(
        "conv_id", "turn", padded.alias("value")
    )
    return tokens.explode_tokens(turns)


def token_preview(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.preview_tokens(message_tokens(spark, folder), 10)


def token_count(spark: SparkSession, folder: str) -> DataFrame:
    documents = parquet_table(spark, folder, "documents")
    messages = mp.text_messages(documents, "documents", "doc_id", F.col("text"))
    return tokens.count_tokens(tokens.explode_tokens(tokens.message_values(messages)))


def parsed_samples(spark: SparkSession, folder: str) -> DataFrame:
    return mp.event_samples(spark, folder).select(
        "batch_id", *tokens.TOKEN_POSITION, "label", "feature"
    )


def _noisy_tokens(spark: SparkSession, folder: str) -> DataFrame:
    messages = mp.noisy_event_messages(parquet_table(spark, folder, "events"))
    return tokens.explode_tokens(tokens.message_values(messages)).select(
        *tokens.TOKEN_POSITION, "token"
    )


def malformed_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return samples.parse_samples(_noisy_tokens(spark, folder), "quarantine")[1]


def tolerant_samples(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of noisy messages, and may enter a fit."""
    kept = samples.parse_samples(_noisy_tokens(spark, folder), "drop")[0]
    return samples.finite_samples(kept)


def document_token_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Every token of every whole document, judged and counted by language."""
    documents = parquet_table(spark, folder, "documents")
    found = documents.select("lang", F.col("text").alias("value"))
    parsed = samples.parse_tokens(tokens.explode_tokens(found))
    return parsed.groupBy("lang", "verdict").agg(F.count(F.lit(1)).alias("n"))


# --- regression -------------------------------------------------------------


def ridge_fit(spark: SparkSession, folder: str) -> DataFrame:
    return mp.rounded(
        regression.ridge_fit(mp.part_samples(spark, folder), mp.REG_PARAM), *MODEL_DOUBLES
    )


def ridge_fit_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    fitted = regression.ridge_fit(mp.event_samples(spark, folder), mp.REG_PARAM, _FIT_BY_DAY)
    return mp.rounded(fitted, *MODEL_DOUBLES)


def ridge_predictions(spark: SparkSession, folder: str) -> DataFrame:
    found = mp.part_samples(spark, folder)
    predicted = regression.predict(found, regression.ridge_fit(found, mp.REG_PARAM))
    return mp.rounded(predicted.select("offset", "prediction", "label"), "prediction")


def ridge_predictions_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    found = mp.event_samples(spark, folder)
    model = regression.ridge_fit(found, mp.REG_PARAM, _FIT_BY_DAY)
    predicted = regression.predict(found, model, _FIT_BY_DAY)
    return mp.rounded(
        predicted.select("batch_id", "offset", "pos", "prediction", "label"), "prediction"
    )


def prediction_triples(spark: SparkSession, folder: str) -> DataFrame:
    found = mp.part_samples(spark, folder)
    predicted = regression.predict(found, regression.ridge_fit(found, mp.REG_PARAM))
    triples = regression.prediction_triples(predicted)
    return mp.rounded(
        triples.select("prediction", "label", F.get("features", F.lit(0)).alias("feature")),
        "prediction",
    )


def _day_ends(spark: SparkSession, folder: str) -> DataFrame:
    return regression.fit_with_ends(
        mp.event_samples(spark, folder), mp.REG_PARAM, _FIT_BY_DAY
    )


def _pair_per_batch(spark: SparkSession, folder: str, end: str) -> DataFrame:
    prediction = F.round(f"{end}_prediction", 6)
    label = F.col(f"{end}_label")
    return _day_ends(spark, folder).select(
        "batch_id",
        prediction.alias("prediction"),
        label.alias("label"),
        pair_text(prediction, label).alias("value"),
    )


def first_pair_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _pair_per_batch(spark, folder, "first")


def last_pair_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _pair_per_batch(spark, folder, "last")


def _day_bands(spark: SparkSession, folder: str) -> DataFrame:
    low, high = lookup.search_band(F.col("first_prediction"), mp.HALF_WIDTH)
    return _day_ends(spark, folder).select(
        "batch_id", low.alias("lat_low"), high.alias("lat_high")
    )


def search_band_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    return mp.rounded(_day_bands(spark, folder), "lat_low", "lat_high")


def _band_lookup(spark: SparkSession, folder: str, limit: int | None) -> DataFrame:
    found = lookup.nearby_rated_per_batch(
        mp.reviews(spark, folder),
        mp.sized_restaurants(spark, folder),
        _day_bands(spark, folder),
        mp.SIZE_LNG,
        mp.HALF_WIDTH,
        mp.MIN_RATING,
        limit,
    )
    return mp.rounded(found, "avg_rating")


def band_lookup_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _band_lookup(spark, folder, None)


def band_top_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _band_lookup(spark, folder, 5)


def _scaled_part_samples(spark: SparkSession, folder: str) -> DataFrame:
    scaled = stats.scale_features(mp.part_samples(spark, folder))
    return scaled.withColumn("feature", F.col("scaled"))


def sgd_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Descent on scaled features with an intercept and a penalty."""
    fitted = regression.sgd_fit(
        _scaled_part_samples(spark, folder),
        num_iterations=100,
        step_size=0.1,
        convergence_tol=0.00001,
        init_weight=2.5,
        reg_param=0.000001,
        intercept=True,
    )
    return mp.rounded(fitted.drop("iterations", "losses"), *MODEL_DOUBLES)


def sgd_default_fit(spark: SparkSession, folder: str) -> DataFrame:
    """The one-line form per day, scaled within the day: no intercept, no penalty."""
    found = mp.event_samples(spark, folder)
    spread = stats.scale_features(found, by=_FIT_BY_DAY).withColumn("feature", F.col("scaled"))
    fitted = regression.sgd_fit(spread, _FIT_BY_DAY, num_iterations=50, step_size=0.2)
    return mp.rounded(fitted.drop("losses"), *MODEL_DOUBLES)


def sgd_mini_batch_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Descent per day where every iteration sees its own half of the readings."""
    found = mp.event_samples(spark, folder)
    spread = stats.scale_features(found, by=_FIT_BY_DAY).withColumn("feature", F.col("scaled"))
    fitted = regression.sgd_fit(
        spread,
        _FIT_BY_DAY,
        num_iterations=30,
        step_size=0.2,
        convergence_tol=0.0,
        reg_param=0.0001,
        intercept=True,
        mini_batch_fraction=0.5,
    )
    return mp.rounded(fitted.drop("losses"), *MODEL_DOUBLES)


# --- statistics -------------------------------------------------------------


def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    scaled = stats.scale_features(mp.event_samples(spark, folder))
    return mp.rounded(scaled.select("offset", "pos", "label", "scaled"), "scaled")


def scaled_features_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    scaled = stats.scale_features(mp.event_samples(spark, folder), by=_FIT_BY_DAY)
    return mp.rounded(scaled.select("batch_id", "offset", "pos", "label", "scaled"), "scaled")


def column_means(spark: SparkSession, folder: str) -> DataFrame:
    means = stats.column_means(
        mp.event_samples(spark, folder), ("label", "feature"), _FIT_BY_DAY
    )
    return mp.rounded(means, "mean_label", "mean_feature")


def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return mp.rounded(stats.correlation_matrix(mp.event_samples(spark, folder)), "corr")


def correlation_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    found = stats.correlation_matrix(mp.event_samples(spark, folder), by=_FIT_BY_DAY)
    return mp.rounded(found, "corr")


def in_sample_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = mp.part_samples(spark, folder)
    predicted = regression.predict(found, regression.ridge_fit(found, mp.REG_PARAM))
    return mp.rounded(stats.regression_metrics(predicted), "mse", "rmse", "r2")


def _split_part_samples(spark: SparkSession, folder: str) -> DataFrame:
    found = mp.part_samples(spark, folder)
    return found.withColumn("part", stats.split_part(F.col("offset"), 0.9))


def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    return _split_part_samples(spark, folder).select("offset", "part")


def holdout_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on the training part, measured on both parts."""
    found = _split_part_samples(spark, folder)
    model = regression.ridge_fit(found.filter(F.col("part") == "train"), mp.REG_PARAM)
    predicted = regression.predict(found, model)
    return mp.rounded(stats.regression_metrics(predicted, ["part"]), "mse", "rmse", "r2")


def exact_split_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Nine tenths of the readings, to the row."""
    found = mp.event_samples(spark, folder).select("offset", "pos")
    return stats.exact_split(found, ("offset", "pos"), 0.9)


def random_split_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What every seed must give: each sample on one side, none missing and none twice."""
    found = mp.part_samples(spark, folder)
    train, test = stats.random_split(found.select("offset"), (0.9, 0.1), seed=42)
    both = train.unionByName(test).groupBy("offset").agg(F.count(F.lit(1)).alias("times"))
    sides = found.select("offset").join(both, "offset", "left")
    return sides.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("times").isNull()).alias("missing"),
        F.count_if(F.col("times") > 1).alias("doubled"),
    )


# --- streams ----------------------------------------------------------------


def windowed_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Fits per day window, as a batch."""
    fitted = windows.windowed_fit(
        mp.event_samples(spark, folder), "timestamp", "1 day", mp.REG_PARAM
    )
    return _day_models(fitted)


def _day_models(fitted: DataFrame) -> DataFrame:
    day = epoch_day(utc_wall_clock(F.col("window_start"))).alias("batch_id")
    return mp.rounded(fitted.select(day, *regression.MODEL_COLUMNS), *MODEL_DOUBLES)


def _replayed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream; the pattern matches a file and a folder of files."""
    schema = parquet_table(spark, folder, name).schema
    return replay_source(spark, f"{folder}/{name}.parquet*", schema)


def stream_windowed_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Fits per day window, kept by a stream over the events."""
    base = fresh_folder(spark, "windowed")
    events = _replayed(spark, folder, "events")
    fitted = windows.windowed_fit(
        mp.samples_of(mp.event_messages(events)), "timestamp", "1 day", mp.REG_PARAM, "1 day"
    )
    sink = FolderSink(f"{base}/models", fitted.schema)
    query = windows.start_windowed_fit(fitted, sink, f"{base}/checkpoint", availableNow=True)
    query.awaitTermination()
    return _day_models(windows.latest(sink.read(spark), ("window_start", "window_end")))


def _run_part_job(spark: SparkSession, folder: str, **settings) -> Outputs:
    """The whole job over the parts as a stream; all of them are one micro-batch."""
    cfg = JobConfig(
        reg_param=mp.REG_PARAM,
        half_width=mp.HALF_WIDTH,
        min_rating=mp.MIN_RATING,
        lng_low=mp.PART_LNG[0],
        lng_high=mp.PART_LNG[1],
        **settings,
    )
    base = fresh_folder(spark, "job")
    outputs = Outputs.in_folder(f"{base}/output")
    job = BatchJob(
        cfg,
        lambda: mp.reviews(spark, folder),
        lambda: mp.restaurants(spark, folder),
        outputs,
    )
    messages = mp.part_messages(_replayed(spark, folder, "part"))
    start_job(messages, job, f"{base}/checkpoint", available_now=True).awaitTermination()
    return outputs


def stream_nearby_top_rated(spark: SparkSession, folder: str) -> DataFrame:
    found = _run_part_job(spark, folder).results.read(spark)
    return mp.rounded(found.drop(*RUN_KEYS), "avg_rating")


def stream_model_report(spark: SparkSession, folder: str) -> DataFrame:
    found = _run_part_job(spark, folder).models.read(spark)
    return mp.rounded(found.drop(*RUN_KEYS), *MODEL_DOUBLES)


def stream_predictions(spark: SparkSession, folder: str) -> DataFrame:
    found = _run_part_job(spark, folder).predictions.read(spark)
    return mp.rounded(found.select("offset", "prediction", "label"), "prediction")


def stream_published_pair(spark: SparkSession, folder: str) -> DataFrame:
    """The published record, read back as numbers."""
    found = _run_part_job(spark, folder).published.read(spark)
    pair = F.split(F.btrim(F.col("value"), F.lit("()")), ",")
    return found.select(
        F.round(pair[0].cast("double"), 6).alias("prediction"),
        pair[1].cast("double").alias("label"),
    )


def two_runs_one_table(spark: SparkSession, folder: str) -> DataFrame:
    """Two jobs with checkpoints of their own add to one results table; both stay."""
    reviews, restaurants = mp.reviews(spark, folder), mp.restaurants(spark, folder)
    with _orc_database(spark, reviews, restaurants) as database:
        for half_width in (mp.HALF_WIDTH, 2 * mp.HALF_WIDTH):
            cfg = JobConfig(
                reg_param=mp.REG_PARAM,
                half_width=half_width,
                min_rating=mp.MIN_RATING,
                lng_low=mp.PART_LNG[0],
                lng_high=mp.PART_LNG[1],
                result_limit=None,
                reviews_table=f"{database}.reviews",
                restaurants_table=f"{database}.restaurants",
                results_table=f"{database}.results",
            )
            messages = mp.part_messages(_replayed(spark, folder, "part"))
            base = fresh_folder(spark, "job")
            run_job(spark, cfg, base, messages, available_now=True).awaitTermination()
        settled, _ = settle(catalog_table(spark, f"{database}.results").drop(*RUN_KEYS))
    return mp.rounded(settled, "avg_rating")


def _many_batches(spark: SparkSession, folder: str) -> Outputs:
    """The job over the events, one file and micro-batch a day, an empty and a bad one among them."""
    base = fresh_folder(spark, "days")
    messages = mp.event_messages(parquet_table(spark, folder, "events"))
    day = F.to_date(utc_wall_clock(F.col("timestamp")))
    bad = F.lit("bad ,5 5, x").alias("value")
    messages.withColumn("day", day).repartition("day").write.partitionBy("day").parquet(f"{base}/in")
    one = messages.limit(0).withColumn("day", F.lit("empty"))
    one.coalesce(1).drop("day").write.parquet(f"{base}/in/day=empty")
    first = messages.orderBy("offset").limit(1).withColumn("value", bad)
    first.coalesce(1).write.parquet(f"{base}/in/day=bad")
    cfg = JobConfig(
        reg_param=mp.REG_PARAM,
        half_width=mp.HALF_WIDTH,
        min_rating=mp.MIN_RATING,
        lng_low=mp.SIZE_LNG[0],
        lng_high=mp.SIZE_LNG[1],
        on_malformed="quarantine",
        statistics=True,
    )
    outputs = Outputs.in_folder(f"{base}/output")
    reviews, restaurants = mp.reviews(spark, folder), mp.sized_restaurants(spark, folder)
    job = BatchJob(cfg, lambda: reviews, lambda: restaurants, outputs)
    stream = replay_source(spark, f"{base}/in/*", max_files_per_trigger=1)
    start_job(stream, job, f"{base}/checkpoint", available_now=True, deal=True).awaitTermination()
    return outputs


def stream_many_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Model, statistics and lookup of every one of many micro-batches in a row.

    The order of the files is that of the file system, so the rows go without a number.
    """
    out = _many_batches(spark, folder)
    measured = out.statistics.read(spark).select(*RUN_KEYS, "correlation", "mse", "r2")
    both = out.models.read(spark).drop("tokens", "malformed").join(measured, list(RUN_KEYS))
    found = both.join(out.results.read(spark), list(RUN_KEYS), "left").drop(*RUN_KEYS)
    return mp.rounded(found, *MODEL_DOUBLES, "correlation", "mse", "r2", "avg_rating")


def _samples_by_file(spark: SparkSession, folder: str, file: Column, base: str) -> DataFrame:
    """The samples of the events as a stream, one micro-batch per value of ``file``."""
    found = mp.event_samples(spark, folder).withColumn("file", file)
    found.repartition("file").write.partitionBy("file").parquet(f"{base}/in")
    schema = found.drop("file").schema
    return replay_source(spark, f"{base}/in/*", schema, max_files_per_trigger=1)


def stream_logged_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of a day each in a logged folder: compacted half-way, one written again after."""
    base = fresh_folder(spark, "logged")
    stream = _samples_by_file(spark, folder, F.col("batch_id"), base)
    columns = stream.select("batch_id", "offset", "pos", "label", "feature").toDF(
        "day", "offset", "pos", "label", "feature"
    )
    sink = LoggedFolder(f"{base}/samples", columns.schema)

    def store(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch, batch_id)
        if batch_id == 15:
            sink.compact(spark)

    query = (
        columns.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    sink.write(sink.read(spark).filter("batch_id = 3"), 3)
    return sink.read(spark).drop(*RUN_KEYS)


def _two_batches(spark: SparkSession, folder: str) -> moment_store.MomentStore:
    """A store of daily moments from two batches of every day."""
    store = moment_store.MomentStore.below(fresh_folder(spark, "moments"))
    found = mp.event_samples(spark, folder)
    for part in (0, 1):
        store.add(found.filter(F.col("offset") % 2 == part), "timestamp", part)
    return store


def sliding_fit_from_store(spark: SparkSession, folder: str) -> DataFrame:
    """Fits of seven days, one per day, from stored moments."""
    stored = _two_batches(spark, folder).read(spark)
    fitted = moment_store.sliding_fit(stored, "7 days", "1 day", mp.REG_PARAM)
    return _day_models(fitted)


def fit_of_batch_from_store(spark: SparkSession, folder: str) -> DataFrame:
    """A fit of each stored batch, all its days together."""
    stored = _two_batches(spark, folder).read(spark)
    fitted = moment_store.stored_fit(stored, mp.REG_PARAM, ("batch_id",))
    return mp.rounded(fitted, *MODEL_DOUBLES)


def fit_of_days_from_store(spark: SparkSession, folder: str) -> DataFrame:
    """One fit of all days from the tenth of a month to its nineteenth."""
    stored = _two_batches(spark, folder).read(spark)
    days = F.dayofmonth(utc_wall_clock(F.col("slot"))).between(10, 19)
    return mp.rounded(moment_store.stored_fit(stored.filter(days), mp.REG_PARAM), *MODEL_DOUBLES)


def _with_late_files(spark: SparkSession, folder: str) -> late.LateKeeper:
    """Every seventh event comes after all others; the stream is started again for them."""
    base = fresh_folder(spark, "late")
    found = mp.event_samples(spark, folder).drop("batch_id")
    keeper = late.LateKeeper.below(f"{base}/out", found.schema, "timestamp", "1 DAY")
    for part in (F.col("offset") % 7 != 0, F.col("offset") % 7 == 0):
        found.filter(part).write.mode("append").parquet(f"{base}/in")
        stream = replay_source(spark, f"{base}/in", found.schema)
        late.start_late_keeper(stream, keeper, f"{base}/checkpoint", availableNow=True).awaitTermination()
    return keeper


def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that came behind the watermark."""
    found = _with_late_files(spark, folder).late.read(spark)
    return found.select("topic", "partition", "offset", "pos", "label", "feature")


def stream_late_rows_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Fits per day with late rows counted in: those of a batch over all rows."""
    stored = _with_late_files(spark, folder).store.read(spark)
    fitted = moment_store.stored_fit(stored, mp.REG_PARAM, ("slot",))
    return _day_models(fitted.withColumnRenamed("slot", "window_start"))


def offset_findings(spark: SparkSession, folder: str) -> DataFrame:
    """Gaps and overlaps of two batches of events; some were left out, some are read twice.

    The events of a partition are numbered without holes: a fourth of the event ids each.
    """
    events = parquet_table(spark, folder, "events").select(
        F.lit("events").alias("topic"),
        F.pmod("event_id", F.lit(4)).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).alias("offset"),
    )
    offset = F.col("offset")
    read = events.filter(~(offset % 200).between(50, 55 + F.col("partition")))
    ledger_of = ledger.OffsetLedger.below(fresh_folder(spark, "ledger"))
    first = offset % 400 < 160
    ledger_of.note(read.filter(first), 0)
    ledger_of.note(read.filter(~first | (offset % 400 >= 150)), 1)
    return ledger.findings(ledger_of.read(spark)).drop("run_id")


class _Interrupted(Exception):
    """The job ends here, as if it had been killed."""


def stream_published_once(spark: SparkSession, folder: str) -> DataFrame:
    """First pairs of four batches, of a job that dies twice after sending and starts again.

    The first time the outbox has no note of the sending, the second time it has.
    """
    base = fresh_folder(spark, "once")
    stream = _samples_by_file(spark, folder, F.col("batch_id") % 4, base)
    target, died = TopicFolder(f"{base}/topic"), set()
    outbox = LoggedFolder(f"{base}/outbox", PublishOnce.below("", target).outbox.schema)

    class DyingTarget(TopicFolder):
        def send(self, records: DataFrame) -> None:
            super().send(records)
            if "sending" not in died:
                died.add("sending")
                raise _Interrupted

    def publish(batch: DataFrame, batch_id: int) -> None:
        pairs = regression.fit_with_ends(batch, mp.REG_PARAM).select(
            pair_text(F.round("first_prediction", 6), F.col("first_label")).alias("value")
        )
        PublishOnce(DyingTarget(target.path), outbox).write(pairs, batch_id)
        if batch_id == 2 and "commit" not in died:
            died.add("commit")
            raise _Interrupted

    for _ in range(3):
        query = (
            stream.writeStream.foreachBatch(publish)
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        try:
            query.awaitTermination()
        except StreamingQueryException as problem:
            if _Interrupted.__name__ not in str(problem):
                raise
    return target.read(spark).select("value")


QUERIES: dict[str, mp.Query] = {
    query.__name__: query
    for query in (
        nearby_top_rated,
        nearby_all_groups,
        top_reviewers_list,
        rated_join,
        band_filter,
        avg_rating_by_reviewer,
        catalog_sql_lookup,
        catalog_orc_lookup,
        nan_ratings_sql_lookup,
        nan_ratings_lookup,
        orc_roundtrip,
        colocated_lookup,
        colocated_all_groups,
        band_by_place,
        message_tokens,
        padded_text_tokens,
        token_preview,
        token_count,
        parsed_samples,
        malformed_tokens,
        tolerant_samples,
        document_token_verdicts,
        ridge_fit,
        ridge_fit_per_batch,
        ridge_predictions,
        ridge_predictions_per_batch,
        prediction_triples,
        first_pair_per_batch,
        last_pair_per_batch,
        search_band_per_batch,
        band_lookup_per_batch,
        band_top_per_batch,
        sgd_fit,
        sgd_default_fit,
        sgd_mini_batch_fit,
        scaled_features,
        scaled_features_per_batch,
        column_means,
        correlation_matrix,
        correlation_per_batch,
        in_sample_metrics,
        holdout_split,
        holdout_metrics,
        random_split_rows,
        exact_split_rows,
        windowed_fit,
        stream_windowed_fit,
        stream_nearby_top_rated,
        stream_model_report,
        stream_predictions,
        stream_published_pair,
        two_runs_one_table,
        stream_many_batches,
        stream_logged_batches,
        sliding_fit_from_store,
        fit_of_batch_from_store,
        fit_of_days_from_store,
        stream_late_rows,
        stream_late_rows_merged,
        stream_published_once,
        offset_findings,
    )
}
