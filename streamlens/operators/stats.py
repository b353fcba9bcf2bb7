"""Scaling, summary statistics, splits and regression metrics."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.operators.joins import join_settled
from streamlens.operators.tokens import TOKEN_POSITION


def scale_features(
    samples: DataFrame,
    feature: str = "feature",
    by: Sequence[str] = (),
    salt_by: Sequence[str] = TOKEN_POSITION,
) -> DataFrame:
    """``scaled``: the feature over its sample standard deviation, without centring.

    A constant feature becomes 0.0.  The deviation is one row, which is broadcast, or
    with ``by`` one row per group, which is settled and counted first.
    """
    spread = samples.groupBy(*by).agg(F.coalesce(F.stddev_samp(feature), F.lit(0.0)).alias("__std"))
    if by:
        joined = join_settled(samples, spread, by, salt_by)
    else:
        joined = samples.crossJoin(F.broadcast(spread))
    scaled = F.when(F.col("__std") == 0, 0.0).otherwise(F.col(feature) / F.col("__std"))
    return joined.withColumn("scaled", scaled).drop("__std")


def column_means(
    samples: DataFrame, columns: Sequence[str] = ("label",), by: Sequence[str] = ()
) -> DataFrame:
    """Mean of each column as ``mean_<column>``."""
    return samples.groupBy(*by).agg(*(F.avg(c).alias(f"mean_{c}") for c in columns))


def correlation_matrix(
    samples: DataFrame,
    columns: Sequence[str] = ("label", "feature"),
    by: Sequence[str] = (),
) -> DataFrame:
    """Pearson correlations as rows ``(*by, i, j, corr)``, from one aggregate.

    A constant column correlates with nothing: NaN off the diagonal.
    """
    size = len(columns)
    spreads = [F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]
    shared = [
        F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}")
        for i in range(size)
        for j in range(i + 1, size)
    ]
    found = samples.groupBy(*by).agg(*spreads, *shared)

    def entry(i: int, j: int) -> Column:
        if i == j:
            known = F.lit(1.0)
        else:
            spread = F.col(f"s{i}") * F.col(f"s{j}")
            value = F.when(spread > 0, F.col(f"c{min(i, j)}_{max(i, j)}") / spread)
            known = F.coalesce(value, F.lit(float("nan")))
        return F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), known.alias("corr"))

    entries = [entry(i, j) for i in range(size) for j in range(size)]
    return found.select(*by, F.inline(F.array(*entries)))


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.9, 0.1), seed: int | None = None
) -> list[DataFrame]:
    """Spark's random split; without a seed every run differs.

    It sorts every partition, once per side; ``split_part`` needs neither.
    """
    return df.randomSplit(list(weights), seed)


def split_part(key: Column, train_fraction: float = 0.9) -> Column:
    """``train`` or ``test`` by a hash of the key.

    Unlike a random split it needs no sort to be repeatable, and a row falls
    on the same side in every run, task attempt and engine that has MD5.
    """
    draws = round(train_fraction * 16**8)
    cut = f"{draws:08x}" if draws < 16**8 else "g"
    draw = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.when(draw < cut, "train").otherwise("test")


def exact_split(
    df: DataFrame, key: Sequence[str], train_fraction: float = 0.9, part: str = "part"
) -> DataFrame:
    """``df`` with ``part``: ``train`` for exactly that share of the rows, rounded, else ``test``.

    The rows with the smallest hashes are the training part.  Where to cut is found without a sort:
    rows are counted by the first 16 bits of their hashes, then by the next 16 among those that
    share the cut's first ones, and so on, so a round brings 65,536 counts to the driver at
    most and reads only the key.  Rows of equal keys fall on one side together, the training side.
    """
    draw = F.md5(F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key)).cast("binary"))
    digits = 4
    drawn = df.select(draw.alias("__draw"))
    wanted = math.floor(train_fraction * drawn.count() + 0.5)
    cut = ""
    while wanted > 0 and len(cut) < 32:
        among = drawn.filter(F.col("__draw").startswith(cut)) if cut else drawn
        bucket = F.substring("__draw", len(cut) + 1, digits).alias("bucket")
        counts = among.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).orderBy("bucket").collect()
        for row in counts:
            if row["n"] >= wanted:
                break
            wanted -= row["n"]
        cut += row["bucket"]
        if row["n"] == wanted:
            break
    if not cut:
        side = F.lit("test")
    else:
        # Everything up to the cut, and what begins like it.
        side = F.when(F.substring(draw, 1, len(cut)) <= cut, "train").otherwise("test")
    return df.withColumn(part, side)


def regression_metrics(
    predicted: DataFrame,
    by: Sequence[str] = (),
    prediction: str = "prediction",
    label: str = "label",
) -> DataFrame:
    """``n, mse, rmse, r2`` of (prediction, label) in one pass.

    ``r2`` is null where all labels are equal.
    """
    error = F.col(prediction) - F.col(label)
    sums = predicted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.var_pop(label).alias("__variance"),
    )
    r2 = F.when(F.col("__variance") > 0, 1 - F.col("mse") / F.col("__variance"))
    return sums.select(*by, "n", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))
