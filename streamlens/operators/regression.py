"""Fits, predictions and the records at either end of a batch."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.functions import moments as mo
from streamlens.operators.joins import join_settled
from streamlens.operators.samples import finite_samples
from streamlens.operators.tokens import TOKEN_POSITION

MODEL_COLUMNS = ("n", "weight", "intercept", "initial_loss", "final_loss")
_MOMENT_COLUMNS = ("mx", "my", "sxx", "syy", "sxy")


def _grouped_moments(
    samples: DataFrame, by: Sequence[str | Column], extra: Sequence[Column] = ()
) -> DataFrame:
    aggregates = [*mo.moment_aggregates(F.col("feature"), F.col("label")), *extra]
    found = finite_samples(samples).groupBy(*by).agg(*aggregates)
    return found if by else found.filter(F.col("n") > 0)


def _with_losses(
    fitted: DataFrame, reg_param: float, start: tuple[float, float] = (0.0, 0.0)
) -> DataFrame:
    """Losses at ``start`` and at the fitted line."""
    m = mo.Moments.of_row()
    initial = mo.objective(m, F.lit(start[0]), F.lit(start[1]), reg_param)
    final = mo.objective(m, F.col("weight"), F.col("intercept"), reg_param)
    return fitted.withColumns({"initial_loss": initial, "final_loss": final}).drop(
        *_MOMENT_COLUMNS
    )


def ridge_columns(found: DataFrame, reg_param: float) -> DataFrame:
    """Replace the moment columns of ``found`` by the penalised line and its losses."""
    weight, intercept = mo.ridge_line(mo.Moments.of_row(), reg_param)
    fitted = found.withColumns({"weight": weight, "intercept": intercept})
    return _with_losses(fitted, reg_param)


def sgd_columns(
    found: DataFrame, *, reg_param: float, init_weight: float, intercept: bool, **options
) -> DataFrame:
    """Replace the moment columns of ``found`` by the descended line and its losses.

    ``losses`` has the loss before every iteration; ``at`` is for mini-batches.
    """
    start = mo.sgd_start(init_weight, intercept)
    line = mo.sgd_line(
        mo.Moments.of_row(), start, reg_param=reg_param, intercept=intercept, **options
    )
    fitted = (
        found.withColumn("__line", line)
        .withColumns(
            {
                "weight": F.col("__line.w"),
                "intercept": F.col("__line.b"),
                "iterations": F.col("__line.iterations"),
                "losses": F.col("__line.losses"),
            }
        )
        .drop("__line")
    )
    return _with_losses(fitted, reg_param, start)


def ridge_fit(
    samples: DataFrame, reg_param: float = 0.0001, by: Sequence[str | Column] = ()
) -> DataFrame:
    """One model row, or one per group of ``by``, from a single aggregate.

    The bias is an ordinary, penalised feature.  Groups without a finite
    sample, and an empty input, have no row.
    """
    return ridge_columns(_grouped_moments(samples, by), reg_param)


def sgd_fit(
    samples: DataFrame,
    by: Sequence[str | Column] = (),
    *,
    num_iterations: int = 100,
    step_size: float = 1.0,
    convergence_tol: float = 0.001,
    init_weight: float = 0.0,
    reg_param: float = 0.0,
    intercept: bool = False,
    mini_batch_fraction: float = 1.0,
    key: Sequence[str] = TOKEN_POSITION,
) -> DataFrame:
    """Gradient descent; the defaults are those of the one-line form.

    The rows are read once, for their moments; ``num_iterations`` does not
    change the number of passes.  With a ``mini_batch_fraction`` below 1 every iteration
    sees its own part of the rows, drawn by a hash of their ``key``, so a run over the
    same rows draws the same; iterations that draw nothing change nothing.  The losses
    before every iteration are those of its part, the initial and final one those of all rows.
    """
    if not 0 < mini_batch_fraction <= 1:
        raise ValueError("mini_batch_fraction must be above 0 and at most 1")
    options = {}
    if mini_batch_fraction < 1:
        found = _drawn_moments(samples, by, num_iterations, mini_batch_fraction, key)
        options["at"] = lambda t: F.get("__drawn", t - 1)
    else:
        found = _grouped_moments(samples, by)
    fitted = sgd_columns(
        found,
        num_iterations=num_iterations,
        step_size=step_size,
        convergence_tol=convergence_tol,
        init_weight=init_weight,
        reg_param=reg_param,
        intercept=intercept,
        **options,
    )
    return fitted.drop("__drawn")


def _drawn_moments(
    samples: DataFrame, by: Sequence[str | Column], iterations: int, fraction: float, key: Sequence[str]
) -> DataFrame:
    """Moments of all rows, and in ``__drawn`` those of the part that each iteration draws.

    A row meets the iterations it is drawn for before anything is shuffled, where it only
    adds to their moments: what moves is one row per iteration, group and task.
    """
    names = [f"__by_{i}" for i in range(len(by))]
    keys = [(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(by, names)]
    finite = finite_samples(samples).select(*keys, "label", "feature", *mini_batch_hashes(key))
    times = F.filter(
        F.sequence(F.lit(1), F.lit(int(iterations))), lambda t: drawn(t, fraction)
    )
    met = finite.select(
        *names, "label", "feature", F.explode(F.concat(F.array(F.lit(0)), times)).alias("__t")
    )
    found = met.groupBy(*names, "__t").agg(
        *mo.moment_aggregates(F.col("feature"), F.col("label"))
    )
    row = F.struct(*mo.MOMENTS)
    per_group = found.groupBy(*names).agg(
        F.max(F.when(F.col("__t") == 0, row)).alias("__all"),
        F.map_from_entries(F.collect_list(F.struct("__t", row.alias("m")))).alias("__by_t"),
    )
    every = F.transform(
        F.sequence(F.lit(1), F.lit(int(iterations))), lambda t: F.try_element_at("__by_t", t)
    )
    shown = [F.col(n).alias(c) for c, n in zip(samples.select(*by).columns, names)]
    return per_group.filter(F.col("__all").isNotNull()).select(
        *shown, "__all.*", every.alias("__drawn")
    )


def mini_batch_hashes(key: Sequence[str]) -> list[Column]:
    """Two numbers of 32 bits from the key of a row, the second one odd."""
    text = F.md5(F.concat_ws("/", *(F.col(c).cast("string") for c in key)).cast("binary"))

    def part(begin: int) -> Column:
        return F.conv(F.substring(text, begin, 8), 16, 10).cast("long")

    return [part(1).alias("__h"), part(9).bitwiseOR(F.lit(1).cast("long")).alias("__g")]


def drawn(t: Column, fraction: float) -> Column:
    """Whether iteration ``t`` draws the row; any two iterations draw independently."""
    place = (F.col("__h") + t.cast("long") * F.col("__g")) % F.lit(1 << 32)
    return place < F.lit(round(fraction * (1 << 32)))


def line_at(feature: Column) -> Column:
    """Prediction of the row's model at ``feature``."""
    return F.col("weight") * feature + F.col("intercept")


def predict(
    samples: DataFrame,
    model: DataFrame,
    by: Sequence[str] = (),
    salt_by: Sequence[str] = TOKEN_POSITION,
) -> DataFrame:
    """``samples`` with ``prediction``; the model comes from the same ``by``.

    Without ``by`` the model must be one row; it is folded to one, which is broadcast,
    and a second row is an error.  With it the models are settled and counted, see
    ``join_settled``.
    """
    lines = model.select(*by, "weight", "intercept")
    if by:
        joined = join_settled(samples, lines, by, salt_by)
    else:
        one = lines.agg(
            F.count(F.lit(1)).alias("__models"),
            F.first("weight").alias("weight"),
            F.first("intercept").alias("intercept"),
        ).filter(F.col("__models") > 0)
        many = F.raise_error(F.lit("the model has several rows; name their keys in by"))
        single = F.when(F.col("__models") > 1, many.cast("double")).otherwise(F.col("weight"))
        joined = samples.crossJoin(F.broadcast(one.withColumn("weight", single).drop("__models")))
    return joined.withColumn("prediction", line_at(F.col("feature"))).drop("weight", "intercept")


def prediction_triples(predicted: DataFrame) -> DataFrame:
    """``(prediction, label, features)``."""
    return predicted.select("prediction", "label", F.array("feature").alias("features"))


def _position(position: Sequence[str]) -> Column:
    return F.struct(*position)


def first_of(columns: Sequence[str], position: Sequence[str] = TOKEN_POSITION) -> Column:
    """Aggregate: ``columns`` of the row that comes first in stream order."""
    return F.min_by(F.struct(*columns), _position(position))


def last_of(columns: Sequence[str], position: Sequence[str] = TOKEN_POSITION) -> Column:
    """Aggregate: ``columns`` of the row that comes last in stream order."""
    return F.max_by(F.struct(*columns), _position(position))


def fit_with_ends(
    samples: DataFrame,
    reg_param: float = 0.0001,
    by: Sequence[str | Column] = (),
    position: Sequence[str] = TOKEN_POSITION,
) -> DataFrame:
    """``ridge_fit`` plus the first and last record of each group and their predictions.

    Everything a batch passes on (model, published pair, search band) is in
    this one row per batch, and it takes one pass: the ends are aggregates
    beside the moments, not a sort and not a join back to the samples.
    """
    pair = ("label", "feature")
    ends = [
        first_of(pair, position).alias("__first"),
        last_of(pair, position).alias("__last"),
    ]
    fitted = ridge_columns(_grouped_moments(samples, by, ends), reg_param)
    return fitted.withColumns(
        {
            "first_label": F.col("__first.label"),
            "first_prediction": line_at(F.col("__first.feature")),
            "last_label": F.col("__last.label"),
            "last_prediction": line_at(F.col("__last.feature")),
        }
    ).drop("__first", "__last")
