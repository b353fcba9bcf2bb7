"""Line fitting as algebra over population moments.

The moments are mergeable, so a fit costs one aggregate with constant state
per task, whatever the number of rows or groups.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOMENTS = ("n", "mx", "my", "sxx", "syy", "sxy")


def moment_aggregates(feature: Column, label: Column) -> list[Column]:
    """Aggregates ``n mx my sxx syy sxy`` (means, population variances, covariance)."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(feature).alias("mx"),
        F.avg(label).alias("my"),
        F.var_pop(feature).alias("sxx"),
        F.var_pop(label).alias("syy"),
        F.covar_pop(feature, label).alias("sxy"),
    ]


def merge_moments(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Moments of the union of samples, from rows of ``MOMENTS``; one row per ``by``.

    The means come first and the spreads are taken about them, so nothing large cancels, however
    far the means lie apart.  Rows without samples count for nothing; a group of only such rows,
    and an empty input, have no row.  Null keys are one group.
    """
    filled = stored.filter(F.col("n") > 0).select(*by, *MOMENTS)
    total = F.sum("n")
    means = filled.groupBy(*by).agg(
        total.alias("__n"),
        (F.sum(F.col("n") * F.col("mx")) / total).alias("__mx"),
        (F.sum(F.col("n") * F.col("my")) / total).alias("__my"),
    )
    if by:
        keyed = means.select(*(F.col(c).alias(f"__by_{i}") for i, c in enumerate(by)), "__n", "__mx", "__my")
        same = [F.col(c).eqNullSafe(F.col(f"__by_{i}")) for i, c in enumerate(by)]
        about = filled.join(keyed, same)
    else:
        # One row, whatever the input.
        about = filled.crossJoin(F.broadcast(means))
    dx, dy = F.col("mx") - F.col("__mx"), F.col("my") - F.col("__my")

    def spread(name: str, apart: Column) -> Column:
        return (F.sum(F.col("n") * (F.col(name) + apart)) / total).alias(name)

    return about.groupBy(*by).agg(
        total.alias("n"),
        F.first("__mx").alias("mx"),
        F.first("__my").alias("my"),
        spread("sxx", dx * dx),
        spread("syy", dy * dy),
        spread("sxy", dx * dy),
    ).filter("n > 0")


@dataclass(frozen=True)
class Moments:
    """The moment columns of a row; named fields keep the formulas readable."""

    mx: Column
    my: Column
    sxx: Column
    syy: Column
    sxy: Column

    @classmethod
    def of_row(cls) -> "Moments":
        return cls(*(F.col(c) for c in MOMENTS[1:]))

    @classmethod
    def of_struct(cls, moments: Column) -> "Moments":
        return cls(*(moments[c] for c in MOMENTS[1:]))


def ridge_line(m: Moments, reg_param: float) -> tuple[Column, Column]:
    """Minimiser ``(weight, intercept)`` of the penalised least squares objective.

    Objective: ``mean((w*x + b - y)^2) / 2 + reg/2 * (w^2 + b^2)``; the
    intercept is penalised like the weight.  Where the system is singular (no
    penalty and all features equal) the minimum-norm solution is taken.
    """
    lam = F.lit(float(reg_param))
    det = (1 + lam) * m.sxx + lam * (m.mx * m.mx + 1 + lam)
    singular = det == 0
    norm = m.mx * m.mx + 1
    weight = F.when(singular, m.mx * m.my / norm).otherwise(
        ((1 + lam) * m.sxy + lam * m.mx * m.my) / det
    )
    intercept = F.when(singular, m.my / norm).otherwise(
        ((m.sxx + lam) * m.my - m.mx * m.sxy) / det
    )
    return weight, intercept


def objective(m: Moments, weight: Column, intercept: Column, reg_param: float) -> Column:
    """Value of the objective at ``(weight, intercept)``."""
    bias = weight * m.mx + intercept - m.my
    spread = m.syy + weight * weight * m.sxx - 2 * weight * m.sxy
    penalty = (weight * weight + intercept * intercept) * (float(reg_param) / 2)
    return (spread + bias * bias) / 2 + penalty


def sgd_start(init_weight: float, intercept: bool) -> tuple[float, float]:
    """Where the descent starts: with an intercept, that starts at 1."""
    return float(init_weight), 1.0 if intercept else 0.0


def sgd_line(
    m: Moments,
    start: tuple[float, float],
    *,
    num_iterations: int,
    step_size: float,
    convergence_tol: float,
    reg_param: float,
    intercept: bool,
    at: Callable[[Column], Column] | None = None,
) -> Column:
    """Gradient descent as one folded expression over the moments.

    The gradient of the squared error depends on the rows only through their
    moments, so the iterations run on one row per group and never touch the
    data again.  The step at iteration ``t`` is ``step_size / sqrt(t)``.  Returns
    ``struct(w, b, iterations, done, losses)`` with the loss before every iteration.

    With ``at``, iteration ``t`` sees the struct of moments ``at(t)`` instead of ``m``; where
    that is null no row was drawn, and the iteration changes nothing and has no loss.
    """

    def state(w: Column, b: Column, iterations: Column, done: Column, losses: Column) -> Column:
        return F.struct(
            w.alias("w"),
            b.alias("b"),
            iterations.alias("iterations"),
            done.alias("done"),
            losses.alias("losses"),
        )

    def stepped(acc: Column, t: Column) -> Column:
        seen = m if at is None else Moments.of_struct(at(t))
        mxx = seen.sxx + seen.mx * seen.mx
        mxy = seen.sxy + seen.mx * seen.my
        w, b = acc["w"], acc["b"]
        eta = F.lit(float(step_size)) / F.sqrt(t.cast("double"))
        shrink = 1 - eta * float(reg_param)
        new_w = w * shrink - eta * (w * mxx + b * seen.mx - mxy)
        new_b = b * shrink - eta * (w * seen.mx + b - seen.my) if intercept else b
        moved = F.sqrt((new_w - w) * (new_w - w) + (new_b - b) * (new_b - b))
        size = F.sqrt(new_w * new_w + new_b * new_b)
        done = (t > 1) & (moved < F.greatest(size, F.lit(1.0)) * float(convergence_tol))
        losses = F.array_append(acc["losses"], objective(seen, w, b, reg_param))
        return state(new_w, new_b, t, done, losses)

    def next_state(acc: Column, t: Column) -> Column:
        if at is None:
            return F.when(acc["done"], acc).otherwise(stepped(acc, t))
        idle = state(acc["w"], acc["b"], t, acc["done"], acc["losses"])
        going = F.when(at(t).isNull(), idle).otherwise(stepped(acc, t))
        return F.when(acc["done"], acc).otherwise(going)

    none = F.array().cast("array<double>")
    begin = state(F.lit(start[0]), F.lit(start[1]), F.lit(0), F.lit(False), none)
    steps = F.sequence(F.lit(1), F.lit(int(num_iterations)))
    return F.aggregate(steps, begin, next_state)
