"""Tokens to ``(label, feature)`` samples, with a policy for malformed ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.functions.text import cast_number, is_finite, java_number

VERDICTS = ("ok", "no feature", "bad label", "bad feature")


def parse_tokens(tokens: DataFrame, token: str = "token") -> DataFrame:
    """Add ``label``, ``feature`` and ``verdict`` to every token; no row is lost.

    A token reads ``label,feature``; parts after the second are ignored and a
    missing or empty second part means there is no feature.
    """
    whole = F.col(token)
    parts = tokens.select(
        *tokens.columns,
        F.substring_index(whole, ",", 1).alias("__first"),
        F.when(
            F.contains(whole, F.lit(",")),
            F.substring_index(F.substring_index(whole, ",", 2), ",", -1),
        ).alias("__second"),
    )
    first, second = F.col("__first"), F.col("__second")
    paired = F.coalesce(second, F.lit("")) != ""
    numbers = parts.withColumns(
        {
            "__paired": paired,
            "__label": F.when(paired, cast_number(first)),
            "__feature": F.when(paired, cast_number(second)),
        }
    )
    read = numbers.withColumns(
        {
            "__label": java_number(F.col("__label"), first),
            "__feature": java_number(F.col("__feature"), second),
        }
    )
    verdict = (
        F.when(~F.col("__paired"), F.lit("no feature"))
        .when(F.col("__label").isNull(), F.lit("bad label"))
        .when(F.col("__feature").isNull(), F.lit("bad feature"))
        .otherwise(F.lit("ok"))
    )
    # A filter on plain computed columns is moved below them by repeating their
    # expressions, so every token would be cut and read again for each use.
    # Filters stop at a generator: one row in, the same row out, parsed once.
    once = F.struct(
        F.col("__label").alias("label"),
        F.col("__feature").alias("feature"),
        verdict.alias("verdict"),
    )
    return read.select(*tokens.columns, F.inline(F.array(once)))


def well_formed(parsed: DataFrame, token: str = "token") -> DataFrame:
    """Samples of the tokens that parsed."""
    return parsed.filter(F.col("verdict") == "ok").drop(token, "verdict")


def malformed(parsed: DataFrame) -> DataFrame:
    """Tokens that did not parse, with the reason in ``verdict``."""
    return parsed.filter(F.col("verdict") != "ok").drop("label", "feature")


def fail_on_malformed(parsed: DataFrame, token: str = "token") -> DataFrame:
    """Samples; the first malformed token met fails the job."""
    message = F.concat(F.lit("malformed token ("), F.col("verdict"), F.lit("): "), F.col(token))

    def checked(value: str) -> Column:
        failed = F.raise_error(message).cast("double")
        return F.when(F.col("verdict") == "ok", F.col(value)).otherwise(failed)

    return (
        parsed.withColumn("label", checked("label"))
        .withColumn("feature", checked("feature"))
        .drop(token, "verdict")
    )


def parse_samples(
    tokens: DataFrame, on_malformed: str = "fail", token: str = "token"
) -> tuple[DataFrame, DataFrame | None]:
    """``(samples, quarantined)``; the second is None unless asked for."""
    parsed = parse_tokens(tokens, token)
    if on_malformed == "fail":
        return fail_on_malformed(parsed, token), None
    if on_malformed == "drop":
        return well_formed(parsed, token), None
    if on_malformed == "quarantine":
        return well_formed(parsed, token), malformed(parsed)
    raise ValueError(f"unknown policy {on_malformed!r}")


def finite_samples(samples: DataFrame) -> DataFrame:
    """Samples fit for a model: NaN or an infinity would poison every moment."""
    return samples.filter(is_finite(F.col("label")) & is_finite(F.col("feature")))
