"""Messages to tokens."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.functions.text import split_line

# Total order of tokens: where the message sits in its stream, then where the
# token sits in the message.
MESSAGE_POSITION = ("topic", "partition", "offset")
TOKEN_POSITION = MESSAGE_POSITION + ("pos",)


def message_values(messages: DataFrame) -> DataFrame:
    """Drop the key and read the value as text."""
    return messages.withColumn("value", F.col("value").cast("string")).drop("key")


def explode_tokens(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per token with its place ``pos``; all other columns are kept.

    A null value gives no row.
    """
    others = [c for c in messages.columns if c != value]
    return messages.select(*others, F.posexplode(split_line(F.col(value))).alias("pos", "token"))


def preview_tokens(
    tokens: DataFrame, n: int = 10, position: Sequence[str] = TOKEN_POSITION
) -> DataFrame:
    """The first ``n`` tokens in stream order."""
    return tokens.orderBy(*position).limit(n)


def count_tokens(tokens: DataFrame) -> DataFrame:
    """Occurrences per token; partial counts keep frequent tokens cheap."""
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
