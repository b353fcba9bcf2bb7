"""Joins whose plan stays right when a side turns out large or skewed."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from streamlens.sources.scratch import settle

# Rows are at most a few hundred bytes wide where this bound is used, so a
# broadcast stays within some tens of megabytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024

# A key is hot if it holds one row in HOT_PARTS or more; there are at most
# HOT_PARTS such keys.
HOT_PARTS = 1000


def rows_and_bytes(df: DataFrame) -> tuple[int, int]:
    """Row count and an upper estimate of the in-memory size, by one aggregate."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    width = 16 + 16 * len(df.columns)
    length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(length.cast("long")), F.lit(0)).alias("text_bytes"),
    ).first()
    return row["rows"], row["rows"] * width + row["text_bytes"]


def fits_broadcast(df: DataFrame, max_bytes: int) -> bool:
    """Whether ``df`` is proven small enough to be copied to every executor."""
    return rows_and_bytes(df)[1] <= max_bytes


def aligned(small: DataFrame, big: DataFrame, on: Sequence[str]) -> DataFrame:
    """``small`` with its keys in the types of ``big``, so that equal keys hash alike.

    An integer that does not fit has no partner in ``big`` and becomes null.
    """
    for name in on:
        want, have = big.schema[name].dataType, small.schema[name].dataType
        if want == have:
            continue
        if not (isinstance(want, IntegralType) and isinstance(have, IntegralType)):
            raise TypeError(f"join key {name!r} is {have.simpleString()} on one side and"
                            f" {want.simpleString()} on the other; cast one of them")
        small = small.withColumn(name, F.col(name).try_cast(want))
    return small


def hot_keys(df: DataFrame, on: Sequence[str]) -> list[int]:
    """Hashes of the hot keys, from one pass with a sketch of fixed size.

    The sketch tracks ten times as many keys as can be hot, so none is missed.
    Its counts only decide where rows are sent, never what a join returns.
    """
    keys = df.select(F.xxhash64(*on).alias("key"))
    row = keys.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(key, {HOT_PARTS}, {10 * HOT_PARTS})").alias("top"),
    ).first()
    return [item["item"] for item in row["top"] if item["count"] * HOT_PARTS >= row["rows"]]


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str],
    hot: Sequence[int],
    *,
    fold: Callable[[DataFrame], DataFrame] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join by shuffle in which no ``hot`` key of ``big`` lands in one task.

    Hot keys are few, so their partners mostly prove small: they are broadcast
    to the hot rows, which then are not moved, and only the other rows are
    shuffled.

    If the partners of hot keys are not small, hot rows get a salt from
    ``salt_by`` and only those partners are repeated per salt.  ``fold`` then
    sums up rows that agree on key and salt columns, if there can be many.  The
    salt is a hash of row content, so a task that runs again after a lost
    executor puts its rows where they were.
    """
    small = aligned(small, big, on)
    if not hot:
        return big.join(small, list(on))
    is_hot = F.xxhash64(*on).isin(list(hot))
    few = small.filter(is_hot)
    if fits_broadcast(few, broadcast_bytes):
        moved = big.filter(~is_hot).join(small.filter(~is_hot), list(on))
        return moved.unionByName(big.filter(is_hot).join(F.broadcast(few), list(on)))
    salts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(is_hot, F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")).otherwise(0)
    repeats = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    left = (fold(big) if fold else big).withColumn("__salt", salt)
    right = small.withColumn("__salt", F.explode(repeats))
    return left.join(right, [*on, "__salt"]).drop("__salt")


def join_settled(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str],
    *,
    condition: Column | None = None,
    known_rows: int | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join of ``big`` with a ``small`` side of fixed row width.

    ``small`` is computed once and counted, unless an upper bound of its rows
    is already known.  Up to ``max_rows`` it is broadcast, so ``big`` is not
    moved at all.  Beyond, the join is a shuffle that spreads hot keys.
    """
    if known_rows is None:
        small, known_rows = settle(small)
    if known_rows <= max_rows:
        joined = big.join(F.broadcast(small), list(on))
    else:
        joined = spread_join(big, small, on, salt_by, hot_keys(big, on))
    return joined if condition is None else joined.filter(condition)
