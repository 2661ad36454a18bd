"""Projection helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SUFFIX = {"left": "_l", "right": "_r"}


def with_side(df: DataFrame, side: str) -> DataFrame:
    """Every column renamed with its side's suffix, so joined rows need no aliases."""
    return df.select([F.col(c).alias(c + SUFFIX[side]) for c in df.columns])


def one_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the least one by ``order``, then by the other columns.

    A plain aggregate, so rows are reduced before they are shuffled.
    """
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    least = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return least.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(df.columns)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def only(pairs: DataFrame, condition: Column) -> DataFrame:
    """Pairs that satisfy a condition on columns that are worked out, or on a join, below it.

    An explode keeps the condition above them.  A filter would be pushed below
    and spell out each agreement wherever it is named, until the generated
    code is too long to compile.
    """
    return pairs.select("*", F.explode(F.when(condition, F.array(F.lit(True)))).alias("_kept")).drop("_kept")
