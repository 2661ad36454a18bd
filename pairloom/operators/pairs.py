"""Operators on tables of linked pairs ``(id_l, id_r, ...)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.session import staged

PAIR = ["id_l", "id_r"]


def best_key(links: DataFrame, key: str = "mkey", pair: list[str] = PAIR) -> DataFrame:
    """Each pair once with its lowest key; an aggregate, so pairs shrink before the shuffle."""
    return links.groupBy(*pair).agg(F.min(key).alias(key))


def latest(decisions: DataFrame, order: str = "load_no") -> DataFrame:
    """Rows of each pair's latest load; ties within a load all stay."""
    newest = decisions.groupBy(*PAIR).agg(F.max(order).alias(order))
    return decisions.join(newest, [*PAIR, order], "left_semi")


def with_id_counts(links: DataFrame) -> DataFrame:
    """How many pairs each person of either side is in.

    The pairs are read three times, so they are stored first.
    """
    stored = staged(links, "pairs")
    counts = [stored.groupBy(c).agg(F.count(F.lit(1)).alias(f"{c}_count")) for c in PAIR]
    return stored.join(counts[0], PAIR[0]).join(counts[1], PAIR[1]).select(*links.columns, *[f"{c}_count" for c in PAIR])


def agree(a: Column, b: Column) -> Column:
    """1 if both values are known and equal, else 0."""
    return F.when(a == b, 1).otherwise(0)
