"""Links by key and by score brought together, with a flag for clerical review."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.config import ACCEPT_ABOVE, CLERICAL_FROM, CLERICAL_KEYS
from pairloom.operators.columns import count_by
from pairloom.operators.pairs import PAIR, latest, with_id_counts

DECISION = [*PAIR, "match_status", "load_no"]


def automatic(links: DataFrame) -> DataFrame:
    """Links by keys that need no review."""
    return links.filter(~F.col("mkey").isin(*CLERICAL_KEYS))


def accepted_by_score(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("match_score") > ACCEPT_ABOVE)


def clerical_by_score(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("match_score").between(CLERICAL_FROM, ACCEPT_ABOVE))


def gold_pairs(links: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """Pairs taken as true: automatic links, overruled by later clerical decisions."""
    known = automatic(links).select(*PAIR, F.lit(1).alias("match_status"), F.lit(0).alias("load_no"))
    if decisions is not None:
        known = latest(known.unionByName(decisions.select(*DECISION)))
    return known.filter(F.col("match_status") == 1).select(*PAIR)


def combine(links: DataFrame, scored: DataFrame) -> DataFrame:
    """One row per linked pair: best score, lowest key, id counts and the clerical flag.

    Only scored pairs at or above the clerical threshold get here.  Of the
    flags a pair collects the lowest stands, until the rules below.
    """
    def part(df: DataFrame, score, key, flag: int) -> DataFrame:
        return df.select(*PAIR, key.alias("mkey"), score.alias("match_score"), F.lit(flag).alias("clerical"))

    no_key, no_score = F.lit(None).cast("int"), F.lit(None).cast("double")
    parts = (
        part(links, no_score, F.col("mkey"), 0)
        .unionByName(part(accepted_by_score(scored), F.col("match_score"), no_key, 0))
        .unionByName(part(clerical_by_score(scored), F.col("match_score"), no_key, 1))
    )
    pairs = parts.groupBy(*PAIR).agg(
        F.max("match_score").alias("match_score"), F.min("mkey").alias("mkey"), F.min("clerical").alias("clerical")
    )
    counted = with_id_counts(pairs)
    conflict = (F.col("id_l_count") > 1) | (F.col("id_r_count") > 1)
    flag = (
        F.when(F.col("mkey").isin(*CLERICAL_KEYS), 1)
        .when(conflict, 1)
        .when(F.col("mkey").isNotNull(), 0)
        .otherwise(F.col("clerical"))
    )
    return counted.select(*PAIR, "mkey", "match_score", flag.alias("clerical"), "id_l_count", "id_r_count")


def clerical(combined: DataFrame) -> DataFrame:
    return combined.filter(F.col("clerical") == 1)


def flag_counts(combined: DataFrame) -> DataFrame:
    return count_by(combined, "clerical")
