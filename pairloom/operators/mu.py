"""Agreement probabilities of matched (m) and of randomly paired (u) records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.config import SCORE_VARIABLES
from pairloom.operators.columns import SUFFIX
from pairloom.operators.numbering import numbered, shuffled_order
from pairloom.operators.pairs import agree


def _as_rows(wide: DataFrame, values: Sequence[str], name: str) -> DataFrame:
    """One row per variable from a one-row table with a column per variable."""
    return wide.unpivot([], list(values), "variable", name)


def records_of(pairs: DataFrame, left: DataFrame, right: DataFrame, variables: Sequence[str] = SCORE_VARIABLES) -> DataFrame:
    """The variables of both records of every pair."""
    wanted_left = left.select("id_l", *[f"{v}_l" for v in variables])
    wanted_right = right.select("id_r", *[f"{v}_r" for v in variables])
    return pairs.select("id_l", "id_r").join(wanted_right, "id_r").join(wanted_left, "id_l")


def agreement_counts(records: DataFrame, variables: Sequence[str] = SCORE_VARIABLES) -> DataFrame:
    """Pairs that agree exactly, per variable, and all pairs, in one row."""
    agreed = [F.sum(agree(F.col(f"{v}_l"), F.col(f"{v}_r"))).alias(v) for v in variables]
    return records.agg(*agreed, F.count(F.lit(1)).alias("pairs"))


def m_values(gold: DataFrame, left: DataFrame, right: DataFrame, variables: Sequence[str] = SCORE_VARIABLES) -> DataFrame:
    """``(variable, m_value)``: share of gold pairs that agree exactly; a missing value disagrees."""
    counts = agreement_counts(records_of(gold, left, right, variables), variables)
    shares = counts.select([F.try_divide(F.col(v), F.col("pairs")).alias(v) for v in variables])
    return _as_rows(shares, variables, "m_value")


def _known_so_far(variables: Sequence[str], upto: int, sides: Sequence[str]) -> Column:
    known = [F.col(v + s).isNotNull() for v in variables[: upto + 1] for s in sides]
    return reduce(lambda a, b: a & b, known)


def random_pairs(
    left: DataFrame, right: DataFrame, variables: Sequence[str] = SCORE_VARIABLES, seed: str = "u"
) -> DataFrame:
    """Both files in a seeded random order, paired by position; the longer one's tail stays unpaired and is never sorted."""
    shorter = F.least(*[df.select(F.count(F.lit(1)).alias("n")).scalar() for df in (left, right)])

    def placed(df: DataFrame, s: str) -> DataFrame:
        wanted = df.select(f"id{s}", f"fn1_nickname{s}", *[v + s for v in variables])
        return numbered(wanted, shuffled_order(F.col(f"id{s}"), seed + s), [f"fn1_nickname{s}"], "place", shorter)

    return placed(left, "_l").join(placed(right, "_r"), "place").drop("place")


def u_values(left: DataFrame, right: DataFrame, variables: Sequence[str] = SCORE_VARIABLES, seed: str = "u") -> DataFrame:
    """``(variable, u_value)`` from random pairs.

    Each variable looks at the pairs where it and all variables before it are known.
    """
    paired = random_pairs(left, right, variables, seed)
    sides = tuple(SUFFIX.values())
    shares = []
    for i, v in enumerate(variables):
        known = _known_so_far(variables, i, sides)
        same = F.count_if(known & (F.col(f"{v}_l") == F.col(f"{v}_r")))
        shares.append(F.try_divide(same, F.count_if(known)).alias(v))
    return _as_rows(paired.agg(*shares), variables, "u_value")


def exact_u_values(left: DataFrame, right: DataFrame, variables: Sequence[str] = SCORE_VARIABLES) -> DataFrame:
    """``(variable, u_value)``: the chance that two records drawn at random agree.

    The expectation of ``u_values``: value counts of each side, joined by value.
    A frequent value is one row per side, however many people have it.
    """
    def value_counts(df: DataFrame, s: str) -> DataFrame:
        values = [
            F.struct(F.lit(v).alias("variable"), F.when(_known_so_far(variables, i, [s]), F.col(v + s).cast("string")).alias("value"))
            for i, v in enumerate(variables)
        ]
        rows = df.select(F.explode(F.array(*values)).alias("x")).select("x.*").dropna()
        return rows.groupBy("variable", "value").agg(F.count(F.lit(1)).cast("double").alias("n"))

    counts_l, counts_r = value_counts(left, "_l"), value_counts(right, "_r")
    joined = counts_l.withColumnRenamed("n", "n_l").join(counts_r.withColumnRenamed("n", "n_r"), ["variable", "value"])
    agreeing = joined.groupBy("variable").agg(F.sum(F.col("n_l") * F.col("n_r")).alias("same"))
    totals_l = counts_l.groupBy("variable").agg(F.sum("n").alias("all_l"))
    totals_r = counts_r.groupBy("variable").agg(F.sum("n").alias("all_r"))
    rates = totals_l.join(totals_r, "variable").join(agreeing, "variable", "left")
    return rates.select(
        "variable", F.try_divide(F.coalesce(F.col("same"), F.lit(0.0)), F.col("all_l") * F.col("all_r")).alias("u_value")
    )


def weight_row(
    m: DataFrame, u: DataFrame, variables: Sequence[str] = SCORE_VARIABLES, least: float | None = None
) -> DataFrame:
    """One row: per variable its m and u and the weights of agreement and disagreement.

    A share of 0 or 1, as a small sample may give, has no finite weight.  With
    ``least`` shares are kept within ``least`` and ``1 - least``, so no pair
    loses its score; without it such a weight is NULL, and :func:`checked` refuses it.
    """
    both = m.join(u, "variable")

    def value(variable: str, column: str) -> Column:
        share = F.max(F.when(F.col("variable") == variable, F.col(column)))
        if least is None:
            return share
        return F.when(share.isNotNull(), F.least(F.greatest(share, F.lit(least)), F.lit(1 - least)))

    one = both.agg(
        *[value(v, "m_value").alias(f"{v}_m") for v in variables], *[value(v, "u_value").alias(f"{v}_u") for v in variables]
    )
    weights = []
    for v in variables:
        mv, uv = F.col(f"{v}_m"), F.col(f"{v}_u")
        weights.append(F.log2(F.try_divide(mv, uv)).alias(f"{v}_agreement_weight"))
        weights.append(F.log2(F.try_divide(1 - mv, 1 - uv)).alias(f"{v}_disagreement_weight"))
    return one.select(*weights)


def checked(weights: DataFrame) -> DataFrame:
    """The row of weights, or an error if one is missing: scores would silently be missing with it."""
    def known(name: str) -> Column:
        stop = F.raise_error(F.lit(f"no {name}: an m or u value is 0, 1 or missing; pass least to weight_row")).cast("double")
        return F.coalesce(F.col(name), stop).alias(name)

    return weights.select(*[known(c) for c in weights.columns])
