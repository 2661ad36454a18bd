"""Candidate pairs by postcode and their Fellegi-Sunter match scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.config import (
    CLERICAL_FROM,
    DOB_CUTOFF,
    MAX_AGE_GAP,
    NAME_CUTOFF,
    NAME_FULL_AGREEMENT,
    PARTIAL_SLOPE,
    RESCUE_DOB,
    RESCUE_NAME_FLOOR,
    SCORE_VARIABLES,
)
from pairloom.functions.similarity import lev_score
from pairloom.operators.blocks import celled_join, same
from pairloom.operators.columns import SUFFIX, only
from pairloom.operators.mu import checked, weight_row

COMPARED = ["fn", "fn1", "sn", "sn1", "dob", "day", "mon", "year", "age", "sex"]
PLACES = {"left": ["pc", "pc_alt"], "right": ["pc_refday", "pc_intday", "pc_alt"]}
BLOCK = ("place",)


def located(people: DataFrame, side: str, extra: Sequence[str] = ()) -> DataFrame:
    """A row per person and known postcode, with all nicknames of the person together.

    A name with several nicknames has several rows in the cleaned file; here it
    is one person whose nickname agrees if any of them does.
    """
    s = SUFFIX[side]
    wanted = [c + s for c in dict.fromkeys(["id", *COMPARED, *extra])]
    places = F.array_compact(F.array_distinct(F.array(*[F.col(p + s) for p in PLACES[side]])))
    rows = people.select(*wanted, f"fn1_nickname{s}", places.alias(f"places{s}")).filter(F.size(f"places{s}") > 0)
    persons = rows.groupBy(*wanted, f"places{s}").agg(F.collect_set(f"fn1_nickname{s}").alias(f"nicknames{s}"))
    return persons.select("*", F.explode(f"places{s}").alias(f"place{s}"))


def met_once() -> Column:
    """The place at which a pair is kept: the least one it shares."""
    least_shared = F.array_min(F.array_intersect(F.col("places_l"), F.col("places_r")))
    # one postcode on both sides is the usual case and needs no set operation
    single = (F.size("places_l") == 1) | (F.size("places_r") == 1)
    return single | (F.col("place_l") == least_shared)


def candidates(left: DataFrame, right: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Pairs with a postcode in common, each once.

    All combinations of the two sides' postcodes are one join on the postcode.
    A pair that shares several is kept at the least of them only, so no
    distinct, and no shuffle of the pairs, is needed.
    """
    return celled_join(located(left, "left", extra), located(right, "right", extra), BLOCK, met_once())


def one_pass(left: DataFrame, right: DataFrame, left_pc: str, right_pc: str) -> DataFrame:
    """Distinct pairs that share one kind of postcode each.

    A person's postcodes are gathered first; a pair that shares several is kept at the least, so the pairs are never shuffled.
    """
    def places(people: DataFrame, pc: str, s: str) -> DataFrame:
        persons = people.groupBy(f"id{s}").agg(F.collect_set(pc + s).alias(f"places{s}"))
        return persons.select("*", F.explode(f"places{s}").alias(f"place{s}"))

    return celled_join(places(left, left_pc, "_l"), places(right, right_pc, "_r"), BLOCK, met_once()).select("id_l", "id_r")


# --------------------------------------------------------------------------- agreements
NAMES = {"fn1": "fn", "sn1": "sn"}


def with_name_scores(pairs: DataFrame, where: Column | None = None) -> DataFrame:
    """Similarities of first words and of whole names, computed once each; with ``where`` only of those pairs.

    Where both whole names are their first words, the whole names have no score of their own.
    """
    def score(c: str, of: Column | None) -> Column:
        found = lev_score(F.col(f"{c}_r"), F.col(f"{c}_l"))
        return found if of is None else F.when(of, found)

    scores = []
    for first, whole in NAMES.items():
        longer = (F.col(f"{whole}_l") != F.col(f"{first}_l")) | (F.col(f"{whole}_r") != F.col(f"{first}_r"))
        scores += [score(first, where).alias(f"_{first}_score"), score(whole, longer if where is None else where & longer).alias(f"_{whole}_score")]
    return pairs.select("*", *scores)


def name_agreement(first: str) -> Column:
    """The score of a name, raised to that of the whole name if higher; nearly equal counts as equal.

    An unknown first word is not raised: it stays unknown, which counts as 0.
    """
    by_first, by_whole = F.col(f"_{first}_score"), F.col(f"_{NAMES[first]}_score")
    best = F.when(by_whole > by_first, by_whole).otherwise(by_first)
    return F.coalesce(F.when(best > NAME_FULL_AGREEMENT, F.lit(1.0)).otherwise(best), F.lit(0.0))


def date_agreement() -> Column:
    """A third for each of day, month and year that agree."""
    def third(part: str) -> Column:
        return F.when(same(part), F.lit(1 / 3)).otherwise(F.lit(0.0))

    return third("day") + third("mon") + third("year")


def age_gap() -> Column:
    return F.abs(F.col("age_r") - F.col("age_l"))


def rescued_date(agreement: Column) -> Column:
    """Partial agreement for strong candidates whose birth date is missing but whose ages are near."""
    strong = (
        (F.col("fn1_agreement") > RESCUE_NAME_FLOOR)
        & (F.col("sn1_agreement") > RESCUE_NAME_FLOOR)
        & same("sex")
        & (F.col("dob_l").isNull() | F.col("dob_r").isNull())
    )
    chosen = F
    for gap, value in RESCUE_DOB:
        chosen = chosen.when(strong & (age_gap() < gap), F.lit(value))
    return chosen.otherwise(agreement)


def cut(agreement: Column, at: float) -> Column:
    """Zero at or below the cut-off."""
    return F.when(agreement <= at, F.lit(0.0)).otherwise(agreement)


def too_far() -> Column:
    """Known ages further apart than any match: such a pair scores 0, whatever else agrees."""
    return F.coalesce(age_gap() > MAX_AGE_GAP, F.lit(False))


def with_agreements(pairs: DataFrame) -> DataFrame:
    """Adds ``fn1_agreement, sn1_agreement, sex_agreement, dob_agreement``."""
    nickname = F.arrays_overlap(F.col("nicknames_l"), F.col("nicknames_r"))
    first = F.when(nickname, F.lit(1.0)).otherwise(name_agreement("fn1"))
    named = with_name_scores(pairs).select(
        *pairs.columns, first.alias("fn1_agreement"), name_agreement("sn1").alias("sn1_agreement"),
        F.when(same("sex"), F.lit(1.0)).otherwise(F.lit(0.0)).alias("sex_agreement"),
    )
    dated = named.select("*", cut(rescued_date(date_agreement()), DOB_CUTOFF).alias("dob_agreement"))
    return dated.select(
        *pairs.columns,
        *[cut(F.col(f"{v}_agreement"), NAME_CUTOFF).alias(f"{v}_agreement") for v in ("fn1", "sn1")],
        "sex_agreement", "dob_agreement",
    )


# ------------------------------------------------------------------------------- weights
def weight(variable: str, of: Column) -> Column:
    """Weight of an agreement: full, sloping down to that of a disagreement, or none if a value is missing."""
    agreement = F.col(f"{variable}_agreement")
    yes, no = of[f"{variable}_agreement_weight"], of[f"{variable}_disagreement_weight"]
    sloped = F.greatest(yes - (yes - no) * (1 - agreement) * PARTIAL_SLOPE, no)
    missing = F.col(f"{variable}_l").isNull() | F.col(f"{variable}_r").isNull()
    return F.when(missing & (agreement == 0), F.lit(0.0)).when(agreement < 1, sloped).otherwise(yes)


#: Shares of agreement this near to 0 or 1 are taken as this far from them.
LEAST_SHARE = 1e-9


def scored(pairs: DataFrame, m: DataFrame, u: DataFrame, least: float | None = LEAST_SHARE) -> DataFrame:
    """Candidate pairs with agreements, weights and ``match_score``.

    The weights are one row and enter as a scalar subquery: computed once, then
    a literal in every task.  ``least`` as in ``weight_row``; a weight that is
    missing all the same is an error, not a lost score.
    """
    row = checked(weight_row(m, u, least=least))
    weights = row.select(F.struct(*row.columns).alias("weights")).scalar()
    agreed = with_agreements(pairs).select("*", weights.alias("_weights"))
    weighed = agreed.select(
        *[c for c in agreed.columns if c != "_weights"],
        *[F.col("_weights")[c].alias(c) for c in row.columns],
        *[weight(v, F.col("_weights")).alias(f"{v}_weight") for v in SCORE_VARIABLES],
    )
    total = F.col("fn1_weight") + F.col("sn1_weight") + F.col("dob_weight") + F.col("sex_weight")
    return weighed.withColumn("match_score", F.when(too_far(), F.lit(0.0)).otherwise(total))


def score_people(left: DataFrame, right: DataFrame, m: DataFrame, u: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Scored candidate pairs of two cleaned files; ``extra`` columns of both are carried along."""
    return scored(candidates(left, right, extra), m, u)


def near_candidates(left: DataFrame, right: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The candidate pairs that are not ``too_far``; the others never meet."""
    return _near(located(left, "left", extra), located(right, "right", extra))


def _near(left: DataFrame, right: DataFrame) -> DataFrame:
    """``near_candidates`` of two located sides.

    People of one place meet under a band of age.  The left person has one
    band, the right one all that ages within ``MAX_AGE_GAP`` may be in; people
    whose age is unknown meet all.  No two people share more than one sign.
    """
    def banded(people: DataFrame, side: str) -> DataFrame:
        age = F.col("age" + SUFFIX[side])

        def band(shift: int) -> Column:
            return F.floor((age + shift) / MAX_AGE_GAP).cast("string")

        signs = {
            "left": ([band(0), F.lit("known l")], [F.lit("unknown l")]),
            "right": (
                [*[band(n * MAX_AGE_GAP) for n in (-1, 0, 1)], F.lit("unknown l")], [F.lit("known l"), F.lit("unknown l")]
            ),
        }
        known, unknown = (F.array(*of) for of in signs[side])
        return people.select("*", F.explode(F.when(age.isNull(), unknown).otherwise(known)).alias("near" + SUFFIX[side]))

    sides = banded(left, "left"), banded(right, "right")
    return celled_join(*sides, (*BLOCK, "near"), ~too_far() & met_once()).drop("near_l", "near_r")


def far_scores(left: DataFrame, right: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``(id_l, id_r, match_score)``, and ``extra`` of both, of the candidate pairs that are ``too_far``: 0.

    Such pairs are met by ids and ages alone.
    """
    return _far(located(left, "left", extra), located(right, "right", extra), extra)


def _far(left: DataFrame, right: DataFrame, extra: Sequence[str]) -> DataFrame:
    """``far_scores`` of two located sides."""
    def narrow(persons: DataFrame, s: str) -> DataFrame:
        wanted = dict.fromkeys(["id", "age", *extra, "places", "place"])
        return persons.select(*[c + s for c in wanted]).dropna(subset=["age" + s])

    far = celled_join(narrow(left, "_l"), narrow(right, "_r"), BLOCK, too_far() & met_once())
    return far.select(*_both_sides(extra), F.lit(0.0).alias("match_score"))


def _both_sides(extra: Sequence[str]) -> list[str]:
    return [c + s for c in ("id", *extra) for s in SUFFIX.values()]


def near_scores(left: DataFrame, right: DataFrame, m: DataFrame, u: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``(id_l, id_r, match_score)``, and ``extra`` of both, of the candidate pairs that are not too far apart in age."""
    return scored(near_candidates(left, right, extra), m, u).select(*_both_sides(extra), "match_score")


def match_scores(left: DataFrame, right: DataFrame, m: DataFrame, u: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``(id_l, id_r, match_score)``, and ``extra`` of both, of all candidate pairs: what the band profile reads.

    Pairs too far apart in age need no names.
    """
    sides = located(left, "left", extra), located(right, "right", extra)
    near = scored(_near(*sides), m, u).select(*_both_sides(extra), "match_score")
    return near.unionByName(_far(*sides, extra))


def likely_scores(left: DataFrame, right: DataFrame, m: DataFrame, u: DataFrame) -> DataFrame:
    """The rows of ``match_scores`` that combining reads: those a clerk would see, or better.

    ``CLERICAL_FROM`` is above 0, the score of a pair too far apart in age.
    """
    return only(near_scores(left, right, m, u), F.col("match_score") >= CLERICAL_FROM)
