"""Linking households by ordered keys over person sets, dwelling answers and addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions import sets as st
from pairloom.operators.blocks import hot_blocks, same
from pairloom.operators.columns import SUFFIX, count_by
from pairloom.operators.keys import Key, Route, any_of, block_keys, single_key
from pairloom.operators.pairs import best_key

HH_PAIR = ["hh_id_l", "hh_id_r"]
CARRIED = [
    "hh_id", "typaccom", "tenure", "no_resi", "fn_set", "sn_set", "dob_set", "age_set", "hh_size", "pc", "pc_sect",
    "uprn", "house_no", "flat_no",
]


def with_people(households: DataFrame, side: str) -> DataFrame:
    """Households that have people, with the columns keys look at."""
    s = SUFFIX[side]
    return households.filter(F.col(f"hh_size{s}").isNotNull()).select([c + s for c in CARRIED])


# ------------------------------------------------------------------------------- rules
def _sets(name: str) -> tuple[str, str]:
    return f"{name}_set_l", f"{name}_set_r"


def share(name: str) -> Column:
    left, right = _sets(name)
    return st.shares(F.col(left), F.col(right))


def share_ages() -> Column:
    left, right = _sets("age")
    return st.shares_age(F.col(left), F.col(right))


def alike(name: str, threshold: float) -> Column:
    left, right = _sets(name)
    return st.max_lev_above(F.col(left), F.col(right), threshold)


def sound_alike(name: str, threshold: float) -> Column:
    return st.max_jaro_above(*_sets(name), threshold)


def shared_dobs() -> Column:
    left, right = _sets("dob")
    return st.common(F.col(left), F.col(right))


def both_sized(n: int) -> Column:
    return (F.col("hh_size_l") == n) & (F.col("hh_size_r") == n)


def two_answers_agree() -> Column:
    answers = ("tenure", "typaccom", "no_resi")
    return any_of([same(a, b) for i, a in enumerate(answers) for b in answers[i + 1:]])


def enough_dobs(big: int) -> Column:
    """Households that share a birth date need two if both hold ``big`` people or more."""
    both_big = (F.col("hh_size_l") >= big) & (F.col("hh_size_r") >= big)
    return ~((shared_dobs() == 1) & both_big)


def no_flats() -> Column:
    return F.col("flat_no_l").isNull() & F.col("flat_no_r").isNull()


def any_member_shared() -> Column:
    return any_of([share("fn"), share("dob"), share("sn")])


def two_kinds_shared() -> Column:
    by_first_name = share("fn") & (share("sn") | share("dob") | share_ages())
    by_last_name = share("sn") & (share("dob") | share("age"))
    return by_first_name | by_last_name


def names(test, first: float, last: float) -> Column:
    return test("fn", first) & test("sn", last)


def a_name(test, threshold: float) -> Column:
    return test("fn", threshold) | test("sn", threshold)


ANSWERS = ("tenure", "typaccom", "no_resi")

KEYS: tuple[Key, ...] = (
    Key(1, (("uprn", "dob_member"),), lambda: share("fn") & share("sn")),
    Key(2, (("uprn", *ANSWERS),), lambda: share("fn") | share("sn")),
    Key(3, (("uprn", "dob_member"),), lambda: two_answers_agree() & (share("fn") | share("sn"))),
    Key(4, (("uprn", "dob_member"),), lambda: share("sn")),
    Key(5, (("uprn", "dob_member"),), lambda: names(alike, 0.80, 0.80)),
    Key(6, (("uprn", "dob_member"),), lambda: names(sound_alike, 0.80, 0.80)),
    Key(7, (("uprn", *ANSWERS, "dob_member"),), lambda: enough_dobs(4) & names(alike, 0.60, 0.60)),
    Key(8, (("uprn", *ANSWERS, "dob_member"),), lambda: enough_dobs(4) & names(sound_alike, 0.60, 0.60)),
    Key(9, (("uprn", *ANSWERS, "dob_member"),), lambda: a_name(alike, 0.80)),
    Key(10, (("uprn", "dob_set"),), lambda: both_sized(1) & two_answers_agree() & a_name(alike, 0.50)),
    Key(11, (("uprn", "dob_set"),), lambda: both_sized(1) & two_answers_agree() & a_name(sound_alike, 0.60)),
    Key(12, (("uprn",),), lambda: both_sized(1) & two_answers_agree() & a_name(alike, 0.80)),
    Key(13, (("uprn",),), lambda: both_sized(1) & two_answers_agree() & a_name(sound_alike, 0.90)),
    Key(14, (("pc", "dob_member"),), lambda: share("fn") & share("sn")),
    Key(15, (("pc", *ANSWERS, "fn_member"),), lambda: share("sn")),
    Key(16, (("pc", "dob_member"),), lambda: two_answers_agree() & (share("fn") | share("sn"))),
    Key(17, (("pc", *ANSWERS, "dob_member"),), lambda: enough_dobs(3) & a_name(alike, 0.80)),
    Key(18, (("pc", *ANSWERS, "dob_member"),), lambda: enough_dobs(3) & a_name(sound_alike, 0.80)),
    Key(19, (("pc", "sn_set", "fn_set"),)),
    Key(20, (("pc", "house_no", "fn_member"),), lambda: two_answers_agree() & share("sn") & share_ages()),
    Key(21, (("uprn",),), two_kinds_shared),
    Key(22, (("uprn", "hh_size"),), lambda: names(sound_alike, 0.80, 0.80)),
    Key(23, (("pc_sect", "house_no", "hh_size"),), lambda: share("fn") & share("sn") & (shared_dobs() >= 2)),
    Key(24, (("uprn", "age_set", "hh_size"),)),
    Key(25, (("pc", "flat_no", "house_no", "hh_size"),), any_member_shared),
    Key(26, (("pc", "flat_no", "hh_size", "dob_member"),), lambda: share("fn")),
    Key(27, (("pc", "flat_no", "hh_size", "dob_member"),), lambda: share("sn")),
    Key(28, (("uprn",),), lambda: both_sized(1) & any_member_shared()),
    Key(29, (("pc", "house_no"),), lambda: both_sized(1) & any_member_shared()),
    Key(30, (("uprn",),), lambda: no_flats() & share_ages() & names(sound_alike, 0.80, 0.70)),
    Key(31, (("pc", "house_no"),), lambda: no_flats() & share_ages() & names(sound_alike, 0.80, 0.70)),
)
BY_NUMBER = {k.number: k for k in KEYS}

#: A dwelling is small, a postcode is not: there households meet by something they hold besides.
BLOCKS: dict[Route, tuple[int, ...]] = {
    ("uprn",): (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 21, 22, 24, 28, 30),
    ("pc", "dob_member"): (14, 16, 17, 18, 26, 27),
    ("pc", "fn_member"): (15, 20),
    ("pc", "house_no"): (25, 29, 31),
    ("pc", "sn_set", "fn_set"): (19,),
    ("pc_sect", "house_no"): (23,),
}


def household_key_pairs(left: DataFrame, right: DataFrame, number: int) -> DataFrame:
    """Distinct household pairs that one key links.  ``left`` and ``right`` are cleaned households."""
    return single_key(with_people(left, "left"), with_people(right, "right"), BY_NUMBER[number], HH_PAIR)


def link_households(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(hh_id_l, hh_id_r, hkey)``: every household pair any key links, with its lowest key."""
    left, right = with_people(left, "left"), with_people(right, "right")
    blocks = {block: [BY_NUMBER[n] for n in numbers] for block, numbers in BLOCKS.items()}
    linked = block_keys(left, right, blocks, HH_PAIR, "hkey", hot=hot_blocks(left, right, list(blocks)))
    return best_key(reduce(DataFrame.unionByName, linked), "hkey", HH_PAIR)


def household_key_counts(links: DataFrame) -> DataFrame:
    return count_by(links, "hkey")
