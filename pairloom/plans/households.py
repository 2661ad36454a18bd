"""Cleaning of the two household files and the person sets they carry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.config import CODES_TO_NULL, NO_HOUSEHOLD, SET_DUMMY
from pairloom.functions import geography as geo, missing as mis
from pairloom.functions.address import flat_number, house_number
from pairloom.operators.columns import SUFFIX, with_side
from pairloom.plans.people import left_forms, moved_here, postcode_parts, right_forms

SETS = ["fn_set", "sn_set", "dob_set", "age_set"]
PLACES = ["address", "pc", "uprn", "house_no", "flat_no"]
LEFT_FIELDS = (
    ["hh_id", "qid", "response_id"] + PLACES + ["pc_sect", "pc_dist", "pc_area", "tenure", "typaccom", "no_resi", "hh_size"]
    + SETS
)
RIGHT_FIELDS = (
    ["hh_id", "qid"] + PLACES + ["pc_sect", "pc_dist", "pc_area", "tenure", "typaccom", "no_resi", "hh_size"] + SETS
    + [f"{p}_refday" for p in PLACES] + [f"{p}_intday" for p in PLACES] + ["country_refday"]
)


def dummies(side: str) -> dict:
    """The side's stand-ins for a missing set member, typed as the sets are."""
    d = SET_DUMMY[side]
    return {
        "fn_set": F.lit(d["name"]),
        "sn_set": F.lit(d["name"]),
        "dob_set": F.lit(d["dob"]).cast("date"),
        "age_set": F.lit(d["age"]).cast("int"),
    }


def person_sets(people: DataFrame, side: str) -> DataFrame:
    """Household size and the sorted distinct names, birth dates and ages of its people.

    The sets are aggregates, so each task sends on distinct values only, however
    many people one household id holds.  Coded and blank ids are no household:
    else all such people would share one row.
    """
    s = SUFFIX[side]
    dummy = dummies(side)
    member = {
        "fn_set": F.coalesce(F.col(f"fn1{s}"), dummy["fn_set"]),
        "sn_set": F.coalesce(F.col(f"sn1{s}"), dummy["sn_set"]),
        # a partly masked date is no date: it joins no set
        "dob_set": F.when(F.col(f"dob{s}").isNull(), dummy["dob_set"]).otherwise(
            F.try_to_date(F.col(f"dob{s}"), "yyyy-MM-dd")
        ),
        "age_set": F.coalesce(F.col(f"age{s}"), dummy["age_set"]),
    }
    members = people.filter(~F.trim(f"hh_id{s}").isin(*NO_HOUSEHOLD)).select(
        F.col(f"hh_id{s}").alias("hh_id"), F.col(f"id{s}").alias("id"), *[c.alias(name) for name, c in member.items()]
    )
    return members.groupBy("hh_id").agg(
        F.count_distinct("id").cast("int").alias("hh_size"),
        *[F.sort_array(F.collect_set(name)).alias(name) for name in SETS],
    )


def _answers(side: str):
    def coded(column: str, code_list: str, name: str):
        return mis.as_int(mis.code_to_null(F.col(column), CODES_TO_NULL[code_list])).alias(name)

    residents = "number_of_residents" if side == "left" else "resident_count"
    return [
        coded("ownership_type", f"{side}_tenure", "tenure"),
        coded("accommodation_type", f"{side}_accommodation", "typaccom"),
        coded(residents, f"{side}_residents", "no_resi"),
    ]


def _with_sets(households: DataFrame, people: DataFrame, side: str) -> DataFrame:
    dummy = dummies(side)
    joined = households.join(person_sets(people, side), "hh_id", "left")
    return joined.select(
        *[c for c in joined.columns if c not in SETS],
        *[mis.set_or_dummy(F.col(name), dummy[name]).alias(name) for name in SETS],
    )


def _numbers():
    return [house_number(F.col("address")).alias("house_no"), flat_number(F.col("address")).alias("flat_no")]


def _sectors():
    return [c.alias(name) for name, c in postcode_parts(F.col("pc")).items() if name != "pc_substr"]


def clean_left_households(households: DataFrame, forms: DataFrame, people: DataFrame) -> DataFrame:
    """``people`` are the cleaned left people."""
    own = households.select("qid", "response_id", F.col("household_id").alias("hh_id"), *_answers("left"))
    placed = own.join(left_forms(forms), "response_id", "left")
    placed = placed.select("*", *_sectors(), *_numbers())
    return with_side(_with_sets(placed, people, "left").select(*LEFT_FIELDS), "left")


def clean_right_households(households: DataFrame, forms: DataFrame, people: DataFrame) -> DataFrame:
    """``people`` are the cleaned right people; movers get their reference-day address."""
    codes = CODES_TO_NULL["address"]
    refday_address = mis.code_to_null(F.col("refday_address"), codes)
    own = households.select(
        "qid",
        F.col("household_id").alias("hh_id"),
        *_answers("right"),
        moved_here(F.col("refday_postcode"), F.col("refday_address")).alias("moved"),
        refday_address.alias("address_refday"),
        geo.clean_postcode(mis.code_to_null(F.col("refday_postcode"), codes)).alias("pc_refday"),
        mis.code_to_null(F.col("refday_uprn"), codes).alias("uprn_refday"),
        mis.code_to_null(F.col("refday_country"), codes).alias("country_refday"),
        house_number(refday_address).alias("house_no_refday"),
        flat_number(refday_address).alias("flat_no_refday"),
    )
    placed = own.join(right_forms(forms), "qid", "left").select("*", *_numbers())
    mover = F.col("moved") & ~F.equal_null(F.col("pc_refday"), F.col("pc"))
    placed = placed.select(
        *[c for c in placed.columns if c not in (*PLACES, "tenure", "typaccom", "moved")],
        *[F.col(c).alias(f"{c}_intday") for c in PLACES],
        *[F.when(mover, F.col(f"{c}_refday")).otherwise(F.col(c)).alias(c) for c in PLACES],
        # answers about the dwelling hold for the new home only
        *[F.when(~mover, F.col(c)).alias(c) for c in ("tenure", "typaccom")],
    )
    placed = placed.select("*", *_sectors())
    return with_side(_with_sets(placed, people, "right").select(*RIGHT_FIELDS), "right")
