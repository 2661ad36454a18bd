"""Cleaning of the two person files.

The left file is the large one, the right file the survey.  Both go through
the same standardisation; they differ in how an address is found and in the
moves that only the survey asks about.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from pairloom.config import (
    AWAY_AT_TERM,
    CODES_TO_BLANK,
    CODES_TO_NULL,
    DATE_MASK,
    FULL_TIME,
    NO_ADDRESS_GIVEN,
)
from pairloom.functions import geography as geo, missing as mis, names as nm
from pairloom.functions.address import house_number
from pairloom.operators.columns import one_per_key, with_side

NAME_FIELDS = [
    "forenames", "last_name", "fn", "sn", "fn1", "fn2", "sn1", "sn2", "fn1_nickname",
    "fullname", "fullname_ns", "alphaname",
    "res_fn", "res_fn1", "res_fn2", "res_sn", "res_sn1", "res_sn2",
]
BIRTH_FIELDS = ["day", "mon", "year", "dob", "age"]
PLACE_FIELDS = ["address", "pc", "pc_sect", "pc_dist", "pc_area", "uprn", "house_no", "pc_substr"]
ALT_FIELDS = ["address_alt", "pc_alt", "uprn_alt", "house_no_alt"]
CODED_FIELDS = ["sex", "marital_status", "ethnic5", "ethnic19"]

LEFT_FIELDS = (
    ["id", "hh_id", "qid", "response_id", "ce_id"] + NAME_FIELDS + BIRTH_FIELDS + PLACE_FIELDS + ALT_FIELDS
    + ["pc_1y"] + CODED_FIELDS + ["mode"]
)
REFDAY_FIELDS = ["address_refday", "pc_refday", "uprn_refday", "house_no_refday"]
INTDAY_FIELDS = ["address_intday", "pc_intday", "uprn_intday", "house_no_intday"]
RIGHT_FIELDS = (
    ["id", "hh_id", "qid", "residence_type", "ce_id"] + NAME_FIELDS + BIRTH_FIELDS + ["estimate_age"] + PLACE_FIELDS
    + REFDAY_FIELDS + INTDAY_FIELDS + ["la", "region"] + ALT_FIELDS + CODED_FIELDS + ["mode", "htcw"]
)


class CleanPeople(NamedTuple):
    people: DataFrame
    students: DataFrame
    removed: DataFrame | None = None


# --------------------------------------------------------------------- standardisation
def standardise(raw: DataFrame, side: str) -> DataFrame:
    """Names, sex, birth date, age, alternative address and coded answers of raw residents."""
    upper = raw.select(
        F.col("resident_id").alias("id"),
        F.col("household_id").alias("hh_id"),
        *[c for c in ("qid", "response_id", "residence_type", "ce_id", "mode") if c in raw.columns],
        *[
            F.upper(mis.code_to_blank(F.col(c), CODES_TO_BLANK["name"])).alias(c)
            for c in ("first_name", "middle_name", "last_name")
        ],
        *[
            F.upper(mis.code_to_blank(F.col(c), CODES_TO_BLANK["resident_name"])).alias(c)
            for c in ("resident_first_name", "resident_last_name")
        ],
        *_birth(raw, side),
        mis.digits_int(mis.code_to_null(F.col("sex"), CODES_TO_NULL["sex"])).alias("sex"),
        *_alternative_address(),
        *[
            mis.coded_int(F.col(c)).alias(c)
            for c in ("marital_status", "ethnic5", "ethnic19", "in_full_time_education", "is_hh_term_time_address")
        ],
        *_side_only(raw, side),
    )
    named = upper.withColumn("forenames", nm.forenames(F.col("first_name"), F.col("middle_name"))).withColumn(
        "fullname", nm.full_name(F.col("forenames"), F.col("last_name"))
    )
    sources = {"fn": "forenames", "sn": "last_name", "res_fn": "resident_first_name", "res_sn": "resident_last_name"}
    # words are split once per name and letters stripped once; the parts are picked in the next step
    worded = named.select(
        *[c for c in named.columns if not c.startswith("resident_") and c not in ("first_name", "middle_name")],
        *[nm.name_words(F.col(source)).alias(f"{prefix}_words") for prefix, source in sources.items()],
        *[nm.clean_names_nospace(F.col(source)).alias(prefix) for prefix, source in sources.items()],
        nm.clean_names_nospace(F.col("fullname")).alias("fullname_ns"),
    )
    picked = {"alphaname": nm.alpha(F.col("fullname_ns"))}
    for prefix in sources:
        for position in (0, 1):
            picked[f"{prefix}{position + 1}"] = F.get(f"{prefix}_words", F.lit(position))
    picked |= {c: F.col(c) for c in ("forenames", "last_name", "fullname", "fullname_ns", *sources)}
    kept = [c for c in worded.columns if c not in picked and not c.endswith("_words")]
    return worded.select(*kept, *[mis.blank_to_null(c).alias(name) for name, c in picked.items()])


def _birth(raw: DataFrame, side: str):
    mask = DATE_MASK[side]
    raw_dob = F.col("full_dob")
    if side == "right":
        raw_dob = F.replace(raw_dob, F.lit(DATE_MASK["left"]), F.lit(mask))
    age = mis.blank_to_null(mis.code_to_blank(F.col("resident_age"), CODES_TO_BLANK["age"]))
    if side == "right":
        birthday = mis.code_to_blank(F.col("resident_age_last_birthday"), CODES_TO_BLANK["age_last_birthday"])
        age = F.coalesce(age, birthday)
    parts = geo.birth_parts(raw_dob, mask)
    return [c.alias(name) for name, c in parts.items()] + [mis.as_int(age).alias("age")]


def _alternative_address():
    codes = CODES_TO_NULL["address"]
    address = mis.code_to_null(F.col("alternative_address"), codes)
    postcode = mis.code_to_null(F.col("alternative_address_postcode"), codes)
    return [
        address.alias("address_alt"),
        geo.clean_postcode(postcode).alias("pc_alt"),
        mis.code_to_null(F.col("alternative_address_uprn"), codes).alias("uprn_alt"),
        house_number(address).alias("house_no_alt"),
    ]


def _side_only(raw: DataFrame, side: str):
    if side == "left":
        year_ago = mis.code_to_null(F.col("one_year_ago_postcode"), CODES_TO_NULL["address"])
        return [geo.clean_postcode(year_ago).alias("pc_1y")]
    return [mis.code_to_null(F.col("estimate_age"), CODES_TO_NULL["estimate_age"]).alias("estimate_age")]


def with_nickname(people: DataFrame, nicknames: DataFrame) -> DataFrame:
    """Nickname of the first forename; a name with several meanings gives a row for each.

    No broadcast hint: Spark broadcasts the list when its size allows.
    """
    lookup = nicknames.select(F.col("in_name").alias("fn1"), mis.blank_to_null(F.col("out_name")).alias("fn1_nickname"))
    return people.join(lookup, "fn1", "left")


def postcode_parts(pc) -> dict:
    sector = geo.postcode_sector(pc)
    return {
        "pc_sect": sector,
        "pc_dist": geo.postcode_district(sector),
        "pc_area": geo.postcode_area(sector),
        "pc_substr": nm.remove_final_char(pc),
    }


# ----------------------------------------------------------------------------- addresses
def _known_form_fields(forms: DataFrame) -> DataFrame:
    """Codes of a form as NULL.  A coded uprn counts as missing too, else all its people would share one."""
    codes = CODES_TO_NULL["address"]
    return forms.select(
        [mis.code_to_null(F.col(c), codes).alias(c) if c not in ("qid", "response_id") else F.col(c) for c in forms.columns]
    )


def left_forms(forms: DataFrame) -> DataFrame:
    """Distinct address forms of the left file: address, else raw address, else display address."""
    wanted = ["response_id", "display_address", "address_raw", "address", "address_postcode", "uprn"]
    known = _known_form_fields(forms.select(*wanted).distinct())
    address = F.coalesce(F.col("address"), F.concat("address_raw", F.lit(",")), F.col("display_address"))
    return known.select(
        "response_id", address.alias("address"), geo.clean_postcode(F.col("address_postcode")).alias("pc"), "uprn"
    )


def right_forms(forms: DataFrame) -> DataFrame:
    """One address form per qid of the right file: address, else display address."""
    known = _known_form_fields(forms.select("qid", "display_address", "address", "address_postcode", "uprn"))
    address = F.coalesce(F.col("address"), F.concat("display_address", F.lit(",")))
    tidy = known.select(
        "qid", address.alias("address"), geo.clean_postcode(F.col("address_postcode")).alias("pc"), "uprn"
    )
    return one_per_key(tidy, ["qid"], ["address", "pc", "uprn"])


def moved_here(postcode, address):
    """A known reference-day postcode, and no 'no address given' code, make a mover.

    A NULL postcode makes none: there is no address to move the person to.
    """
    known = postcode.isNotNull() & ~postcode.isin(*CODES_TO_NULL["address"])
    return known & (F.coalesce(address, F.lit("")) != NO_ADDRESS_GIVEN)


def movers(households: DataFrame) -> DataFrame:
    """Reference-day address of the survey households that moved in later."""
    codes = CODES_TO_NULL["address"]
    address = mis.code_to_null(F.col("refday_address"), codes)
    return (
        households.select("household_id", "refday_address", "refday_postcode", "refday_uprn")
        .distinct()
        .filter(moved_here(F.col("refday_postcode"), F.col("refday_address")))
        .select(
            F.col("household_id").alias("hh_id"),
            address.alias("address_refday"),
            geo.despaced(F.col("refday_postcode")).alias("pc_refday"),
            mis.code_to_null(F.col("refday_uprn"), codes).alias("uprn_refday"),
            house_number(address).alias("house_no_refday"),
            F.lit(True).alias("mover"),
        )
    )


def at_reference_day(people: DataFrame, moves: DataFrame) -> DataFrame:
    """Keep the interview-day address aside and give movers their reference-day address."""
    joined = people.join(moves, "hh_id", "left")
    mover = F.coalesce(F.col("mover") & ~F.equal_null(F.col("pc_refday"), F.col("pc")), F.lit(False))
    places = ("address", "pc", "uprn", "house_no")
    return joined.select(
        *[c for c in people.columns if c not in places],
        *REFDAY_FIELDS,
        *[F.col(c).alias(f"{c}_intday") for c in places],
        *[F.when(mover, F.col(f"{c}_refday")).otherwise(F.col(c)).alias(c) for c in places],
    )


def with_area(people: DataFrame, areas: DataFrame, willingness: DataFrame) -> DataFrame:
    """Authority, region and willingness index by interview-day postcode."""
    lookup = areas.select(
        geo.despaced(F.col("pcd")).alias("pc_intday"),
        F.col("laua").alias("la"), F.col("rgn").alias("region"), F.col("lsoa11").alias("lsoa"),
    )
    index = willingness.select(F.col("lsoa_code").alias("lsoa"), F.col("willingness").alias("htcw"))
    return people.join(lookup, "pc_intday", "left").join(index, "lsoa", "left").drop("lsoa")


# -------------------------------------------------------------------------------- stages
def _away_at_term(side: str):
    away = F.col("is_hh_term_time_address").isin(*AWAY_AT_TERM[side])
    return F.coalesce(away & (F.col("in_full_time_education") == FULL_TIME), F.lit(False))


def clean_left_people(
    residents: DataFrame, forms: DataFrame, nicknames: DataFrame, removals: DataFrame | None = None
) -> CleanPeople:
    places = left_forms(forms)
    places = places.select(
        "*", house_number(F.col("address")).alias("house_no"),
        *[c.alias(name) for name, c in postcode_parts(F.col("pc")).items()],
    )
    people = with_nickname(standardise(residents, "left"), nicknames).join(places, "response_id", "left")
    students = people.filter(_away_at_term("left")).select(
        "id", "hh_id", F.lit(1).alias("student_duplicate"), "pc", "dob"
    )
    people = people.filter(~_away_at_term("left"))
    removed = None
    if removals is not None:
        listed = removals.select("id").distinct()
        removed = with_side(people.join(listed, "id", "left_semi").select("id", "hh_id", "pc", "dob"), "left")
        people = people.join(listed, "id", "left_anti")
    return CleanPeople(with_side(people.select(*LEFT_FIELDS), "left"), with_side(students, "left"), removed)


def clean_right_people(
    residents: DataFrame, forms: DataFrame, households: DataFrame, nicknames: DataFrame,
    areas: DataFrame, willingness: DataFrame,
) -> CleanPeople:
    places = right_forms(forms).withColumn("house_no", house_number(F.col("address")))
    people = with_nickname(standardise(residents, "right"), nicknames).join(places, "qid", "left")
    people = at_reference_day(people, movers(households))
    people = people.select("*", *[c.alias(name) for name, c in postcode_parts(F.col("pc")).items()])
    people = with_area(people, areas, willingness)
    students = people.filter(_away_at_term("right")).select(
        "id", "hh_id", F.lit(1).alias("student_duplicate"), "pc_intday", "pc_refday", "dob"
    )
    people = people.filter(~_away_at_term("right"))
    return CleanPeople(with_side(people.select(*RIGHT_FIELDS), "right"), with_side(students, "right"))
