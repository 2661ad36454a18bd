"""The cleaned fixture files on Spark: raw tables through the library's own stages."""

from __future__ import annotations

from fixtures.raw_sql import spark_raw
from pairloom.plans.households import clean_left_households, clean_right_households
from pairloom.plans.people import CleanPeople, clean_left_people, clean_right_people


def left_stage(spark, sf_dir: str) -> CleanPeople:
    def raw(t):
        return spark_raw(spark, sf_dir, t)

    return clean_left_people(
        raw("raw_left_people"), raw("raw_left_forms"), raw("raw_nicknames"), raw("raw_removals")
    )


def right_stage(spark, sf_dir: str) -> CleanPeople:
    def raw(t):
        return spark_raw(spark, sf_dir, t)

    return clean_right_people(
        raw("raw_right_people"), raw("raw_right_forms"), raw("raw_right_households"), raw("raw_nicknames"),
        raw("raw_areas"), raw("raw_willingness"),
    )


def left_households(spark, sf_dir: str, left):
    """``left`` are the cleaned left people."""
    return clean_left_households(
        spark_raw(spark, sf_dir, "raw_left_households"), spark_raw(spark, sf_dir, "raw_left_forms"), left
    )


def right_households(spark, sf_dir: str, right):
    """``right`` are the cleaned right people."""
    return clean_right_households(
        spark_raw(spark, sf_dir, "raw_right_households"), spark_raw(spark, sf_dir, "raw_right_forms"), right
    )
