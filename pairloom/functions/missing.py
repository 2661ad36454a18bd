"""Missing codes and safe typing of raw text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def code_to_null(c: Column, codes) -> Column:
    """NULL where the value is one of ``codes``."""
    return F.when(~c.isin(*codes), c)


def code_to_blank(c: Column, codes) -> Column:
    """Empty text where the value is one of ``codes``; NULL stays NULL."""
    return F.when(c.isin(*codes), F.lit("")).otherwise(c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def text_to_null(c: Column, values) -> Column:
    """NULL where the text is blank or one of ``values``."""
    return code_to_null(c, (*values, ""))


def coded_int(c: Column) -> Column:
    """Integer code: a value holding '-' is missing, other non-digits are dropped."""
    return digits_int(F.when(c.contains("-"), F.lit("")).otherwise(c))


def digits_int(c: Column) -> Column:
    """Digits of a text as an integer, NULL when there are none.

    Blanks become NULL before the cast: a failing cast costs far more than a test.
    """
    return blank_to_null(F.regexp_replace(c, "[^0-9]+", "")).try_cast("int")


def as_int(c: Column) -> Column:
    return c.try_cast("int")


def set_or_dummy(values: Column, dummy: Column) -> Column:
    """A one-element dummy array where a household has no people."""
    return F.coalesce(values, F.array(dummy))
