"""House and flat numbers from address lines, as built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from pairloom.config import FLAT_WORDS, FLOOR_TERMS, UNIT_WORDS


def replace_all(c: Column, terms) -> Column:
    """Take out every term in turn, trimming after each."""
    return reduce(lambda text, term: F.trim(F.replace(text, F.lit(term), F.lit(""))), terms, c)


def _significant(digits: Column) -> Column:
    return F.ltrim(digits, F.lit("0"))


def house_number(address: Column) -> Column:
    """First number of the part before the last comma, flats and floors left out.

    An address without a comma has no such part, hence no house number.
    """
    commas = F.regexp_count(address, F.lit(","))
    street = F.call_function("substring_index", F.upper(address), F.lit(","), commas)
    # every term names a floor; most addresses don't and need no replacement
    street = F.when(F.contains(street, F.lit("FLOOR")), replace_all(street, FLOOR_TERMS)).otherwise(F.trim(street))
    for word in UNIT_WORDS:
        street = F.trim(F.regexp_replace(street, rf"{word}\s*\d+", ""))
    numbers = F.regexp_extract_all(street, F.lit(r"\d+"), F.lit(0))
    return _significant(F.get(F.filter(numbers, lambda n: n != "0"), F.lit(0)))


def flat_number(address: Column) -> Column:
    """First ``FLAT n``, else first ``APARTMENT n``; a plain 0 counts as none."""
    upper = F.upper(address)
    found = F.coalesce(
        *[F.get(F.regexp_extract_all(upper, F.lit(rf"{w} (\d+)"), F.lit(1)), F.lit(0)) for w in FLAT_WORDS]
    )
    return _significant(F.nullif(found, F.lit("0")))
