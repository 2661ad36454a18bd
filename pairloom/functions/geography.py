"""Postcodes and dates of birth as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pairloom.functions.missing import blank_to_null, text_to_null


def clean_postcode(c: Column) -> Column:
    """Upper-case letters and digits, NULL when nothing is left."""
    return blank_to_null(F.upper(F.regexp_replace(c, "[^0-9A-Za-z]+", "")))


def despaced(c: Column) -> Column:
    """A postcode with its spaces taken out and nothing else changed."""
    return F.regexp_replace(c, " ", "")


def postcode_sector(pc: Column) -> Column:
    """All but the last two characters."""
    return F.substring(pc, F.lit(1), F.length(pc) - 2)


def postcode_district(sector: Column) -> Column:
    keep = F.when(F.length(sector) == 5, 4).when(F.length(sector) == 4, 3).otherwise(2)
    return F.left(sector, keep)


def postcode_area(sector: Column) -> Column:
    """One letter when the second character is 1-9, else two characters."""
    one_letter = F.substring(sector, 2, 1).between("1", "9")
    return F.when(one_letter, F.left(sector, F.lit(1))).otherwise(F.left(sector, F.lit(2)))


def iso_birth_date(ddmmyyyy: Column) -> Column:
    """``ddMMyyyy`` to ``yyyy-MM-dd`` text; masked parts stay masked."""
    return F.concat_ws(
        "-", F.substring(ddmmyyyy, 5, 4), F.substring(ddmmyyyy, 3, 2), F.substring(ddmmyyyy, 1, 2)
    )


def birth_parts(raw: Column, mask: str) -> dict[str, Column]:
    """dob, year, mon and day, each NULL when wholly masked by ``mask``."""
    iso = F.when(raw.isNotNull(), iso_birth_date(raw))
    layout = {"dob": (1, 10), "year": (1, 4), "mon": (6, 2), "day": (9, 2)}
    masked = (f"{mask * 4}-{mask * 2}-{mask * 2}", mask * 4, mask * 2)
    return {name: text_to_null(F.substring(iso, at, n), masked) for name, (at, n) in layout.items()}
