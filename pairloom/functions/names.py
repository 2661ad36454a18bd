"""Name standardisation.  Inputs are upper-case text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clean_names_nospace(c: Column) -> Column:
    """Letters A-Z only."""
    return F.trim(F.regexp_replace(c, "[^A-Z]+", ""))


def clean_names_az(c: Column) -> Column:
    """Letters A-Z and spaces only."""
    return F.trim(F.regexp_replace(c, "[^A-Z ]+", ""))


def hyphen_to_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "-+", " "))


def space_to_hyphen(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, " ", "-"))


def single_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def alpha(c: Column) -> Column:
    """The characters of a text in sorted order."""
    return F.array_join(F.sort_array(F.split(c, "")), "")


def remove_final_char(c: Column) -> Column:
    """All but the last character."""
    return F.left(c, F.greatest(F.length(c) - 1, F.lit(0)))


def name_words(c: Column) -> Column:
    """The cleaned words of a name.  Runs of hyphens need no pattern here: blanks are merged next."""
    return F.split(clean_names_az(single_space(_hyphens_out(c))), " ")


def _hyphens_out(c: Column) -> Column:
    return F.trim(F.replace(c, F.lit("-"), F.lit(" ")))


def forenames(first: Column, middle: Column) -> Column:
    """First and middle names with a space; a missing one is skipped."""
    joined = F.concat_ws(" ", first, middle)
    return F.when(joined == " ", F.lit("")).otherwise(joined)


def full_name(fore: Column, last: Column) -> Column:
    """Forenames and last name as cleaned words; NULL if either is NULL."""
    def words(c: Column) -> Column:
        return clean_names_az(_hyphens_out(c))

    return single_space(F.concat(words(fore), F.lit(" "), words(last)))
