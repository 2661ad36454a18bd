"""Measures between the person sets (arrays) of two households.

The ``*_above`` and ``shares`` tests stop at the first pair that satisfies
them; the value forms look at every pair.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pairloom.functions.similarity import jaro_above_sql, jaro_winkler_sql, lev_score


def common(a: Column, b: Column) -> Column:
    """Number of distinct elements in both arrays."""
    return F.size(F.array_intersect(a, b))


def shares(a: Column, b: Column) -> Column:
    """At least one element in both arrays."""
    return F.arrays_overlap(a, b)


def _best(a: Column, b: Column, score) -> Column:
    return F.array_max(F.transform(a, lambda x: F.array_max(F.transform(b, lambda y: score(x, y)))))


def _any(a: Column, b: Column, test) -> Column:
    return F.exists(a, lambda x: F.exists(b, lambda y: test(x, y)))


def common_age(a: Column, b: Column) -> Column:
    """Number of cross pairs of ages at most one year apart."""
    near = F.transform(a, lambda x: F.size(F.filter(b, lambda y: F.abs(x - y) <= 1)))
    return F.aggregate(near, F.lit(0), lambda total, n: total + n)


def shares_age(a: Column, b: Column) -> Column:
    """At least one cross pair of ages at most one year apart."""
    return _any(a, b, lambda x, y: F.abs(x - y) <= 1)


def max_lev(a: Column, b: Column) -> Column:
    """Best edit-distance score over all cross pairs, as a float."""
    return _best(a, b, lev_score).cast("float")


def max_jaro(a: str, b: str) -> Column:
    """Best Jaro-Winkler score over all cross pairs of two array columns, as a float."""
    return F.expr(f"array_max(transform({a}, x -> array_max(transform({b}, y -> {jaro_winkler_sql('x', 'y')}))))")


def max_jaro_above(a: str, b: str, threshold: float) -> Column:
    """``max_jaro(a, b) > threshold``."""
    return F.expr(f"exists({a}, x -> exists({b}, y -> {jaro_above_sql('x', 'y', threshold)}))")


def max_lev_above(a: Column, b: Column, threshold: float) -> Column:
    """``max_lev(a, b) > threshold``; compared as a float, so exactly 0.8 passes 0.80."""
    return _any(a, b, lambda x, y: lev_score(x, y).cast("float") > threshold)
