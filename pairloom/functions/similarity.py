"""String similarity as JVM expressions, usable inside join conditions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values of the Jaro-Winkler score ---------------------------------------
_WINKLER_FLOOR = 0.7
_WINKLER_PREFIX = 4
_WINKLER_SCALE = 0.1


def lev_score(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length, as a double; NULL for two empty texts."""
    return 1 - F.try_divide(F.levenshtein(a, b), F.greatest(F.length(a), F.length(b)))


def lev_above(a: Column, b: Column, threshold: float) -> Column:
    """``lev_score(a, b) > threshold``.

    The length difference bounds the distance from below, so many pairs are
    settled without computing it; a margin covers the rounding of the score.
    """
    gap = F.abs(F.length(a) - F.length(b))
    possible = gap <= F.greatest(F.length(a), F.length(b)) * (1 - threshold + 1e-6)
    return possible & (lev_score(a, b) > threshold)


def lev_within(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of at most ``edits``; the search stops early beyond it."""
    return F.levenshtein(a, b, edits).between(0, edits)


# ---- Jaro-Winkler, as SQL text: one parse instead of many small expression calls ------
# ``a`` and ``b`` stand for SQL expressions: column names, or variables of an outer lambda.
def _shared_prefix(a: str, b: str) -> str:
    """Length of the common prefix, at most four, of two different texts."""
    tests = [f"WHEN left({a}, {n}) = left({b}, {n}) THEN {n}" for n in range(_WINKLER_PREFIX, 0, -1)]
    return f"CASE {' '.join(tests)} ELSE 0 END"


def _boosted(jaro: str, a: str, b: str) -> str:
    """``jaro`` with the prefix bonus; computed once and then named ``base``."""
    bonus = f"{_shared_prefix(a, b)} * {_WINKLER_SCALE}D * (1 - base)"
    return f"get(transform(array({jaro}), base -> IF(base > {_WINKLER_FLOOR}D, base + {bonus}, base)), 0)"


def _jaro(matched: str, half_swaps: str, a: str, b: str) -> str:
    return f"({matched} / length({a}) + {matched} / length({b}) + ({matched} - {half_swaps}) / {matched}) / 3"


def _jaro_by_matching(a: str, b: str) -> str:
    """Jaro score of two different, non-empty texts.

    Walks over ``a``; each character takes the first free equal character of
    ``b`` within reach.  Taken characters of ``b`` are overwritten with NUL,
    which also tells afterwards, in order, which ones were taken.
    """
    reach = f"greatest(greatest(length({a}), length({b})) div 2 - 1, 0)"
    letter = f"substr({a}, i, 1)"
    at = f"locate({letter}, acc.free, int(greatest(i - {reach}, 1)))"
    step = (
        f"CASE WHEN {at} BETWEEN 1 AND i + {reach} THEN named_struct("
        f"'free', overlay(acc.free PLACING chr(0) FROM {at} FOR 1), 'hits', concat(acc.hits, {letter})) ELSE acc END"
    )
    places = f"filter(sequence(1, length({b})), j -> substr(acc.free, j, 1) = chr(0))"
    swaps = (
        f"size(filter(zip_with(split(acc.hits, ''), transform({places}, j -> substr({b}, j, 1)), (u, w) -> u <> w), d -> d))"
    )
    score = f"IF(acc.hits = '', 0D, {_jaro('length(acc.hits)', f'{swaps} div 2', a, b)})"
    return (
        f"aggregate(sequence(1, length({a})), named_struct('free', {b}, 'hits', ''), (acc, i) -> {step}, acc -> {score})"
    )


def jaro_winkler_sql(a: str, b: str) -> str:
    return (
        f"CAST(CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {a} = '' OR {b} = '' THEN 0D WHEN {a} = {b} THEN 1D "
        f"ELSE {_boosted(_jaro_by_matching(a, b), a, b)} END AS FLOAT)"
    )


def _jaro_winkler_at_best(a: str, b: str) -> str:
    """Upper bound of the score from the letters that both texts have at all."""
    shared = (
        f"least(length({a}) - length(translate({a}, {b}, '')), length({b}) - length(translate({b}, {a}, '')))"
    )
    return f"get(transform(array({shared}), m -> IF(m = 0, 0D, {_boosted(_jaro('m', '0', a, b), a, b)})), 0)"


def jaro_above_sql(a: str, b: str, threshold: float) -> str:
    possible = f"{_jaro_winkler_at_best(a, b)} > {threshold - 1e-6}D"
    return f"(({a} = {b} AND {a} <> '') OR ({possible} AND {jaro_winkler_sql(a, b)} > {threshold}D))"


def jaro_winkler(a: str, b: str) -> Column:
    """Jaro-Winkler similarity of two columns as a float; NULL if either is NULL."""
    return F.expr(jaro_winkler_sql(a, b))


def jaro_above(a: str, b: str, threshold: float) -> Column:
    """``jaro_winkler(a, b) > threshold`` with a cheap bound tried first.

    The score is single precision and the threshold double, so a score of
    exactly 0.8 passes 0.80 and one of exactly 0.9 fails 0.90; the bound keeps
    a margin for that.
    """
    return F.expr(jaro_above_sql(a, b, threshold))


def contained_name(a: Column, b: Column) -> Column:
    """1 when the distinct shared words are as many as the words of the shorter name, and over one."""
    def words(c: Column) -> Column:
        return F.filter(F.split(c, " "), lambda w: w != "")

    shorter = F.least(F.size(words(a)), F.size(words(b)))
    shared = F.size(F.array_intersect(words(a), words(b)))
    return F.when((shorter > 1) & (shared == shorter), 1).otherwise(0)
