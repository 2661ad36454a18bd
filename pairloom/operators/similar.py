"""Joining values whose edit-distance score is above a threshold, without comparing all with all.

Values that may differ by ``k`` edits share a piece: cut one of them into ``k + 1``
segments, and at least one stands unchanged in the other, shifted by few places.
So each value of the left side gives its segments, each of the right side the
stretches that may equal one, and only values that share a segment are compared.
How many edits are allowed follows from the longer of two lengths, so segments
are cut anew for each length that the other value may have.

Values are compared once, however many rows hold them: callers join the alike
pairs to their rows by equality.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairloom.functions.similarity import lev_above

#: Longest texts that are cut into segments.  Longer ones, which names hardly are, are compared with all that are long enough.
LONGEST = 32


def most_edits(length: int, threshold: float) -> int:
    """The greatest edit distance whose score, at this length of the longer text, is above the threshold; -1 if none is."""
    return max((d for d in range(length + 1) if 1 - d / length > threshold), default=-1)


def segments(threshold: float) -> list[tuple[int, int, int, int, int, int, int]]:
    """``(length_l, length_r, number, start, size, first, last)`` for all lengths of texts that may be alike.

    A segment of the left text begins at ``start``; in the right one it may begin
    from ``first`` to ``last``: edits before it shift it, and so do those after it, seen
    from the end.  Later segments are longer by one where it doesn't come out even.
    """
    rows = []
    for left in range(1, LONGEST + 1):
        for right in range(1, LONGEST + 1):
            edits, gap = most_edits(max(left, right), threshold), right - left
            if abs(gap) > edits:
                continue
            parts = edits + 1
            each, later = left // parts, parts - left % parts
            for number in range(parts):
                start, size = number * each + max(0, number - later), each + (number >= later)
                after = parts - 1 - number
                first, last = max(0, start - number, start + gap - after), min(right - size, start + number, start + gap + after)
                if first <= last:
                    rows.append((left, right, number, start, size, first, last))
    return rows


def _signs(values: DataFrame, side: str, table: DataFrame, threshold: float) -> DataFrame:
    """``(value, sign)`` of distinct known values: segments of the left side, stretches as long of the right one."""
    name = f"value{side}"
    known = values.filter(F.length(name) > 0).distinct()
    at = F.explode(F.sequence("first", "last")) if side == "_r" else F.col("start")
    cut = known.join(F.broadcast(table), F.length(name) == F.col(f"length{side}")).select(name, "length_l", "length_r", "number", "size", at.alias("at"))
    piece = F.substring(F.col(name), F.col("at") + 1, F.col("size"))
    signs = cut.select(name, F.concat_ws(":", "length_l", "length_r", "number", piece).alias(f"sign{side}"))

    def long(own: str) -> Column:
        return F.length(name) > (LONGEST if own == side else math.floor(LONGEST * threshold))

    longer = [F.when(long(own), F.lit(f"longer{own}")) for own in ("_l", "_r")]
    return signs.unionByName(known.select(name, F.explode(F.array_compact(F.array(*longer))).alias(f"sign{side}"))).distinct()


def _table(spark: SparkSession, threshold: float) -> DataFrame:
    # some thousand rows, whatever the data
    columns = "length_l int, length_r int, number int, start int, size int, first int, last int"
    return spark.createDataFrame(segments(threshold), columns)


def candidate_values(left: DataFrame, right: DataFrame, threshold: float, where: Column | None = None) -> DataFrame:
    """``(value_l, value_r)``: distinct values of two columns of these names that share a segment."""
    table = _table(left.sparkSession, threshold)
    signed = _signs(left, "_l", table, threshold), _signs(right, "_r", table, threshold)
    condition = F.col("sign_l") == F.col("sign_r")
    return signed[0].join(signed[1], condition if where is None else condition & where).select("value_l", "value_r").distinct()


def similar_values(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """``(value_l, value_r)``: distinct values whose score is above the threshold; missing and empty ones have no score."""
    return candidate_values(left, right, threshold, lev_above(F.col("value_r"), F.col("value_l"), threshold))
