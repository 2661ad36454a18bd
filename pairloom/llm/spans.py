"""Places of matches, as columns, in time that grows with the matches and not with their square.

An aggregate that appends to an array copies it at each step.  Here an array is
cut into blocks of BLOCK items: only the state before each block is appended
over the whole array, and inside a block at most BLOCK items are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

SPANS = "array<struct<start:int,end:int,found:string>>"
BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks(items: Column) -> Column:
    """An array of at least one item, cut into arrays of BLOCK items."""
    last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def running(items: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each item of an array of at least one the state before it: ``start``, carried on by ``step(state, item)``."""
    def collected(of: Column, first: Column, onwards: Callable[[Column, Column], Column]) -> Column:
        none = F.filter(F.array(first), lambda x: F.lit(False))
        begin = F.struct(first.alias("now"), none.alias("seen"))
        return F.aggregate(
            of, begin, lambda s, x: F.struct(onwards(s["now"], x).alias("now"), F.concat(s["seen"], F.array(s["now"])).alias("seen")), lambda s: s["seen"],
        )

    def over(cut: Column) -> Column:
        before = collected(cut, start, lambda now, block: F.aggregate(block, now, step))
        return F.flatten(F.zip_with(cut, before, lambda block, first: collected(block, first, step)))

    return let(blocks(items), over)


def spans(text: Column, pattern: Column) -> Column:
    """Leftmost non-overlapping matches as ``{start, end, found}``, in code points, the end exclusive.

    The pattern mustn't match the empty text.  What stands between the matches
    and the matches themselves alternate, so their lengths add up to the places.
    """
    def placed(found: Column) -> Column:
        # one part more than matches: the text after the last match
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        return let(F.zip_with(between, found, lambda b, m: F.struct(F.length(b).alias("before"), F.length(m).alias("length"), m.alias("found"))), summed)

    def summed(pairs: Column) -> Column:
        at = running(pairs, F.lit(0), lambda now, x: now + x["before"] + x["length"])
        return F.zip_with(pairs, at, lambda x, now: F.struct(
            (now + x["before"]).alias("start"), (now + x["before"] + x["length"]).alias("end"), x["found"].alias("found")
        ))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(F.array().cast(SPANS)))


def free(found: Column, taken: Column) -> Column:
    """The spans ``{start, order, end, kind}`` of ``found`` that overlap none of ``taken``.

    Both are put into one order; seen from a span, the greatest end of the taken
    ones that start before it and the start of the next of them tell.
    """
    def marked(x: Column, own: bool) -> Column:
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(own).alias("own"), x.alias("span"))

    def over(both: Column) -> Column:
        ends = running(both, F.lit(0), lambda now, x: F.when(x["own"], now).otherwise(F.greatest(now, x["end"])))
        starts = F.reverse(running(F.reverse(both), F.lit(2**31 - 1), lambda now, x: F.when(x["own"], now).otherwise(x["start"])))
        apart = F.zip_with(ends, starts, lambda e, s: F.struct(e.alias("end"), s.alias("next")))
        each = F.zip_with(both, apart, lambda x, a: F.struct((x["own"] & (a["end"] <= x["start"]) & (a["next"] >= x["end"])).alias("keep"), x["span"].alias("span")))
        return F.transform(F.filter(each, lambda x: x["keep"]), lambda x: x["span"])

    both = F.array_sort(F.concat(F.transform(found, lambda x: marked(x, True)), F.transform(taken, lambda x: marked(x, False))))
    return F.when((F.size(found) == 0) | (F.size(taken) == 0), found).otherwise(let(both, over))
