"""Pre-search blocking passes: wide nets over people, as a rule those still unlinked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pairloom.functions.similarity import lev_above
from pairloom.operators.blocks import celled_join, hot_blocks
from pairloom.operators.columns import SUFFIX
from pairloom.operators.keys import Key, Route, block_keys, single_key
from pairloom.operators.pairs import PAIR, best_key
from pairloom.operators.similar import similar_values
from pairloom.session import staged

CARRIED = ["id", "fn", "fn1", "fn2", "sn1", "fn1_nickname", "dob", "age"]


def _alike(column: str, threshold: float):
    return lev_above(F.col(f"{column}_r"), F.col(f"{column}_l"), threshold)


NAMES_ALIKE = 0.6


def _names_alike():
    return _alike("fn1", NAMES_ALIKE) & _alike("sn1", NAMES_ALIKE)


PASSES: tuple[Key, ...] = (
    Key(1, (("dob",),), _names_alike),
    Key(2, (("age",),), _names_alike),
    Key(3, (("fn1", "dob"),), lambda: _alike("sn1", 0.4)),
    Key(4, (("sn1", "dob"),), lambda: _alike("fn", 0.4)),
    Key(5, (("fn1", "sn1"),)),
    Key(6, (("fn2", "sn1"),)),
    Key(7, (("fn1", "fn2"),)),
    Key(8, (("fn1", "dob"),)),
    Key(9, (("fn2", "dob"),)),
    Key(10, (("sn1", "dob"),)),
    Key(11, (("fn1_nickname", "sn1", "age"),)),
    Key(12, (("sn1", "pc_then"),), lambda: _alike("fn1", 0.6)),
)
BY_NUMBER = {p.number: p for p in PASSES}


def searchable(people: DataFrame, side: str) -> DataFrame:
    """Columns of the passes; ``pc_then`` is the left postcode a year ago and the right postcode now."""
    s = SUFFIX[side]
    then = "pc_1y_l" if side == "left" else "pc_r"
    return people.select(*[c + s for c in CARRIED], F.col(then).alias(f"pc_then{s}"))


def unlinked(people: DataFrame, links: DataFrame, side: str) -> DataFrame:
    """People of a side that no final link holds."""
    return people.join(links.select(f"id{SUFFIX[side]}").distinct(), f"id{SUFFIX[side]}", "left_anti")


def alike_names(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """``(value_l, value_r)``, stored: pairs of names of the two sides that are alike.  Each pair is compared once."""
    values = [df.select(F.col(name + s).alias("value" + s)) for df, s in ((left, "_l"), (right, "_r"))]
    return staged(similar_values(*values, NAMES_ALIKE), f"alike_{name}")


def names_alike_pairs(left: DataFrame, right: DataFrame, block: str, first: DataFrame) -> DataFrame:
    """Pairs that agree on ``block`` and have both names alike; a pair of two ids with several rows may come several times.

    A left person is joined under each first name alike to theirs, so only people
    of one block with alike first names meet, and their last names are compared
    there.  Files hold few first names, however large they are; last names are so
    many that all pairs of alike ones grow beyond the pairs of people who meet.
    """
    sides = [df.select(*[c + s for c in ("id", "fn1", "sn1", block)]).distinct() for df, s in ((left, "_l"), (right, "_r"))]
    under = sides[0].join(first, F.col("fn1_l") == F.col("value_l")).select(*sides[0].columns, F.col("value_r").alias("under_l"))
    met = celled_join(under, sides[1].withColumn("under_r", F.col("fn1_r")), [block, "under"], _alike("sn1", NAMES_ALIKE))
    return met.select(*PAIR)


#: Passes that ask for both names alike in a block that is too wide to compare all its people.
NAME_PASSES = {1: "dob", 2: "age"}


def presearch_pairs(left: DataFrame, right: DataFrame, number: int) -> DataFrame:
    """Distinct pairs one pass finds; frequent names and ages are cut into cells.

    Passes 5 to 7 ask for two equal names only, so their result is as large as
    the product of the namesakes of both files.
    """
    left, right = searchable(left, "left"), searchable(right, "right")
    if number in NAME_PASSES:
        return names_alike_pairs(left, right, NAME_PASSES[number], alike_names(left, right, "fn1")).distinct()
    return single_key(left, right, BY_NUMBER[number], PAIR)


#: Passes by two equal names and nothing else: their pairs grow with the product of the namesakes.
NAMESAKE_PASSES = (5, 6, 7)


def namesakes(left: DataFrame, right: DataFrame, number: int) -> DataFrame:
    """``(name_1, name_2, side, id)``: the people one of these passes brings together, a row each instead of a row a pair.

    Names that only one side holds are left out.  ``namesake_pairs`` makes the
    pairs when they are asked for.
    """
    names = BY_NUMBER[number].routes[0]

    def one_side(people: DataFrame, side: str) -> DataFrame:
        s = SUFFIX[side]
        return people.dropna(subset=[c + s for c in names]).select(
            *[F.col(c + s).alias(f"name_{n}") for n, c in enumerate(names, 1)], F.lit(side).alias("side"), F.col(f"id{s}").alias("id")
        ).distinct()

    both = one_side(left, "left").unionByName(one_side(right, "right"))
    held = both.groupBy("name_1", "name_2").agg(F.min("side").alias("first"), F.max("side").alias("last")).filter("first <> last")
    return both.join(held, ["name_1", "name_2"], "left_semi")


def namesake_groups(members: DataFrame) -> DataFrame:
    """``(name_1, name_2, n_l, n_r, n_pairs)``: the size of each group, and of its pairs, none of which is made."""
    sizes = members.groupBy("name_1", "name_2").agg(*[F.count_if(F.col("side") == side).alias(f"n{s}") for side, s in SUFFIX.items()])
    return sizes.withColumn("n_pairs", F.col("n_l") * F.col("n_r"))


def namesake_pairs(members: DataFrame) -> DataFrame:
    """The distinct pairs of some groups of namesakes; frequent names are cut into cells."""
    sides = [
        members.filter(F.col("side") == side).select(*[F.col(c).alias(c + s) for c in ("id", "name_1", "name_2")])
        for side, s in SUFFIX.items()
    ]
    return celled_join(*sides, ["name_1", "name_2"]).select(*PAIR).distinct()


# Passes 3 and 4 ask for more than 8 and 10 on the same columns, but come first.
BLOCKS: dict[Route, tuple[int, ...]] = {
    ("fn1", "dob"): (3, 8), ("sn1", "dob"): (4, 10), ("fn1", "sn1"): (5,), ("fn2", "sn1"): (6,),
    ("fn1", "fn2"): (7,), ("fn2", "dob"): (9,), ("fn1_nickname", "sn1", "age"): (11,), ("sn1", "pc_then"): (12,),
}


def presearch(left: DataFrame, right: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``(id_l, id_r, search_pass)``: pairs of any pass with the first pass that finds them.

    With ``links`` only people that none of them holds are searched.  Every
    block is joined once, and hot blocks are measured once for all of them.
    """
    if links is not None:
        left, right = unlinked(left, links, "left"), unlinked(right, links, "right")
    left, right = searchable(left, "left"), searchable(right, "right")
    blocks = {block: [BY_NUMBER[n] for n in numbers] for block, numbers in BLOCKS.items()}
    parts = block_keys(left, right, blocks, PAIR, "search_pass", hot_blocks(left, right, list(blocks)))
    first = alike_names(left, right, "fn1")
    parts += [names_alike_pairs(left, right, block, first).withColumn("search_pass", F.lit(number)) for number, block in NAME_PASSES.items()]
    return best_key(reduce(DataFrame.unionByName, parts), "search_pass")
