"""Inner joins on blocking columns, with hot blocks cut into cells.

A block is all rows that agree on the blocking columns.  Comparing the two
sides of a block costs the product of their sizes, so one huge block (a
communal address, a placeholder postcode) would keep one task busy for ever.
``hot_blocks`` measures block sizes with one aggregate and ``block_join`` cuts
the hot ones into a grid of cells, each a separate join key: left rows are
spread over the grid's rows and copied along its columns, right rows the other
way round, so every pair of rows meets in exactly one cell.

A block may also name a member of a set that both rows hold, such as
``dob_member`` for ``dob_set``.  Rows then meet once for each member, not with
the whole block, and a pair is kept at the least member it shares.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators.columns import SUFFIX
from pairloom.session import staged

CELL_ROWS = 2_000  # rows of a side per cell: some millions of comparisons per task
MEMBER = "_member"  # ends the names of columns that stand for one member of the set of that name


def same(*columns: str) -> Column:
    """Both sides agree on all the named columns."""
    return reduce(lambda a, b: a & b, [F.col(c + SUFFIX["left"]) == F.col(c + SUFFIX["right"]) for c in columns])


def set_of(member: str) -> str:
    """The set a member column is taken from."""
    return member.removesuffix(MEMBER) + "_set"


def member_of(on: Sequence[str]) -> str | None:
    """The member column of a block, which stands last, if it has one."""
    return on[-1] if on[-1].endswith(MEMBER) else None


def shared(member: str) -> Column:
    """Both sides' sets have a member in common."""
    return F.arrays_overlap(*[F.col(set_of(member) + s) for s in SUFFIX.values()])


def _at_least_shared(member: str) -> Column:
    """The member at which a pair meets is the least one its sets share."""
    both = F.array_intersect(*[F.col(set_of(member) + s) for s in SUFFIX.values()])
    return F.array_min(both) == F.col(member + SUFFIX["left"])


def _key_hash(on: Sequence[str], side: str) -> Column:
    return F.xxhash64(*[F.col(c + SUFFIX[side]) for c in on])


def _blockable(df: DataFrame, on: Sequence[str], side: str) -> DataFrame:
    """Rows that can match at all: every blocking column is known.  One row for each member, where a block names one."""
    s, member = SUFFIX[side], member_of(on)
    known = df.dropna(subset=[c + s for c in on if c != member])
    if member is None:
        return known
    return known.select("*", F.explode(set_of(member) + s).alias(member + s)).dropna(subset=[member + s])


def _block_keys(df: DataFrame, side: str, blocks: Sequence[Sequence[str]]) -> DataFrame:
    """``(block, key_hash)`` of every block a row can match in, from one pass over the rows."""
    s = SUFFIX[side]

    def known(on: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c + s).isNotNull() for c in on])

    def key(n: int, key_hash: Column) -> Column:
        return F.struct(F.lit(n).alias("block"), key_hash.alias("key_hash"))

    def by_member(n: int, on: Sequence[str], member: str) -> Column:
        places = [c for c in on if c != member]
        each = F.transform(F.col(set_of(member) + s), lambda m: key(n, F.xxhash64(*[F.col(c + s) for c in places], m)))
        return F.when(known(places), each)

    plain = [F.when(known(on), key(n, _key_hash(on, side))) for n, on in enumerate(blocks) if not member_of(on)]
    keys = [F.array_compact(F.array(*plain))] if plain else []
    for n, on in enumerate(blocks):
        if member := member_of(on):
            keys.append(F.coalesce(by_member(n, on, member), F.array().cast("array<struct<block:int,key_hash:bigint>>")))
    return df.select(F.explode(keys[0] if len(keys) == 1 else F.concat(*keys)).alias("key")).select("key.*")


def hot_blocks(left: DataFrame, right: DataFrame, blocks: Sequence[Sequence[str]], cell_rows: int | None = None):
    """Blocks with more than ``cell_rows`` squared pairs, and how to split them.

    Returns ``(block, key_hash, splits_l, splits_r)`` or None if there are none,
    after one aggregate over the blocking columns of all ``blocks``, whose small
    result is stored: joins read it and never count again.  As its size is known
    it is broadcast while that is small, and joined by a shuffle beyond; every hot
    block is cut, however many there are.  Two blocks with one hash only share a
    split.
    """
    cell_rows = cell_rows or CELL_ROWS
    sizes = [
        _block_keys(df, side, blocks).select(
            "block", "key_hash", *[F.lit(1 if s == side else 0).cast("long").alias(f"n{SUFFIX[s]}") for s in SUFFIX]
        )
        for side, df in (("left", left), ("right", right))
    ]
    total = sizes[0].unionByName(sizes[1]).groupBy("block", "key_hash")
    total = total.agg(F.sum("n_l").alias("n_l"), F.sum("n_r").alias("n_r"))
    compared = F.col("n_l").cast("double") * F.col("n_r")
    hot = staged(total.filter(compared > float(cell_rows) ** 2).select(
        "block", "key_hash",
        *[F.ceil(F.col(f"n{s}") / cell_rows).cast("int").alias(f"splits{s}") for s in SUFFIX.values()],
    ), "hot_blocks")
    return None if hot.isEmpty() else hot


def _in_cells(df: DataFrame, side: str, on: Sequence[str], hot: DataFrame) -> DataFrame:
    own, other = ("_l", "_r") if side == "left" else ("_r", "_l")
    cut = df.withColumn("key_hash", _key_hash(on, side)).join(hot, "key_hash", "left")
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    one = F.lit(1)
    return cut.select(
        *df.columns,
        F.pmod(spread, F.coalesce(F.col(f"splits{own}"), one)).cast("int").alias(f"cell{own}{own}"),
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"splits{other}"), one) - 1)).alias(f"cell{other}{own}"),
    )


def block_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], where: Column | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """Pairs of a left and a right row that agree on ``on`` and satisfy ``where``.

    ``where`` is part of the join condition, so failing pairs never leave it.
    ``hot`` is this block's part of ``hot_blocks``, if any.

    Both sides are shuffled: a block's work is its pairs, not its bytes, and a
    side broadcast for its small file would leave it to the few tasks that read the
    other, and stand whole in the driver.
    """
    columns, member = left.columns + right.columns, member_of(on)
    left, right = _blockable(left, on, "left"), _blockable(right, on, "right")
    condition = same(*on)
    if where is not None:
        condition = condition & where
    if member is not None:
        # the dearest test, so for pairs that satisfy the rest only
        condition = condition & _at_least_shared(member)
    if hot is None:
        return left.join(right.hint("merge"), condition, "inner").select(*columns)
    left, right = _in_cells(left, "left", on, hot), _in_cells(right, "right", on, hot)
    cell = (F.col("cell_l_l") == F.col("cell_l_r")) & (F.col("cell_r_l") == F.col("cell_r_r"))
    return left.join(right.hint("merge"), condition & cell, "inner").select(*columns)


def hot_part(hot: DataFrame | None, number: int) -> DataFrame | None:
    """The hot list of one of several blocks."""
    return None if hot is None else hot.filter(F.col("block") == number).drop("block")


def celled_join(left: DataFrame, right: DataFrame, on: Sequence[str], where: Column | None = None) -> DataFrame:
    """``block_join`` on one block that measures its own hot blocks."""
    return block_join(left, right, on, where, hot_part(hot_blocks(left, right, [on]), 0))
