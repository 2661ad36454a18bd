"""Match keys as data, run one by one or all together.

A key is one or more routes (columns that must be equal on both sides) and a
rule on what is left.  A route may end in a member of a set both sides hold, such as
``dob_member``.  One key alone is a join per route.  Many keys together
are joined once per block, not once per key: a pair met in a block gets the
lowest key it satisfies there, and the lowest over all blocks is the pair's key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators.blocks import block_join, hot_blocks, hot_part, member_of, same, shared
from pairloom.operators.columns import only

Route = tuple[str, ...]


@dataclass(frozen=True)
class Key:
    number: int
    routes: tuple[Route, ...]
    rule: Callable[[], Column] | None = None


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def single_key(left: DataFrame, right: DataFrame, key: Key, pair: list[str]) -> DataFrame:
    """Distinct pairs one key links."""
    rule, hot = key.rule() if key.rule else None, hot_blocks(left, right, key.routes)
    met = [block_join(left, right, route, rule, hot_part(hot, n)).select(*pair) for n, route in enumerate(key.routes)]
    return reduce(DataFrame.unionByName, met).distinct()


def holds_in(block: Route, key: Key, implied: frozenset[str] = frozenset()) -> Column:
    """A key's condition for pairs that already agree on the block's columns.

    ``implied`` are blocking columns that the key's rule makes equal anyway.
    """
    def condition(route: Route) -> Column:
        rest = [c for c in route if c not in block and c not in implied]
        member = member_of(rest) if rest else None
        plain = [c for c in rest if c != member]
        parts = ([same(*plain)] if plain else []) + ([shared(member)] if member else []) + ([key.rule()] if key.rule else [])
        return all_of(parts) if parts else F.lit(True)

    return any_of([condition(route) for route in key.routes if set(block) - implied <= set(route)])


def lowest_key(block: Route, keys: Sequence[Key], implied: frozenset[str] = frozenset()) -> tuple[Column, Column]:
    """The lowest key a pair satisfies in a block, and whether it satisfies any."""
    held = [(k.number, holds_in(block, k, implied)) for k in sorted(keys, key=lambda k: k.number)]
    number, condition = held[0]
    lowest = reduce(lambda chosen, nc: chosen.when(nc[1], nc[0]), held[1:], F.when(condition, number))
    return lowest, any_of([c for _, c in held])


def block_keys(
    left: DataFrame, right: DataFrame, blocks: Mapping[Route, Sequence[Key]], pair: list[str], name: str,
    hot: DataFrame | None = None, implied: frozenset[str] = frozenset(), gates: Mapping[Route, Callable[[], Column]] | None = None,
) -> list[DataFrame]:
    """Per block the pairs met there with their lowest key of that block; ``implied`` as in ``holds_in``.

    ``gates`` name for some blocks a short condition that all their keys imply.  It
    then stands alone in the join, and the keys are tried above it on the pairs that
    pass: the code of many keys is too long for the JVM to compile, and would be
    interpreted for each pair that meets.
    """
    linked = []
    for number, (block, keys) in enumerate(blocks.items()):
        if keys:
            lowest, any_key = lowest_key(block, keys, implied)
            gate = gates.get(block) if gates else None
            met = block_join(left, right, block, gate() if gate else any_key, hot_part(hot, number))
            met = only(met, any_key) if gate else met
            linked.append(met.select(*pair, lowest.alias(name)))
    return linked

