"""Distinct pairs that are told apart where they meet: the pairs are not shuffled to make them distinct."""

import itertools
import random

import pytest

from pairloom.operators import blocks
from pairloom.operators.pairs import PAIR
from pairloom.plans import person_keys as pk, scoring


def people(spark, side, seed, n=60):
    """People some of whom have several rows, uprns, postcodes and sexes, or none; ids may be missing."""
    rng, s = random.Random(seed), "_l" if side == "left" else "_r"
    rows = [
        (rng.choice([None, *[f"{side}{k}" for k in range(25)]]), rng.choice([None, "A", "B", "C"]), rng.choice([None, "1", "2"]))
        for _ in range(n)
    ]
    rows += rows[:10]
    return rows, spark.createDataFrame([(i, p, p, x) for i, p, x in rows], f"id{s} string, uprn{s} string, pc{s} string, sex{s} string")


def found(df):
    return sorted((tuple(r) for r in df.select(*PAIR).collect()), key=str)


def pairs_are_not_shuffled(df):
    above, join, _ = df._jdf.queryExecution().executedPlan().toString().partition("SortMergeJoin")
    return join and "Exchange" not in above and "Aggregate" not in above


@pytest.mark.parametrize("cell_rows", [2000, 3])
def test_pairs_of_one_pass_are_distinct_where_they_meet(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(blocks, "CELL_ROWS", cell_rows)
    (a, left), (b, right) = people(spark, "left", 1), people(spark, "right", 2)
    expected = {(x[0], y[0]) for x, y in itertools.product(a, b) if x[1] is not None and x[1] == y[1]}
    pairs = scoring.one_pass(left, right, "pc", "pc")
    assert found(pairs) == sorted(expected, key=str)
    assert pairs_are_not_shuffled(pairs)


@pytest.mark.parametrize("cell_rows", [2000, 3])
def test_pairs_of_one_uprn_are_distinct_where_they_meet(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(blocks, "CELL_ROWS", cell_rows)
    (a, left), (b, right) = people(spark, "left", 3), people(spark, "right", 4)
    expected = {
        (x[0], y[0]) for x, y in itertools.product(a, b)
        if x[1] is not None and x[1] == y[1] and (x[2] is None or y[2] is None or x[2] == y[2])
    }
    pairs = pk.at_one_uprn(left, right)
    assert found(pairs) == sorted(expected, key=str)
    assert pairs_are_not_shuffled(pairs)
