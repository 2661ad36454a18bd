"""Alike values by shared segments: complete, and with few comparisons."""

import random

import pytest
from pyspark.sql import functions as F

from fixtures.catalog.registry import people
from pairloom.operators import similar
from pairloom.plans import presearch as ps
from pairloom.session import staged


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("threshold", [0.4, 0.6, 0.8])
def test_all_alike_values_are_found(spark, threshold):
    rng = random.Random(int(threshold * 10))
    names = ["".join(rng.choice("ABC") for _ in range(rng.randint(0, 9))) for _ in range(120)] + ["SMITH", "SMYTHE", "É", None, "", "ABCABCABCABCABCABC", "ABCD" * 9, "ABCD" * 7, "ABCE" * 6]
    other = [n and "".join(c if rng.random() > 0.2 else rng.choice("ABCX") for c in n) for n in names] + names[:20]
    left = spark.createDataFrame([(n,) for n in names], "value_l string")
    right = spark.createDataFrame([(n,) for n in other], "value_r string")
    got = {tuple(r) for r in similar.similar_values(left, right, threshold).collect()}
    want = {(a, b) for a in names for b in other if a and b and 1 - distance(a, b) / max(len(a), len(b)) > threshold}
    assert got == want and len(want) > 40


def test_name_passes_equal_the_plain_rule(spark):
    left, right = people(spark, "/root/testdata/sf0.01")
    for number, block in ps.NAME_PASSES.items():
        a, b = ps.searchable(left, "left"), ps.searchable(right, "right")
        plain = a.join(b, (F.col(f"{block}_l") == F.col(f"{block}_r")) & ps.BY_NUMBER[number].rule())
        want = {tuple(r) for r in plain.select("id_l", "id_r").collect()}
        got = [tuple(r) for r in ps.presearch_pairs(left, right, number).collect()]
        assert set(got) == want and len(got) == len(want) > 0


def test_few_of_all_pairs_are_compared(spark):
    """Names are compared once and only where they share a segment: far less often than people of one age would be."""
    left, right = people(spark, "/root/testdata/sf0.1")
    compared = sum(
        similar.candidate_values(left.select(F.col(f"{n}_l").alias("value_l")), right.select(F.col(f"{n}_r").alias("value_r")), ps.NAMES_ALIKE).count()
        for n in ("fn1", "sn1")
    )
    sizes = [df.groupBy(F.col(f"age{s}").alias("age")).agg(F.count(F.lit(1)).alias("n" + s)) for df, s in ((left, "_l"), (right, "_r"))]
    pairs = sizes[0].join(sizes[1], "age").agg(F.sum(F.col("n_l") * F.col("n_r"))).first()[0]
    assert 0 < compared < 0.1 * pairs, (compared, pairs)


def test_name_passes_store_no_pairs_of_last_names(spark, monkeypatch):
    """400 last names that are all alike, each person with a birth date of their own: no list of 160,000 alike names is made."""
    stored = []

    def counted(df, name):
        kept = staged(df, name)
        stored.append(kept.count())
        return kept

    monkeypatch.setattr(ps, "staged", counted)
    names = ["WILLIAMSON" + a + b for a in "ABCDEFGHIJKLMNOPQRST" for b in "ABCDEFGHIJKLMNOPQRST"]
    sides = [
        spark.createDataFrame(
            [(f"{s}{n}", "JOHN" if n % 2 else "JOHNS", name, f"1990-{n}", n) for n, name in enumerate(names)],
            ", ".join(f"{c}_{s} {t}" for c, t in (("id", "string"), ("fn1", "string"), ("sn1", "string"), ("dob", "string"), ("age", "int"))),
        ).select("*", *[F.lit(None).cast("string").alias(f"{c}_{s}") for c in ("fn", "fn2", "fn1_nickname")], F.lit("P").alias("pc_1y_l" if s == "l" else "pc_r"))
        for s in "lr"
    ]
    assert ps.presearch_pairs(*sides, 1).count() == 400
    assert stored == [4]
