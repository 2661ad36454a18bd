"""Block joins: hot blocks cut into cells give the same pairs, and plans hold no cross product."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom.operators import blocks
from pairloom.operators.numbering import numbered, shuffled_order


def _side(spark, n, suffix):
    """A third of the rows in one block, some without a block, the others spread."""
    key = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 10 == 1, None).otherwise(
        F.concat(F.lit("B"), (F.col("id") % 17).cast("string")))
    return spark.range(n).select(F.col("id").cast("string").alias(f"id{suffix}"), key.alias(f"pc{suffix}"), F.col("id").alias(f"v{suffix}"))


def _pairs(df):
    return Counter((r["id_l"], r["id_r"]) for r in df.select("id_l", "id_r").collect())


@pytest.mark.parametrize("cell_rows", [10, 37])
def test_cells_keep_every_pair_once(spark, cell_rows):
    left, right = _side(spark, 300, "_l"), _side(spark, 240, "_r")
    where = (F.col("v_l") + F.col("v_r")) % 2 == 0
    hot = blocks.hot_blocks(left, right, [("pc",)], cell_rows)
    assert hot is not None
    largest = hot.orderBy(F.desc("splits_l")).first()
    assert largest["splits_l"] == -(-100 // cell_rows) and largest["splits_r"] == -(-80 // cell_rows)
    plain = _pairs(blocks.block_join(left, right, ("pc",), where))
    cut = _pairs(blocks.block_join(left, right, ("pc",), where, blocks.hot_part(hot, 0)))
    assert plain and cut == plain


def test_no_hot_blocks_no_change(spark):
    left, right = _side(spark, 60, "_l"), _side(spark, 60, "_r")
    assert blocks.hot_blocks(left, right, [("pc",)]) is None


def test_hot_blocks_of_several_keys_are_measured_at_once(spark):
    left, right = _side(spark, 300, "_l"), _side(spark, 300, "_r")
    hot = blocks.hot_blocks(left, right, [("pc", "v"), ("pc",)], 50)
    assert {r["block"] for r in hot.collect()} == {1}


def test_numbered_equals_one_global_row_number(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    got = numbered(ids, shuffled_order(F.col("id"), "s"), ["id"], "n").toPandas()
    assert sorted(got["n"]) == list(range(1, 5001))
    import hashlib
    expected = sorted(got["id"], key=lambda x: hashlib.md5(("s" + x).encode()).hexdigest())
    assert list(got.sort_values("n")["id"]) == expected


def _households(spark, n, suffix):
    """Sets of one to four members; a third of all rows in one block; some sets are empty, missing or hold a null."""
    rows = []
    for i in range(n):
        members = [f"m{(i * 7 + k * 13) % 41}" for k in range(1 + i % 4)]
        held = None if i % 29 == 3 else [] if i % 23 == 5 else [*members, None] if i % 19 == 7 else sorted(set(members))
        rows.append((str(i), "HOT" if i % 3 == 0 else None if i % 10 == 1 else f"B{i % 5}", held))
    return rows, spark.createDataFrame(rows, f"id{suffix} string, pc{suffix} string, dob_set{suffix} array<string>")


@pytest.mark.parametrize("cell_rows", [None, 1])
def test_pairs_that_share_a_member_meet_once(spark, cell_rows):
    (left, left_df), (right, right_df) = _households(spark, 120, "_l"), _households(spark, 90, "_r")
    expected = Counter(
        (a, b) for a, p, x in left for b, q, y in right if p and p == q and {*(x or [])} & {*(y or [])} - {None}
    )
    on = ("pc", "dob_member")
    hot = None if cell_rows is None else blocks.hot_blocks(left_df, right_df, [("pc",), on], cell_rows)
    part = blocks.hot_part(hot, 1)
    members = left_df.select("pc_l", F.explode("dob_set_l").alias("m"))
    hashed = {r[0] for r in members.select(F.xxhash64("pc_l", "m")).collect()}
    assert cell_rows is None or part.count() > 1 and {r["key_hash"] for r in part.collect()} <= hashed
    met = blocks.block_join(left_df, right_df, on, None, part)
    assert met.columns == left_df.columns + right_df.columns
    assert _pairs(met) == expected and set(expected.values()) == {1}


def test_a_hot_postcode_is_not_compared_as_a_whole(spark):
    """Households of one postcode: rows made by the join are those that share a birth date, not all pairs."""
    def side(n, s):
        return spark.range(n).select(
            F.col("id").cast("string").alias(f"id{s}"), F.lit("HOT").alias(f"pc{s}"),
            F.array(F.col("id") % 97, F.col("id") % 97 + 1000).alias(f"dob_set{s}"),
        )

    left, right = side(970, "_l"), side(970, "_r")
    met = blocks.block_join(left, right, ("pc", "dob_member"))
    assert met.count() == 970 * 10 and met.select("id_l", "id_r").distinct().count() == 970 * 10
    text = met._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("upto", [0, 1, 700, 5000, 9000])
def test_numbers_up_to_a_bound(spark, upto):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    order = shuffled_order(F.col("id"), "s")
    whole = {(r["id"], r["n"]) for r in numbered(ids, order, ["id"], "n").collect()}
    some = numbered(ids, order, ["id"], "n", F.lit(upto))
    assert {(r["id"], r["n"]) for r in some.collect()} == {x for x in whole if x[1] <= upto}
    text = some._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Window") < text.index("Join Inner")  # the window stands above the join that drops the other buckets
