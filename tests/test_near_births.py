"""Block joins without a broadcast side, and blocks that people too far apart in age and birth date don't share."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fixtures.catalog.registry import households
from pairloom.operators.blocks import celled_join
from pairloom.plans import person_keys as pk


def test_block_joins_broadcast_no_side(spark, sf):
    text = celled_join(*households(spark, sf), ("uprn",)).select("hh_id_l", "hh_id_r")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def born(spark, side, n, seed):
    """People with ages and dates of birth near each other, some of them missing or too short."""
    rng, s, rows = random.Random(seed), "_l" if side == "left" else "_r", []
    for k in range(n):
        day = dt.date(1980, 1, 1) + dt.timedelta(days=rng.randrange(9000))
        dob = rng.choice([None, day.isoformat()[:9], day.isoformat()[1:], *[day.isoformat()] * 12])
        known = [None if rng.random() < 0.1 else v for v in (2021 - day.year, *day.isoformat().split("-"))]
        rows.append((k, dob, *known))
    df = spark.createDataFrame(rows, f"id{s} int, dob{s} string, age{s} int, year{s} string, mon{s} string, day{s} string")
    return df.select("*", *[c.alias(name + s) for name, c in pk.near_births(lambda c: F.col(c + s), side).items()])


def test_pairs_that_a_key_may_link_share_a_sign_and_few_others_do(spark):
    pairs = born(spark, "left", 400, 1).crossJoin(born(spark, "right", 400, 2))
    same_day = (F.col("day_l") == F.col("day_r")) & (F.col("mon_l") == F.col("mon_r"))
    rules = {
        "birth": pk.ages_within(1) | pk.dates_one_edit_apart(),
        "years": pk.ages_within(5) | same_day | (F.col("year_l") == F.col("year_r")),
    }
    for name, rule in rules.items():
        shared = F.arrays_overlap(f"{name}_set_l", f"{name}_set_r")
        lost, linked, met = pairs.agg(F.count_if(rule & ~shared), F.count_if(rule), F.count_if(shared)).head()
        assert lost == 0 and linked > 1000
        assert met < 0.6 * 400 * 400
    short = pairs.filter((F.least(F.length("dob_l"), F.length("dob_r")) < 10) & pk.dates_one_edit_apart())
    assert short.filter(~F.arrays_overlap("birth_set_l", "birth_set_r")).isEmpty()
