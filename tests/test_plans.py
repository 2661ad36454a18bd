"""Properties of the stages: joint run against single keys, plan shapes, missing values, a whole run."""

import datetime as dt
import re
from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from fixtures import inputs
from fixtures.catalog import ORACLES, QUERIES
from fixtures.catalog.registry import decisions, households, people, raw, stage
from pairloom.functions import missing
from pairloom.operators import blocks, mu
from pairloom.operators.bands import banded, score_bands
from pairloom.operators.pairs import PAIR, best_key, latest
from pairloom.plans import clerical as review, combine as cb, household_keys as hk, person_keys as pk, presearch as ps, run as rn, scoring
from pairloom.plans.people import movers
from pairloom.sources import stages as out, tables as src


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# -------------------------------------------------------------------------------- plan shapes
def test_no_cross_products_and_no_python_in_the_joint_runs(spark, sf):
    for df in (
        pk.link_people(*people(spark, sf)),
        hk.link_households(*households(spark, sf)),
        scoring.score_people(*people(spark, sf), stage(spark, sf, "m_values"), stage(spark, sf, "u_values")),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        assert "EvalPython" not in text and "BatchEval" not in text


@pytest.mark.parametrize("number", sorted(pk.BY_NUMBER))
def test_every_person_key_joins_on_keys(spark, sf, number):
    text = plan(pk.key_pairs(*people(spark, sf), number))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scans_read_only_what_a_key_needs(spark, sf):
    text = plan(pk.key_pairs(*people(spark, sf), 1))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all(len(s.split(",")) <= 5 for s in schemas)


def test_candidates_need_no_distinct(spark, sf):
    left, right = people(spark, sf)
    pairs = scoring.candidates(left, right).select(*PAIR)
    assert pairs.count() == pairs.distinct().count()


# ------------------------------------------------------------------------------------- links
def test_links_are_the_lowest_of_all_single_keys(spark, sf):
    left, right = people(spark, sf)
    found = [pk.key_pairs(left, right, n).withColumn("mkey", F.lit(n)) for n in pk.BY_NUMBER]
    single = best_key(reduce(DataFrame.unionByName, found))
    assert rows(single, *PAIR, "mkey") == rows(stage(spark, sf, "links"), *PAIR, "mkey")


@pytest.mark.parametrize("name", [n for n in ORACLES if re.match(r"[kh]\d\d_", n)])
def test_single_keys_in_cells(spark, sf, duck, monkeypatch, name):
    monkeypatch.setattr(blocks, "CELL_ROWS", 2)
    got = QUERIES[name](spark, sf)
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]}) q").fetchall()
    assert rows(got, *got.columns) == sorted(want)


def test_best_key_is_idempotent(spark, sf):
    links = stage(spark, sf, "links")
    assert rows(best_key(links.unionByName(links)), *PAIR, "mkey") == rows(links, *PAIR, "mkey")


def test_missing_values_never_link(spark):
    blank = {c: None for c in pk.CARRIED} | {"id": "x"}
    schema = ", ".join(f"{c} {'int' if c in ('age', 'sex') else 'string'}" for c in blank)
    df = spark.createDataFrame([tuple(blank.values())], schema)
    left = df.select([F.col(c).alias(c + "_l") for c in df.columns])
    right = df.select([F.col(c).alias(c + "_r") for c in df.columns])
    assert pk.link_people(left, right).count() == 0


def test_hot_blocks_do_not_change_links(spark, sf, monkeypatch):
    expected = rows(stage(spark, sf, "links"), *PAIR, "mkey")
    households_expected = rows(stage(spark, sf, "household_links"), "hh_id_l", "hh_id_r", "hkey")
    monkeypatch.setattr(blocks, "CELL_ROWS", 2)
    assert rows(pk.link_people(*people(spark, sf)), *PAIR, "mkey") == expected
    assert rows(hk.link_households(*households(spark, sf)), "hh_id_l", "hh_id_r", "hkey") == households_expected


def test_cells_read_the_files_once(spark, sf, monkeypatch):
    """The hot list is stored: cut joins scan no more than whole ones, and read the list besides."""
    def scans(df):
        return len(re.findall(r"Scan parquet \[(?!block#)", plan(df)))

    whole = scans(hk.link_households(*households(spark, sf)))
    monkeypatch.setattr(blocks, "CELL_ROWS", 2)
    assert scans(hk.link_households(*households(spark, sf))) <= whole + 2


def test_hot_postcodes_do_not_change_candidates(spark, sf, monkeypatch):
    left, right = people(spark, sf)
    expected = rows(scoring.candidates(left, right), *PAIR)
    monkeypatch.setattr(blocks, "CELL_ROWS", 2)
    assert rows(scoring.candidates(left, right), *PAIR) == expected


def test_a_hot_list_too_long_to_broadcast_is_shuffled(spark, sf, monkeypatch):
    left, right = households(spark, sf)
    expected = rows(hk.household_key_pairs(left, right, 14), "hh_id_l", "hh_id_r")
    monkeypatch.setattr(blocks, "CELL_ROWS", 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = hk.household_key_pairs(left, right, 14)
        assert "BroadcastHashJoin" not in plan(found)
        assert rows(found, "hh_id_l", "hh_id_r") == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_presearch_of_the_unlinked(spark, sf):
    left, right = people(spark, sf)
    links = stage(spark, sf, "links")
    found = ps.presearch(left, right, links)
    held = {r["id_l"] for r in links.select("id_l").collect()}
    everyone = rows(ps.presearch(left, right), *PAIR)
    got = rows(found, *PAIR)
    assert got and set(got) <= set(everyone) and not {a for a, _ in got} & held


@pytest.mark.parametrize("number", ps.NAMESAKE_PASSES)
def test_namesakes_stand_for_their_pairs(spark, sf, number):
    left, right = people(spark, sf)
    members, expected = ps.namesakes(left, right, number), rows(ps.presearch_pairs(left, right, number), *PAIR)
    assert sorted(rows(ps.namesake_pairs(members), *PAIR)) == sorted(expected)
    assert members.count() <= left.count() + right.count()
    made = ps.namesake_groups(members).agg({"n_pairs": "sum"}).first()[0]
    assert made >= len(expected) > 0


# ------------------------------------------------------------------------------------- scores
def _weights(spark, m=0.9, u=0.01):
    names = ("fn1", "sn1", "sex", "dob")
    return (
        spark.createDataFrame([(v, m) for v in names], "variable string, m_value double"),
        spark.createDataFrame([(v, u) for v in names], "variable string, u_value double"),
    )


@pytest.mark.parametrize("agreement, expected", [(1.0, 6.491853), (2 / 3, -0.041001), (0.5, -3.307429), (0.0, -3.307429)])
def test_worked_weight(spark, agreement, expected):
    row = mu.weight_row(*_weights(spark))
    one = row.select(F.struct(*row.columns).alias("w"), F.lit(agreement).alias("dob_agreement"),
                     F.lit("a").alias("dob_l"), F.lit("b").alias("dob_r"))
    got = one.select(scoring.weight("dob", F.col("w")).alias("x")).first()["x"]
    assert got == pytest.approx(expected, abs=1e-6)


def test_scores_do_not_depend_on_the_order_of_sides(spark):
    names = [("ANNA", "ANNE"), ("BOB", "ROBERT"), ("A", None)]
    df = spark.createDataFrame(names, "fn1_l string, fn1_r string").select(
        "*", *[F.col(f"fn1{s}").alias(f"{c}{s}") for c in ("fn", "sn", "sn1") for s in ("_l", "_r")])
    swapped = df.select([F.col(c[:-2] + ("_r" if c.endswith("_l") else "_l")).alias(c) for c in df.columns])
    a, b = [scoring.with_name_scores(d).select(scoring.name_agreement("fn1").alias("x")).collect() for d in (df, swapped)]
    assert a == b


def test_band_edges(spark):
    scores = spark.createDataFrame([(7.3,), (7.5,), (0.0,), (-1.0,), (0.5,)], "match_score double")
    got = sorted(r["score_min"] for r in banded(scores).collect())
    assert got == [0.0, 0.0, 0.5, 7.0, 7.0, 7.5]


def test_bands_count_matched_pairs(spark):
    scored = spark.createDataFrame([("a", "x", 10.0), ("b", "y", 10.25)], "id_l string, id_r string, match_score double")
    linked = spark.createDataFrame([("a", "x", 1)], "id_l string, id_r string, mkey int")
    got = rows(score_bands(scored, linked), "score_min", "total_pairs", "matched_mkeys", "not_matched_mkeys")
    assert got == [(9.5, 1, 1, 0), (10.0, 2, 1, 1)]


def test_random_pairing_is_repeatable_and_uses_each_record_once(spark, sf):
    left, right = people(spark, sf)
    first, second = rows(mu.random_pairs(left, right), *PAIR), rows(mu.random_pairs(left, right), *PAIR)
    assert first == second and len(first) == min(left.count(), right.count())
    other = rows(mu.random_pairs(left, right, seed="v"), *PAIR)
    assert other != first


# ---------------------------------------------------------------------------- combine, review
def test_clerical_flag_rules(spark):
    links = spark.createDataFrame(
        [("a", "x", 1), ("b", "y", 14), ("c", "z", 2), ("c", "w", 3)], "id_l string, id_r string, mkey int")
    scored = spark.createDataFrame(
        [("d", "v", 50.0), ("e", "u", 40.0), ("f", "t", 8.4), ("a", "x", 20.0)], "id_l string, id_r string, match_score double")
    got = {(r["id_l"], r["id_r"]): (r["clerical"], r["mkey"], r["match_score"]) for r in cb.combine(links, scored).collect()}
    assert got == {
        ("a", "x"): (0, 1, 20.0), ("b", "y"): (1, 14, None), ("c", "z"): (1, 2, None), ("c", "w"): (1, 3, None),
        ("d", "v"): (0, None, 50.0), ("e", "u"): (1, None, 40.0),
    }


def test_latest_load_wins_and_ties_stay(spark):
    loads = spark.createDataFrame(
        [("a", "x", 1, 1), ("a", "x", 0, 2), ("b", "y", 1, 1), ("b", "y", 0, 1)],
        "id_l string, id_r string, match_status int, load_no int")
    assert rows(latest(loads), "id_l", "match_status", "load_no") == [("a", 0, 2), ("b", 0, 1), ("b", 1, 1)]


def test_final_links(spark):
    combined = spark.createDataFrame(
        [("a", "x", 1, None, 0), ("b", "y", 2, None, 0), ("c", "z", None, 20.0, 1)],
        "id_l string, id_r string, mkey int, match_score double, clerical int")
    loads = spark.createDataFrame(
        [("a", "x", 1, 1), ("b", "y", 0, 1), ("c", "z", 0, 1), ("c", "z", 1, 2)],
        "id_l string, id_r string, match_status int, load_no int")
    got = rows(review.final_links(combined, loads), "id_l", "match_score", "mkey", "clerical")
    assert got == [("a", None, 1, 0), ("c", 99.0, None, 1)]


def test_no_loads_means_nothing_is_decided(spark, sf):
    links = stage(spark, sf, "links")
    none = src.read_decisions(spark, [])
    assert rows(cb.gold_pairs(links, none), *PAIR) == rows(cb.automatic(links), *PAIR)
    assert review.undecided(links, none).count() == links.count()


# --------------------------------------------------------------------------- cleaning, sources
def test_unknown_reference_day_postcode_makes_no_mover(spark):
    columns = "household_id string, refday_address string, refday_postcode string, refday_uprn string"
    raw_rows = [("1", "1 A, B", "AB1 1AA", "5"), ("2", "1 A, B", None, "5"), ("3", "-8", "AB1 1AA", "5"), ("4", None, "-9", "-9")]
    assert rows(movers(spark.createDataFrame(raw_rows, columns)), "hh_id", "pc_refday") == [("1", "AB11AA")]


def test_coded_uprns_are_missing(spark, sf):
    left, right = people(spark, sf)
    assert left.filter(F.col("uprn_l").isin("-9", "-8")).count() == 0
    assert right.filter(F.col("uprn_r").isin("-9", "-8")).count() == 0


def test_sets_of_the_two_sides_never_share_a_dummy(spark, sf):
    left, right = households(spark, sf)
    dummies = ["XXXXX", "YYYYY"]
    assert left.filter(F.array_contains("fn_set_l", dummies[1])).count() == 0
    assert right.filter(F.array_contains("fn_set_r", dummies[0])).count() == 0


def test_decision_loads_may_order_their_columns_differently(spark, tmp_path):
    (tmp_path / "1.csv").write_text("left_id;right_id;match_status\nL1;R1;1\nL2;R2;\n")
    (tmp_path / "2.csv").write_text("match_status;right_id;left_id\n0;R1;L1\n")
    got = rows(src.read_decisions(spark, [str(tmp_path / "1.csv"), str(tmp_path / "2.csv")]), *PAIR, "match_status", "load_no")
    assert sorted(got, key=str) == [("L1", "R1", 0, 2), ("L1", "R1", 1, 1), ("L2", "R2", None, 1)]


def test_stage_paths_carry_the_run_date():
    stages = out.Stages("/data/run", dt.date(2000, 1, 31))
    assert stages.path("links") == "/data/run/2000/01/31/links.parquet"
    assert stages.path("bands", "csv") == "/data/run/2000/01/31/bands.csv"


def test_whole_run_equals_the_stages(spark, sf, tmp_path):
    tables = ("left_people", "left_forms", "left_households", "right_people", "right_forms", "right_households",
              "nicknames", "areas", "willingness", "removals")
    raw_inputs = rn.Inputs(*[raw(spark, sf, f"raw_{t}") for t in tables])
    stages = out.Stages(str(tmp_path), dt.date(2000, 1, 31))
    loads = decisions(spark, sf)
    final = rn.run(stages, raw_inputs, loads, key_sample=stage(spark, sf, "links").limit(20), search_unlinked=True)
    left, right = people(spark, sf)
    scores = scoring.score_people(left, right, stage(spark, sf, "m_values"), mu.exact_u_values(left, right))
    expected = review.final_links(cb.combine(stage(spark, sf, "links"), scores), loads)
    columns = (*PAIR, "mkey", "clerical")
    assert sorted(rows(final, *columns), key=str) == sorted(rows(expected, *columns), key=str)
    assert rn.link_counts(stages, spark).count() > 10
    assert stages.read(spark, "left_removed").count() == inputs.left_stage(spark, sf).removed.count()

    handed = src.read_text_csv(spark, f"{tmp_path}/2000/01/31/review/people_pairs.csv")
    batch = stages.read(spark, "review_batch")
    assert rows(handed, "unique_id", "dataset") == rows(batch, "unique_id", "dataset") and handed.count() > 0
    size = stages.read(spark, "review_batch_size").first()
    assert size["n_rows"] == handed.count()
    report = src.read_text_csv(spark, stages.path("score_bands", "csv"))
    assert report.count() == stages.read(spark, "score_bands").count() > 0
    sample = stages.read(spark, "key_quality_batch")
    assert sample.count() == src.read_text_csv(spark, f"{tmp_path}/2000/01/31/review/key_quality_pairs.csv").count() > 0
    assert stages.read(spark, "presearch_pairs").columns == [*PAIR, "search_pass"]


def test_a_later_review_carries_the_clusters_on(spark, sf, tmp_path):
    loads = decisions(spark, sf)
    first, second, full = (out.Stages(str(tmp_path), dt.date(2000, 1, day)) for day in (1, 2, 3))
    for stages in (first, second, full):
        stages.write(cb.clerical(stage(spark, sf, "combined")), "clerical_links")
    rn.review_stage(first, spark, loads.filter("load_no < 1"))
    names = ("unique_id", "cluster_number", "dataset")
    later = rows(rn.review_stage(second, spark, loads, earlier=first), *names)
    assert later == rows(rn.review_stage(full, spark, loads), *names) and later
    assert second.read(spark, "to_review").count() < first.read(spark, "to_review").count()


def test_weights_of_shares_at_the_ends(spark):
    m, u = _weights(spark, 0.9, 0.0)
    row = mu.weight_row(m, u, least=1e-6).first()
    assert row["dob_agreement_weight"] == pytest.approx(19.78, abs=0.01) and None not in tuple(row)
    with pytest.raises(Exception, match="no fn1_agreement_weight"):
        mu.checked(mu.weight_row(m, u)).collect()


def test_digits_of_blank_text(spark):
    got = spark.createDataFrame([("",), ("a1b2",)], "x string").select(missing.digits_int(F.col("x")).alias("n")).collect()
    assert [r["n"] for r in got] == [None, 12]


def test_dates_one_edit_apart_equals_the_distance(spark):
    dates = ["1990-01-02", "1990-01-12", "1990-11-02", "2990-01-02", "1991-01-02", "1990-02-01", "190-01-02", "--", "-", "19XX-01-02"]
    a = spark.createDataFrame([(d,) for d in dates], "dob_l string")
    pairs = a.crossJoin(a.select(F.col("dob_l").alias("dob_r")))
    wrong = pairs.filter(pk.dates_one_edit_apart() != (F.levenshtein("dob_l", "dob_r") < 2))
    assert pairs.count() == 100 and wrong.count() == 0
