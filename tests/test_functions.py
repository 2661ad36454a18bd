"""Golden values of the scalar functions, and the missing and masked cases around them."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from pairloom.config import FLOOR_TERMS
from pairloom.functions import address as ad, geography as geo, missing as mis, names as nm, sets as st, similarity as sim


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize("function, text, expected", [
    (nm.clean_names_nospace, "JOHN SMITH 2000", "JOHNSMITH"),
    (nm.clean_names_az, "JOHN SMITH 2000", "JOHN SMITH"),
    (nm.hyphen_to_space, "CHARLIE WILLIAM-JOSEPH", "CHARLIE WILLIAM JOSEPH"),
    (nm.hyphen_to_space, "A--B", "A B"),
    (nm.space_to_hyphen, "CHARLIE WILLIAM JOSEPH", "CHARLIE-WILLIAM-JOSEPH"),
    (nm.space_to_hyphen, " A ", "-A-"),
    (nm.single_space, "   CHARLIE   WILLIAM JOSEPH   ", "CHARLIE WILLIAM JOSEPH"),
    (nm.clean_names_az, "JOSÉ O'NEIL", "JOS ONEIL"),
    (nm.alpha, "CHARLIE", "ACEHILR"),
    (nm.remove_final_char, "PO15 5RR", "PO15 5R"),
    (nm.remove_final_char, "", ""),
    (nm.alpha, None, None),
    (ad.house_number, "FIRST FLOOR FLAT 20 PARK ROAD, TOWN", "20"),
    (ad.house_number, "FIRST FLOOR FLAT 20 PARK ROAD", None),
    (ad.house_number, "flat 3, 0, 012 park road, town", "12"),
    (ad.house_number, "Room 4 Unit 5 7 Mill Lane, Town", "7"),
    (ad.house_number, "PARK ROAD, 9", None),
    (ad.house_number, "00, PARK ROAD, TOWN", ""),
    (ad.house_number, None, None),
    (ad.flat_number, "FLAT 5, 15 PARK ROAD", "5"),
    (ad.flat_number, "APARTMENT 07, 15 PARK ROAD", "7"),
    (ad.flat_number, "APARTMENT 2 FLAT 3", "3"),
    (ad.flat_number, "FLAT 0, 15 PARK ROAD", None),
    (ad.flat_number, "15 PARK ROAD", None),
    (geo.clean_postcode, " po15 5rr", "PO155RR"),
    (geo.clean_postcode, "--", None),
    (geo.postcode_sector, "PO155RR", "PO155"),
    (geo.postcode_district, "PO155", "PO15"),
    (geo.postcode_district, "PO15", "PO1"),
    (geo.postcode_district, "B1", "B1"),
    (geo.postcode_area, "PO155", "PO"),
    (geo.postcode_area, "B15", "B"),
    (geo.iso_birth_date, "31121990", "1990-12-31"),
])
def test_text_functions(spark, function, text, expected):
    assert value(spark, function(lit(text).cast("string"))) == expected


def test_replace_all_takes_terms_in_order(spark):
    assert value(spark, ad.replace_all(lit("FIRST FLOOR FLAT 20 PARK ROAD"), FLOOR_TERMS)) == "20 PARK ROAD"


def test_name_words_keep_gaps_left_by_removed_words(spark):
    assert value(spark, nm.name_words(lit("ANNA-MARIA  LEE"))) == ["ANNA", "MARIA", "LEE"]
    assert value(spark, nm.name_words(lit("ANNA 2 LEE"))) == ["ANNA", "", "LEE"]


@pytest.mark.parametrize("first, middle, expected", [
    ("JOHN", "PAUL", "JOHN PAUL"), ("", "", ""), (None, "PAUL", "PAUL"), ("JOHN", None, "JOHN"), (None, None, ""),
])
def test_forenames(spark, first, middle, expected):
    assert value(spark, nm.forenames(lit(first).cast("string"), lit(middle).cast("string"))) == expected


def test_full_name_needs_both_parts(spark):
    assert value(spark, nm.full_name(lit("ANN-MARY"), lit("O'NEIL"))) == "ANN MARY ONEIL"
    assert value(spark, nm.full_name(lit("ANN"), lit(None).cast("string"))) is None


@pytest.mark.parametrize("raw, expected", [
    ("02021990", {"dob": "1990-02-02", "year": "1990", "mon": "02", "day": "02"}),
    ("XX021990", {"dob": "1990-02-XX", "year": "1990", "mon": "02", "day": None}),
    ("XXXXXXXX", {"dob": None, "year": None, "mon": None, "day": None}),
    (None, {"dob": None, "year": None, "mon": None, "day": None}),
])
def test_birth_parts(spark, raw, expected):
    parts = geo.birth_parts(lit(raw).cast("string"), "X")
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first().asDict()
    assert row == expected


@pytest.mark.parametrize("raw, expected", [("3", 3), ("-9", None), ("", None), ("12 ", 12), (None, None), ("x", None)])
def test_coded_int_never_fails(spark, raw, expected):
    assert value(spark, mis.coded_int(lit(raw).cast("string"))) == expected


def test_codes(spark):
    assert value(spark, mis.code_to_null(lit("-9"), ("-9", "-8"))) is None
    assert value(spark, mis.code_to_null(lit("7"), ("-9", "-8"))) == "7"
    assert value(spark, mis.code_to_blank(lit("-9"), ("-9",))) == ""


def test_lev_score(spark):
    assert value(spark, sim.lev_score(lit("KITTEN"), lit("SITTING"))) == pytest.approx(1 - 3 / 7)
    assert value(spark, sim.lev_score(lit(""), lit(""))) is None
    assert value(spark, sim.lev_score(lit("A"), lit(None).cast("string"))) is None


def test_lev_above_is_strict_and_equals_the_score(spark):
    words = ["ANNA", "ANNE", "ANNABEL", "HANNA", "BOB", "ROBERT", "ROB", "A"]
    pairs = spark.createDataFrame(list(itertools.product(words, words)), "a string, b string")
    for t in (0.4, 0.5, 0.6, 0.8):
        wrong = pairs.filter(
            ~F.equal_null(sim.lev_above(F.col("a"), F.col("b"), t), sim.lev_score(F.col("a"), F.col("b")) > t)
        )
        assert wrong.count() == 0
    # 1 - 1/5 is exactly the threshold: a double score fails it, a single-precision one passes
    assert value(spark, sim.lev_above(lit("ABCDE"), lit("ABCDX"), 0.80)) is False
    row = spark.sql("SELECT array('ABCDE') a, array('ABCDX') b")
    assert row.select(st.max_lev_above(F.col("a"), F.col("b"), 0.80).alias("x")).first()["x"] is True


def test_lev_within(spark):
    assert value(spark, sim.lev_within(lit("ANNA"), lit("ANNE"), 1)) is True
    assert value(spark, sim.lev_within(lit("ANNA"), lit("BOB"), 1)) is False


def _random_words(n):
    rng = random.Random(7)
    return ["".join(rng.choice("ABCDE") for _ in range(rng.randint(1, 8))) for _ in range(n)]


def test_jaro_winkler_agrees_with_duckdb(spark, duck):
    words = _random_words(60) + ["CHARLIE", "CHARLES", "MARTHA", "MARHTA", "DIXON", "DICKSONX"]
    pairs = spark.createDataFrame(list(itertools.product(words, words)), "a string, b string")
    tests = {f"over{int(t * 100)}": sim.jaro_above("a", "b", t) for t in (0.6, 0.7, 0.8, 0.9)}
    got = pairs.select("a", "b", sim.jaro_winkler("a", "b").alias("j"), *[c.alias(n) for n, c in tests.items()]).toPandas()
    expected = duck.execute("SELECT jaro_winkler_similarity(a, b)::FLOAT AS j FROM got").fetchnumpy()["j"]
    assert (got["j"].to_numpy() == expected).all()
    for t in (0.6, 0.7, 0.8, 0.9):
        assert (got[f"over{int(t * 100)}"].to_numpy() == (expected.astype("float64") > t)).all()


def test_jaro_winkler_edges(spark):
    rows = spark.createDataFrame([("CHARLIE", "CHARLES"), ("", "A"), (None, "A"), ("A", "A")], "a string, b string")
    got = [r["j"] for r in rows.select(sim.jaro_winkler("a", "b").alias("j")).collect()]
    assert got[0] == pytest.approx(0.9428571428571428) and got[1:] == [0.0, None, 1.0]


@pytest.mark.parametrize("a, b, expected", [
    ("JOHN JOHN DAVE JIM", "JOHN DAVE", 1), ("JOHN DAVE", "JOHN", 0), ("JOHN JOHN", "JOHN DAVE", 0), ("A B", "B A C", 1),
])
def test_contained_name(spark, a, b, expected):
    assert value(spark, sim.contained_name(lit(a), lit(b))) == expected


def test_set_measures(spark):
    row = spark.sql(
        "SELECT array('Charlie','John','Steve','Bob') a, array('Dave','Charles') b, array(15,20,2) c, array(15,15,20,2,99) d,"
        " array('dog','dog','cat','fish') e, array('dog','fish') f"
    )
    got = row.select(
        st.max_lev(F.col("a"), F.col("b")).alias("lev"), st.max_jaro("a", "b").alias("jaro"),
        st.common_age(F.col("c"), F.col("d")).alias("ages"), st.common(F.col("e"), F.col("f")).alias("common"),
        st.shares(F.col("a"), F.col("b")).alias("shares"), st.shares_age(F.col("c"), F.col("d")).alias("near"),
    ).first()
    assert got["lev"] == pytest.approx(0.7142857142857143) and got["jaro"] == pytest.approx(0.9428571428571428)
    assert (got["ages"], got["common"], got["shares"], got["near"]) == (4, 2, False, True)
