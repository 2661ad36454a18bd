"""F01-F29: scalar functions over whole texts, whole files and all candidate pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import clean_sql as cs, key_sql as ks
from fixtures.catalog.registry import households, joined, people, plain, query, raw, rounded, table, text_of
from pairloom.functions import address as ad, geography as geo, jaro, names as nm, sets as st, similarity as sim
from pairloom.operators.blocks import celled_join
from pairloom.plans import person_keys as pk, scoring
from pairloom.plans.people import standardise, with_nickname
from pairloom.config import FLOOR_TERMS, SET_DUMMY

_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_UP = f"translate(text, '{_LOWER}', '{_UPPER}')"


def _texts(name: str, source: str, function, sql: str, keys: tuple[str, ...]):
    """A text function over every whole text of a table."""
    listed = ", ".join(keys)

    @query(name, f"SELECT {listed}, {sql} AS cleaned FROM {source}")
    def run(spark, sf):
        text = F.translate("text", _LOWER, _UPPER)
        return table(spark, sf, source).select(*keys, function(text).alias("cleaned"))


_texts("f01_clean_names_nospace", "documents", nm.clean_names_nospace, cs.nospace(_UP), ("doc_id",))
_texts("f02_clean_names_az", "documents", nm.clean_names_az, cs.az(_UP), ("doc_id",))
_texts("f03_hyphen_to_space", "documents", nm.hyphen_to_space, cs.hyphens(_UP), ("doc_id",))
_texts("f04_space_to_hyphen", "conversations", nm.space_to_hyphen, f"trim(replace({_UP}, ' ', '-'))", ("conv_id", "turn"))
_texts("f05_single_space", "documents", nm.single_space, cs.spaces(_UP), ("doc_id",))
_texts("f06_alpha", "conversations", lambda c: nm.alpha(nm.clean_names_nospace(c)), cs.alpha(cs.nospace(_UP)), ("conv_id", "turn"))
_texts("f07_remove_final_char", "conversations", nm.remove_final_char, f"left({_UP}, length({_UP}) - 1)", ("conv_id", "turn"))


def _pairs(spark, sf):
    """All candidate pairs with their names."""
    return scoring.candidates(*people(spark, sf), extra=("fullname", "fullname_ns"))


_ON_PAIRS = "FROM candidates c JOIN (SELECT DISTINCT id, fn1, sn1, fullname, fullname_ns FROM l) l ON l.id = c.id_l " \
    "JOIN (SELECT DISTINCT id, fn1, sn1, fullname, fullname_ns FROM r) r ON r.id = c.id_r"


@query(
    "f08_lev_score",
    "SELECT id_l, id_r, round(1 - levenshtein(l.fn1, r.fn1) / greatest(length(l.fn1), length(r.fn1)), 6) AS score " + _ON_PAIRS,
)
def f08(spark, sf):
    score = sim.lev_score(F.col("fn1_l"), F.col("fn1_r"))
    return rounded(_pairs(spark, sf).select("id_l", "id_r", score.alias("score")), "score")


@query(
    "f09_levenshtein_within",
    "SELECT id_l, id_r, levenshtein(l.fullname_ns, r.fullname_ns) < 3 AS close " + _ON_PAIRS,
)
def f09(spark, sf):
    close = sim.lev_within(F.col("fullname_ns_l"), F.col("fullname_ns_r"), 2)
    return _pairs(spark, sf).select("id_l", "id_r", close.alias("close"))


@query("f10_soundex", f"SELECT DISTINCT id, {ks.soundex('fn1')} AS fn1_sound, {ks.soundex('sn1')} AS sn1_sound FROM l")
def f10(spark, sf):
    left = pk.keyed(people(spark, sf)[0], "left")
    return plain(left, "id", "fn1_sound", "sn1_sound").distinct()


@query(
    "f11_jaro_winkler",
    "SELECT id_l, id_r, round(CAST(CAST(jaro_winkler_similarity(l.fn1, r.fn1) AS FLOAT) AS DOUBLE), 6) AS first_score, "
    "round(CAST(CAST(jaro_winkler_similarity(l.sn1, r.sn1) AS FLOAT) AS DOUBLE), 6) AS last_score " + _ON_PAIRS,
)
def f11(spark, sf):
    scores = {"first_score": jaro.jaro_winkler("fn1_l", "fn1_r"), "last_score": jaro.jaro_winkler("sn1_l", "sn1_r")}
    pairs = _pairs(spark, sf).select("id_l", "id_r", *[c.cast("double").alias(n) for n, c in scores.items()])
    return rounded(pairs, *scores)


@query(
    "f12_contained_name",
    f"SELECT id_l, id_r, CASE WHEN {ks.CONTAINED} THEN 1 ELSE 0 END AS contained " + _ON_PAIRS
    + " WHERE l.fullname IS NOT NULL AND r.fullname IS NOT NULL",
)
def f12(spark, sf):
    known = _pairs(spark, sf).dropna(subset=["fullname_l", "fullname_r"])
    return known.select("id_l", "id_r", sim.contained_name(F.col("fullname_l"), F.col("fullname_r")).alias("contained"))


def _household_measure(name: str, measure, sql: str, digits: int | None = None):
    value = f"round(CAST({sql} AS DOUBLE), {digits})" if digits else f"CAST({sql} AS INT)"

    @query(name, f"SELECT l.hh_id AS hh_id_l, r.hh_id AS hh_id_r, {value} AS measure FROM lh l JOIN rh r ON l.pc = r.pc")
    def run(spark, sf):
        pairs = celled_join(*households(spark, sf), ("pc",))
        m = F.round(measure().cast("double"), digits) if digits else measure().cast("int")
        return pairs.select("hh_id_l", "hh_id_r", m.alias("measure"))


_household_measure("f13_common", lambda: st.common(F.col("fn_set_l"), F.col("fn_set_r")), ks._common("fn"))
_household_measure(
    "f14_common_age", lambda: st.common_age(F.col("age_set_l"), F.col("age_set_r")),
    "len(list_filter(flatten([[abs(x - y) for y in r.age_set] for x in l.age_set]), lambda d: d <= 1))",
)
_household_measure(
    "f15_max_lev", lambda: st.max_lev(F.col("sn_set_l"), F.col("sn_set_r")),
    f"CAST({ks._best('sn', '1 - levenshtein(x, y) / greatest(length(x), length(y))')} AS FLOAT)", 6,
)
_household_measure(
    "f16_max_jaro", lambda: st.max_jaro("fn_set_l", "fn_set_r"),
    f"CAST({ks._best('fn', 'jaro_winkler_similarity(x, y)')} AS FLOAT)", 6,
)

_ADDRESSES = (
    "SELECT address FROM raw_left_forms UNION SELECT display_address FROM raw_left_forms UNION SELECT address_raw FROM raw_left_forms "
    "UNION SELECT address FROM raw_right_forms UNION SELECT display_address FROM raw_right_forms"
)


def _addresses(spark, sf):
    left, right = raw(spark, sf, "raw_left_forms"), raw(spark, sf, "raw_right_forms")
    lines = [left.select(F.col(c).alias("address")) for c in ("address", "display_address", "address_raw")]
    lines += [right.select(F.col(c).alias("address")) for c in ("address", "display_address")]
    return lines[0].union(lines[1]).union(lines[2]).union(lines[3]).union(lines[4]).distinct()


@query("f17_house_number", f"SELECT address, {cs.house_number('address')} AS house_no FROM ({_ADDRESSES}) a")
def f17(spark, sf):
    return _addresses(spark, sf).select("address", ad.house_number(F.col("address")).alias("house_no"))


@query("f18_flat_number", f"SELECT address, {cs.flat_number('address')} AS flat_no FROM ({_ADDRESSES}) a")
def f18(spark, sf):
    return _addresses(spark, sf).select("address", ad.flat_number(F.col("address")).alias("flat_no"))


def _without_terms(x):
    for t in cs.FLOOR_TERMS:
        x = f"trim(replace({x}, '{t}', ''))"
    return x


@query("f19_replace_all", f"SELECT address, {_without_terms('upper(address)')} AS shortened FROM ({_ADDRESSES}) a")
def f19(spark, sf):
    return _addresses(spark, sf).select("address", ad.replace_all(F.upper("address"), FLOOR_TERMS).alias("shortened"))


_PARTS = ("fn1", "fn2", "sn1", "sn2", "res_fn1", "res_fn2", "res_sn1", "res_sn2")


@query("f20_name_split", f"SELECT DISTINCT id, {', '.join(_PARTS)} FROM r")
def f20(spark, sf):
    return plain(people(spark, sf)[1], "id", *_PARTS).distinct()


@query("f21_full_names", "SELECT DISTINCT id, forenames, fullname, fullname_ns, alphaname FROM l")
def f21(spark, sf):
    return plain(people(spark, sf)[0], "id", "forenames", "fullname", "fullname_ns", "alphaname").distinct()


@query("f22_birth_parts", "SELECT DISTINCT id, dob, year, mon, day FROM r")
def f22(spark, sf):
    return plain(people(spark, sf)[1], "id", "dob", "year", "mon", "day").distinct()


@query("f23_birth_date", "SELECT DISTINCT id, CAST(TRY_CAST(dob AS DATE) AS VARCHAR) AS birth_date FROM r")
def f23(spark, sf):
    right = plain(people(spark, sf)[1], "id", "dob")
    return right.select("id", F.try_to_date("dob", "yyyy-MM-dd").cast("string").alias("birth_date")).distinct()


@query(
    "f24_clean_postcode",
    f"SELECT DISTINCT qid, {cs.postcode('address_postcode')} AS pc, replace(address_postcode, ' ', '') AS despaced FROM raw_right_forms",
)
def f24(spark, sf):
    pc = F.col("address_postcode")
    forms = raw(spark, sf, "raw_right_forms")
    return forms.select("qid", geo.clean_postcode(pc).alias("pc"), geo.despaced(pc).alias("despaced")).distinct()


@query("f25_postcode_parts", "SELECT DISTINCT id, pc, pc_sect, pc_dist, pc_area, pc_substr FROM r")
def f25(spark, sf):
    return plain(people(spark, sf)[1], "id", "pc", "pc_sect", "pc_dist", "pc_area", "pc_substr").distinct()


@query(
    "f26_builtins",
    "SELECT DISTINCT id, substr(fn1, 1, 2) AS fn1_start, upper(mode) AS mode, contains(coalesce(fullname, ''), 'JO') AS has_jo, "
    "CASE WHEN age IS NOT NULL THEN round(log2(greatest(age, 1)), 6) END AS log_age, CAST(abs(age - 40) AS INT) AS from_forty FROM l",
)
def f26(spark, sf):
    left = people(spark, sf)[0]
    return rounded(
        left.select(
            F.col("id_l").alias("id"), F.left("fn1_l", F.lit(2)).alias("fn1_start"), F.upper("mode_l").alias("mode"),
            F.coalesce(F.col("fullname_l"), F.lit("")).contains("JO").alias("has_jo"),
            F.when(F.col("age_l").isNotNull(), F.log2(F.greatest(F.col("age_l"), F.lit(1)))).alias("log_age"),
            F.abs(F.col("age_l") - 40).alias("from_forty"),
        ).distinct(),
        "log_age",
    )


_SETS = ("fn_set", "sn_set", "dob_set", "age_set")


@query("f27_person_sets", f"SELECT hh_id, hh_size, {text_of(*_SETS)} FROM lh")
def f27(spark, sf):
    return joined(plain(households(spark, sf)[0], "hh_id", "hh_size", *_SETS), *_SETS)


@query(
    "f28_side_dummies",
    f"SELECT hh_id, {text_of(*_SETS)} FROM rh WHERE hh_size IS NULL OR list_contains(fn_set, 'YYYYY') OR list_contains(sn_set, 'YYYYY') "
    "OR list_contains(dob_set, DATE '1700-07-07') OR list_contains(age_set, 777)",
)
def f28(spark, sf):
    right, dummy = plain(households(spark, sf)[1], "hh_id", "hh_size", *_SETS), SET_DUMMY["right"]
    missing = (
        F.col("hh_size").isNull()
        | F.array_contains("fn_set", dummy["name"]) | F.array_contains("sn_set", dummy["name"])
        | F.array_contains("dob_set", F.lit(dummy["dob"]).cast("date")) | F.array_contains("age_set", dummy["age"])
    )
    return joined(right.filter(missing).drop("hh_size"), *_SETS)


@query("f29_nickname_lookup", "SELECT id, fn1, fn1_nickname FROM right_all")
def f29(spark, sf):
    named = standardise(raw(spark, sf, "raw_right_people"), "right")
    return with_nickname(named, raw(spark, sf, "raw_nicknames")).select("id", "fn1", "fn1_nickname")
