"""S, P, J, A, W, O and U rows: sources, projections, joins, aggregates, windows, sorts and unions."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from fixtures import clean_sql as cs, inputs, key_sql as ks, score_sql as ss
from fixtures.catalog.registry import (
    decisions, gold, households, joined, people, plain, query, raw, rounded, scored_with, stage, table, text_of,
)
from pairloom.config import CODES_TO_BLANK, CODES_TO_NULL
from pairloom.functions import missing as mis, names as nm
from pairloom.functions.similarity import lev_above, lev_within
from pairloom.operators import mu
from pairloom.operators.bands import score_bands
from pairloom.operators.blocks import celled_join
from pairloom.operators.columns import count_by, one_per_key, with_side
from pairloom.operators.components import cluster_number
from pairloom.operators.numbering import numbered, shuffled_order
from pairloom.operators.pairs import PAIR, agree, best_key, latest, with_id_counts
from pairloom.plans import clerical as review, combine as cb, household_keys as hk, people as pp, person_keys as pk, scoring
from pairloom.session import checkpoint_dir, scratch_path
from pairloom.sources import stages as out, tables as src
from pairloom.sources.stages import Stages

DAY = dt.date(2000, 1, 31)


def _stages(spark) -> Stages:
    return Stages(scratch_path(spark, "run"), DAY)


# ------------------------------------------------------------------------- sources, sinks
# a blank cell is read as NULL
@query("s01_csv_scan", "SELECT * REPLACE (nullif(ethnic5, '') AS ethnic5, "
       "nullif(alternative_address_postcode, '') AS alternative_address_postcode) FROM raw_left_people")
def s01(spark, sf):
    path = out.write_csv(raw(spark, sf, "raw_left_people"), scratch_path(spark, "residents.csv"))
    return src.read_text_csv(spark, path)


@query("s01_csv_renamed", "SELECT household_id AS hh, resident_count AS n FROM raw_right_households")
def s01_renamed(spark, sf):
    path = out.write_csv(raw(spark, sf, "raw_right_households"), scratch_path(spark, "households.csv"))
    return src.read_text_csv(spark, path, {"hh": "household_id", "n": "resident_count"})


@query("s02_decision_loads", "SELECT id_l, id_r, match_status, load_no FROM decisions")
def s02(spark, sf):
    loads = raw(spark, sf, "raw_decisions")
    paths = []
    for n in (1, 2):
        path = scratch_path(spark, f"load{n}.csv")
        load = loads.filter(F.col("load_no") == n).select("left_id", "right_id", "match_status")
        load.write.option("sep", ";").csv(path, header=True)
        paths.append(path)
    return src.read_decisions(spark, paths)


@query("s03_parquet_scan", "SELECT c_custkey, c_name FROM customer")
def s03(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name")


@query("s04_catalog_table", "SELECT pcd AS pc, laua AS la FROM raw_areas")
def s04(spark, sf):
    name = f"postcode_lookup_{uuid.uuid4().hex}"
    raw(spark, sf, "raw_areas").write.option("path", scratch_path(spark, name)).saveAsTable(name)
    return src.read_table(spark, name, {"pc": "pcd", "la": "laua"})


@query("s05_small_csv", "SELECT lsoa_code, CAST(willingness AS INT) AS willingness FROM raw_willingness")
def s05(spark, sf):
    path = out.write_csv(raw(spark, sf, "raw_willingness"), scratch_path(spark, "index.csv"))
    return src.read_small_csv(spark, path, "lsoa_code string, willingness int")


@query("s06_no_decisions", "SELECT id_l, id_r FROM links WHERE mkey NOT IN (14, 31, 32)")
def s06(spark, sf):
    return cb.gold_pairs(stage(spark, sf, "links"), src.no_decisions(spark))


@query("s07_parquet_sink", "SELECT id_l, id_r, mkey FROM links")
def s07(spark, sf):
    links, path = stage(spark, sf, "links"), scratch_path(spark, "links.parquet")
    out.write_parquet(links.filter("mkey = 1"), path)
    out.write_parquet(links, path)
    return spark.read.parquet(path)


@query("s08_review_csv", "SELECT unique_id, CAST(cluster_number AS VARCHAR) AS cluster_number, dataset FROM ("
       + ss.ingest("links_clustered") + ") b")
def s08(spark, sf):
    batch = review.ingest_rows(cluster_number(stage(spark, sf, "links").select(*PAIR), *PAIR))
    return src.read_text_csv(spark, out.write_review_csv(batch, scratch_path(spark, "outputs"), DAY))


def _bands(spark, sf):
    return score_bands(stage(spark, sf, "scores"), cb.automatic(stage(spark, sf, "links")))


@query("s09_threshold_csv", "SELECT score_min, total_pairs FROM bands")
def s09(spark, sf):
    path = out.write_one_csv(_bands(spark, sf), scratch_path(spark, "bands.csv"))
    schema = "score_min double, score_max double, total_pairs bigint, matched_mkeys bigint, not_matched_mkeys bigint"
    return src.read_small_csv(spark, path, schema).select("score_min", "total_pairs")


@query("s10_stage_dataset", "SELECT mkey, count(*) AS n FROM links GROUP BY mkey")
def s10(spark, sf):
    return count_by(_stages(spark).write(stage(spark, sf, "links"), "person_links"), "mkey")


@query("s11_lineage_cut", ks.person_links((1, 2, 3)))
def s11(spark, sf):
    checkpoint_dir(spark)
    left, right = people(spark, sf)
    linked = None
    for n in (1, 2, 3):
        found = pk.key_pairs(left, right, n).withColumn("mkey", F.lit(n))
        linked = best_key(found if linked is None else linked.unionByName(found)).checkpoint()
    return linked


@query("s12_parameter_tables", "SELECT variable, round(m_value, 6) AS m_value, round(u_value, 6) AS u_value FROM m_values JOIN u_values USING (variable)")
def s12(spark, sf):
    stages = _stages(spark)
    m, u = stages.write(stage(spark, sf, "m_values"), "m"), stages.write(stage(spark, sf, "u_values"), "u")
    return rounded(m.join(F.broadcast(u), "variable"), "m_value", "u_value")


# -------------------------------------------------------------------------- projections
@query("p01_project_rename", "SELECT resident_id AS id, household_id AS hh_id, mode FROM raw_right_people")
def p01(spark, sf):
    return src.renamed(raw(spark, sf, "raw_right_people"), {"id": "resident_id", "hh_id": "household_id", "mode": "mode"})


@query("p02_side_suffix", "SELECT pcd AS pcd_l, laua AS laua_l, rgn AS rgn_l, lsoa11 AS lsoa11_l FROM raw_areas")
def p02(spark, sf):
    return with_side(raw(spark, sf, "raw_areas"), "left")


@query("p03_codes_to_null", "SELECT household_id, " + ", ".join(
    f"{cs.codes(c, *CODES_TO_NULL[k])} AS {c}" for c, k in (
        ("ownership_type", "right_tenure"), ("accommodation_type", "right_accommodation"), ("resident_count", "right_residents"),
        ("refday_postcode", "address"))) + " FROM raw_right_households")
def p03(spark, sf):
    lists = {"ownership_type": "right_tenure", "accommodation_type": "right_accommodation",
             "resident_count": "right_residents", "refday_postcode": "address"}
    return raw(spark, sf, "raw_right_households").select(
        "household_id", *[mis.code_to_null(F.col(c), CODES_TO_NULL[k]).alias(c) for c, k in lists.items()]
    )


@query("p04_codes_to_blank", f"SELECT resident_id, {cs.blank('last_name', '-9')} AS last_name, "
       f"{cs.blank('resident_first_name', '-9', '-4')} AS resident_first_name, {cs.blank('resident_age', '-9')} AS resident_age "
       "FROM raw_left_people")
def p04(spark, sf):
    lists = {"last_name": "name", "resident_first_name": "resident_name", "resident_age": "age"}
    return raw(spark, sf, "raw_left_people").select(
        "resident_id", *[mis.code_to_blank(F.col(c), CODES_TO_BLANK[k]).alias(c) for c, k in lists.items()]
    )


@query("p05_coded_values", f"SELECT resident_id, {cs.coded('ethnic5')} AS ethnic5, {cs.coded('ethnic19')} AS ethnic19, "
       f"{cs.coded('marital_status')} AS marital_status FROM raw_right_people")
def p05(spark, sf):
    return raw(spark, sf, "raw_right_people").select(
        "resident_id", *[mis.coded_int(F.col(c)).alias(c) for c in ("ethnic5", "ethnic19", "marital_status")]
    )


@query("p06_blank_to_null", "SELECT resident_id, nullif(middle_name, '') AS middle_name, nullif(resident_age, '') AS resident_age FROM raw_right_people")
def p06(spark, sf):
    return raw(spark, sf, "raw_right_people").select(
        "resident_id", *[mis.blank_to_null(F.col(c)).alias(c) for c in ("middle_name", "resident_age")]
    )


@query("p07_address_fallback", "SELECT response_id AS form, address FROM left_form UNION ALL SELECT qid, address FROM right_form")
def p07(spark, sf):
    left = pp.left_forms(raw(spark, sf, "raw_left_forms")).select(F.col("response_id").alias("form"), "address")
    return left.union(pp.right_forms(raw(spark, sf, "raw_right_forms")).select("qid", "address"))


@query("p08_age_chain", "SELECT DISTINCT id, age FROM right_all")
def p08(spark, sf):
    return pp.standardise(raw(spark, sf, "raw_right_people"), "right").select("id", "age")


@query("p09_mover_flag", "SELECT hh_id, pc_refday, uprn_refday, house_no_refday FROM right_moves")
def p09(spark, sf):
    return pp.movers(raw(spark, sf, "raw_right_households")).drop("address_refday", "mover")


_MOVED = ("pc", "pc_intday", "pc_refday", "uprn", "uprn_intday", "house_no", "house_no_intday", "address", "address_intday")


@query("p10_mover_rewrite", f"SELECT DISTINCT id, {', '.join(_MOVED)} FROM r")
def p10(spark, sf):
    return plain(people(spark, sf)[1], "id", *_MOVED).distinct()


_HH_MOVED = ("pc", "pc_intday", "uprn", "flat_no", "flat_no_intday", "house_no", "tenure", "typaccom", "country_refday")


@query("p10_household_rewrite", f"SELECT hh_id, {', '.join(_HH_MOVED)} FROM rh")
def p10_households(spark, sf):
    return plain(households(spark, sf)[1], "hh_id", *_HH_MOVED)


@query("p11_students_left", "SELECT id AS id_l, hh_id AS hh_id_l, student_duplicate AS student_duplicate_l, pc AS pc_l, dob AS dob_l FROM left_students")
def p11_left(spark, sf):
    return inputs.left_stage(spark, sf).students


@query("p11_students_right", "SELECT id AS id_r, hh_id AS hh_id_r, student_duplicate AS student_duplicate_r, pc_intday AS pc_intday_r, "
       "pc_refday AS pc_refday_r, dob AS dob_r FROM right_students")
def p11_right(spark, sf):
    return inputs.right_stage(spark, sf).students


@query("p12_filters", "SELECT id_l, id_r FROM combined WHERE match_score BETWEEN 8.5 AND 40 AND mkey IS NOT NULL AND mkey NOT IN (14, 31, 32)")
def p12(spark, sf):
    return cb.clerical_by_score(cb.automatic(stage(spark, sf, "combined")).dropna(subset=["mkey"])).select(*PAIR)


@query("p12_household_filter", "SELECT hh_id, hh_size FROM lh WHERE hh_size IS NOT NULL AND hh_id <> '-9'")
def p12_households(spark, sf):
    return plain(hk.with_people(households(spark, sf)[0], "left"), "hh_id", "hh_size")


@query("p13_agree_or_missing", "SELECT DISTINCT l.id AS id_l, r.id AS id_r FROM l JOIN r ON l.uprn = r.uprn AND (l.sex = r.sex OR l.sex IS NULL OR r.sex IS NULL)")
def p13(spark, sf):
    return pk.at_one_uprn(*people(spark, sf))


@query("p14_two_of_three", f"SELECT l.hh_id AS hh_id_l, r.hh_id AS hh_id_r FROM lh l JOIN rh r ON l.uprn = r.uprn AND {ks.TWO}")
def p14(spark, sf):
    return celled_join(*households(spark, sf), ("uprn",), hk.two_answers_agree()).select("hh_id_l", "hh_id_r")


@query("p15_address_predicate", f"SELECT DISTINCT l.id AS id_l, r.id AS id_r FROM l JOIN r ON l.dob = r.dob AND l.sex = r.sex AND {ks.ADDR}")
def p15(spark, sf):
    left, right = people(spark, sf)
    routes = [celled_join(left, right, route).select(*PAIR) for route in pk.ADDRESS]
    return reduce(DataFrame.union, routes).distinct()


@query("p16_constants", "SELECT id_l, id_r, NULL::INT AS mkey, match_score > 40 AS accepted, 99::DOUBLE AS reviewed FROM scored WHERE match_score >= 8.5")
def p16(spark, sf):
    scores = stage(spark, sf, "likely_scores")
    return scores.select(
        *PAIR, F.lit(None).cast("int").alias("mkey"), (F.col("match_score") > 40).alias("accepted"), F.lit(99).cast("double").alias("reviewed")
    )


@query("p17_drops", "SELECT pc, la, region, id FROM (SELECT DISTINCT id, pc, la, region, htcw FROM r) x")
def p17(spark, sf):
    return plain(people(spark, sf)[1], "id", "pc", "la", "region", "htcw").distinct().drop("htcw")


@query("p18_casts", f"SELECT resident_id, sex, CAST(sex AS VARCHAR) AS sex_text, age FROM (SELECT resident_id, "
       f"{cs.digits(cs.codes('sex', *CODES_TO_NULL['sex']))} AS sex, "
       f"TRY_CAST({cs.blank('resident_age', *CODES_TO_BLANK['age'])} AS INT) AS age FROM raw_left_people) p")
def p18(spark, sf):
    left = raw(spark, sf, "raw_left_people").select(
        "resident_id", mis.digits_int(mis.code_to_null(F.col("sex"), CODES_TO_NULL["sex"])).alias("sex"),
        mis.as_int(mis.code_to_blank(F.col("resident_age"), CODES_TO_BLANK["age"])).alias("age"),
    )
    return left.select("resident_id", "sex", F.col("sex").cast("string").alias("sex_text"), "age")


# ---------------------------------------------------------------------------------- joins
def _people_join(name: str, on: tuple[str, ...], where, sql: str):
    @query(name, f"SELECT DISTINCT l.id AS id_l, r.id AS id_r FROM l JOIN r ON {sql}")
    def run(spark, sf):
        left, right = people(spark, sf)
        left, right = pk.keyed(left, "left"), pk.keyed(right, "right")
        return celled_join(left, right, on, where() if where else None).select(*PAIR).distinct()


_people_join("j01_equi_join", ("dob", "sex", "pc"), None, "l.dob = r.dob AND l.sex = r.sex AND l.pc = r.pc")
_people_join("j02_fuzzy_residual", ("pc", "sex"), lambda: lev_within(F.col("dob_l"), F.col("dob_r"), 1),
             "l.pc = r.pc AND l.sex = r.sex AND levenshtein(l.dob, r.dob) < 2")
_people_join("j03_computed_key", ("fn1_start", "sn1_sound", "dob"), None,
             f"substr(l.fn1, 1, 2) = substr(r.fn1, 1, 2) AND l.dob = r.dob AND {ks.soundex('l.sn1')} = {ks.soundex('r.sn1')}")
_people_join("j04_disjunctive_residual", ("dob", "sex", "fn_initial", "sn_initial"), pk.both_names,
             f"l.dob = r.dob AND l.sex = r.sex AND {ks.FN} AND {ks.SN}")
_people_join("j05_band_join", ("pc", "sex"), lambda: pk.ages_within(5), "l.pc = r.pc AND l.sex = r.sex AND abs(l.age - r.age) < 6")


@query("j06_array_equality", "SELECT l.hh_id AS hh_id_l, r.hh_id AS hh_id_r FROM lh l JOIN rh r ON l.pc = r.pc AND l.sn_set = r.sn_set")
def j06(spark, sf):
    return celled_join(*households(spark, sf), ("pc", "sn_set")).select("hh_id_l", "hh_id_r")


@query("j07_lookup_join", "SELECT DISTINCT id, pc_intday, la, region, htcw FROM r")
def j07(spark, sf):
    return plain(people(spark, sf)[1], "id", "pc_intday", "la", "region", "htcw").distinct()


@query("j08_indicator_join", "SELECT s.id_l, s.id_r, k.mkey, CASE WHEN k.mkey IS NOT NULL THEN 1 END AS keyed FROM scored s "
       "LEFT JOIN (SELECT * FROM links WHERE mkey NOT IN (14, 31, 32)) k ON k.id_l = s.id_l AND k.id_r = s.id_r")
def j08(spark, sf):
    keyed = cb.automatic(stage(spark, sf, "links")).withColumn("keyed", F.lit(1))
    return stage(spark, sf, "scores").select(*PAIR).join(keyed, PAIR, "left")


@query("j09_restricting_join", "SELECT g.id_l, g.id_r, l.fn1 AS fn1_l, r.fn1 AS fn1_r, l.sex AS sex_l, r.sex AS sex_r FROM gold g "
       "JOIN l ON l.id = g.id_l JOIN r ON r.id = g.id_r")
def j09(spark, sf):
    return mu.records_of(gold(spark, sf), *people(spark, sf), variables=("fn1", "sex"))


@query("j10_left_anti", "SELECT id_l, id_r FROM to_review")
def j10(spark, sf):
    return review.undecided(cb.clerical(stage(spark, sf, "combined")).select(*PAIR), decisions(spark, sf))


@query("j11_rejected_out", "SELECT id_l, id_r, mkey FROM links WHERE (id_l, id_r) NOT IN (SELECT (id_l, id_r) FROM newest WHERE match_status = 0)")
def j11(spark, sf):
    rejected = review.verdicts(decisions(spark, sf))[1]
    return stage(spark, sf, "links").join(rejected, PAIR, "left_anti").select(*PAIR, "mkey")


@query("j12_random_pairing", "SELECT id_l, id_r FROM random_pairs")
def j12(spark, sf):
    return mu.random_pairs(*people(spark, sf)).select(*PAIR)


@query("j13_cluster_join_back", "SELECT id_l, id_r, cluster_number, mkey FROM links_clustered JOIN links USING (id_l, id_r)")
def j13(spark, sf):
    return cluster_number(stage(spark, sf, "links"), *PAIR).select(*PAIR, "cluster_number", "mkey")


# ---------------------------------------------------------------------- aggregates, distinct
@query("a01_key_counts", "SELECT mkey, count(*) AS n FROM links GROUP BY mkey")
def a01(spark, sf):
    return pk.key_counts(stage(spark, sf, "links"))


@query("a01_household_key_counts", "SELECT hkey, count(*) AS n FROM household_links GROUP BY hkey")
def a01_households(spark, sf):
    return hk.household_key_counts(stage(spark, sf, "household_links"))


@query("a02_global_max", "SELECT round(max(match_score), 6) AS top_score FROM scored")
def a02(spark, sf):
    scores = scoring.match_scores(*scored_with(spark, sf))
    return rounded(scores.agg(F.max("match_score").alias("top_score")), "top_score")


@query("a05_score_bands", "SELECT * FROM bands")
def a05(spark, sf):
    return _bands(spark, sf)


_SETS = ("fn_set", "sn_set", "dob_set", "age_set")


@query("a06_household_sets", f"SELECT hh_id, hh_size, {text_of(*_SETS)} FROM rh")
def a06(spark, sf):
    return joined(plain(households(spark, sf)[1], "hh_id", "hh_size", *_SETS), *_SETS)


@query("a07_distinct_rows", "SELECT DISTINCT response_id, address, address_postcode, uprn FROM raw_left_forms")
def a07(spark, sf):
    return raw(spark, sf, "raw_left_forms").select("response_id", "address", "address_postcode", "uprn").distinct()


@query("a08_distinct_on_key", "SELECT qid, address, pc, uprn FROM right_form")
def a08(spark, sf):
    return pp.right_forms(raw(spark, sf, "raw_right_forms"))


@query("a09_agreement_sums", "SELECT " + ", ".join(
    f"CAST(sum(CASE WHEN l.{v} = r.{v} THEN 1 ELSE 0 END) AS BIGINT) AS {v}" for v in ss.VARIABLES)
    + ", count(*) AS pairs FROM gold g JOIN l ON l.id = g.id_l JOIN r ON r.id = g.id_r")
def a09(spark, sf):
    return mu.agreement_counts(mu.records_of(gold(spark, sf), *people(spark, sf)))


@query("a10_batch_size", f"SELECT count(*) AS n_rows, max(cluster_number) AS n_clusters FROM ({ss.ingest('links_clustered')}) b")
def a10(spark, sf):
    return review.batch_size(review.ingest_rows(cluster_number(stage(spark, sf, "links").select(*PAIR), *PAIR)))


# --------------------------------------------------------------------------------- windows
def _key_union(numbers):
    return " UNION ALL ".join(f"SELECT id_l, id_r, {n} AS mkey FROM ({ks.person_pairs(n)}) k{n}" for n in numbers)


@query("w01_best_key", f"SELECT id_l, id_r, min(mkey) AS mkey FROM ({_key_union((3, 12, 20))}) u GROUP BY id_l, id_r")
def w01(spark, sf):
    left, right = people(spark, sf)
    found = [pk.key_pairs(left, right, n).withColumn("mkey", F.lit(n)) for n in (3, 12, 20)]
    return best_key(reduce(DataFrame.unionByName, found))


@query("w02_latest_load", "SELECT id_l, id_r, match_status, load_no FROM newest")
def w02(spark, sf):
    return latest(decisions(spark, sf)).select(*PAIR, "match_status", "load_no")


@query("w03_best_over_methods", "SELECT id_l, id_r, round(max(match_score), 6) AS match_score, min(mkey) AS mkey FROM combined GROUP BY id_l, id_r")
def w03(spark, sf):
    both = cb.combine(stage(spark, sf, "links"), stage(spark, sf, "likely_scores"))
    return rounded(both.select(*PAIR, "match_score", "mkey"), "match_score")


@query("w04_conflicts", "SELECT id_l, id_r, count(*) OVER (PARTITION BY id_l) AS id_l_count, count(*) OVER (PARTITION BY id_r) AS id_r_count FROM links")
def w04(spark, sf):
    return with_id_counts(stage(spark, sf, "links")).select(*PAIR, "id_l_count", "id_r_count")


@query("w05_moved_together", ks.person_pairs(28))
def w05(spark, sf):
    left, right = people(spark, sf)
    met = celled_join(pk.keyed(left, "left"), pk.keyed(right, "right"), ("dob", "sex", "fn_initial", "sn_initial"), pk.both_names())
    return pk.moved_together(met)


@query("w06_lowest_flag", "SELECT id_l, id_r, clerical FROM final_links")
def w06(spark, sf):
    return review.final_links(stage(spark, sf, "combined"), decisions(spark, sf)).select(*PAIR, "clerical")


@query("w07_dense_numbers", "SELECT o_custkey, dense_rank() OVER (ORDER BY md5(CAST(o_custkey AS VARCHAR))) AS number FROM (SELECT DISTINCT o_custkey FROM orders) o")
def w07(spark, sf):
    customers = table(spark, sf, "orders").select("o_custkey").distinct()
    return numbered(customers, shuffled_order(F.col("o_custkey").cast("string")), ["o_custkey"], "number")


@query("w08_set_sizes", "SELECT hh_id, len(fn_set) AS first_names, len(sn_set) AS last_names FROM lh WHERE hh_size IS NOT NULL")
def w08(spark, sf):
    left = hk.with_people(households(spark, sf)[0], "left")
    sizes = {"first_names": "fn_set_l", "last_names": "sn_set_l"}
    return left.select(F.col("hh_id_l").alias("hh_id"), *[F.size(c).cast("long").alias(n) for n, c in sizes.items()])


# ------------------------------------------------------------------------------ sorts, unions
@query("o01_output_sort", "SELECT mkey, count(*) AS n FROM links GROUP BY mkey ORDER BY mkey")
def o01(spark, sf):
    return pk.key_counts(stage(spark, sf, "links")).orderBy("mkey")


@query("o02_random_order", "SELECT DISTINCT id, md5('seed' || id) AS place FROM r")
def o02(spark, sf):
    return plain(people(spark, sf)[1], "id").distinct().select("id", shuffled_order(F.col("id"), "seed").alias("place"))


@query("o03_row_numbers", "SELECT id, row_number() OVER (ORDER BY md5(id)) AS row_no FROM (SELECT DISTINCT id FROM l) x")
def o03(spark, sf):
    ids = plain(people(spark, sf)[0], "id").distinct()
    return numbered(ids, shuffled_order(F.col("id")), ["id"], "row_no")


@query("o04_one_row_result", "SELECT max(mkey) AS top_key, count(*) AS links FROM links")
def o04(spark, sf):
    return stage(spark, sf, "links").agg(F.max("mkey").alias("top_key"), F.count(F.lit(1)).alias("links"))


@query("u01_union_all", _key_union((2, 3)))
def u01(spark, sf):
    left, right = people(spark, sf)
    return pk.key_pairs(left, right, 2).withColumn("mkey", F.lit(2)).unionByName(
        pk.key_pairs(left, right, 3).withColumn("mkey", F.lit(3)))


@query("u02_union_by_name", ss.ingest("links_clustered"))
def u02(spark, sf):
    clustered = cluster_number(stage(spark, sf, "links").select(*PAIR), *PAIR)
    left = clustered.select(F.col("id_l").alias("unique_id"), "cluster_number", F.lit("left").alias("dataset")).distinct()
    right = clustered.select("cluster_number", F.lit("right").alias("dataset"), F.col("id_r").alias("unique_id")).distinct()
    return left.unionByName(right)


@query("u03_union_distinct", f"SELECT DISTINCT id_l, id_r FROM ({_key_union((3, 12))}) u")
def u03(spark, sf):
    left, right = people(spark, sf)
    return pk.key_pairs(left, right, 3).unionByName(pk.key_pairs(left, right, 12)).dropDuplicates(PAIR)
