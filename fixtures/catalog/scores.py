"""B, R and C rows: blocking, scores, combining, clusters and the clerical loop."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import score_sql as ss
from fixtures.catalog.registry import decisions, gold, people, query, raw, rounded, stage, table
from pairloom.operators import mu
from pairloom.operators.columns import count_by
from pairloom.operators.components import cluster_number, extended, numbered_clusters, pair_edges
from pairloom.operators.pairs import PAIR, latest
from pairloom.plans import clerical as review, combine as cb, scoring
from pairloom.plans.people import clean_left_people
from pairloom.session import staged

VARS = ss.VARIABLES
AGREE = [f"{v}_agreement" for v in VARS]
WEIGHT = [f"{v}_weight" for v in VARS]


def _round(*columns):
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


# ------------------------------------------------------------------------------ blocking
_PASSES = {
    1: ("pc_refday", "pc"), 2: ("pc_refday", "pc_alt"), 3: ("pc_intday", "pc"),
    4: ("pc_intday", "pc_alt"), 5: ("pc_alt", "pc"), 6: ("pc_alt", "pc_alt"),
}
for _n, (_right, _left) in _PASSES.items():

    @query(f"b{_n:02d}_blocking_pass", f"SELECT DISTINCT l.id AS id_l, r.id AS id_r FROM l JOIN r ON r.{_right} = l.{_left}")
    def one_pass(spark, sf, right_pc=_right, left_pc=_left):
        return scoring.one_pass(*people(spark, sf), left_pc, right_pc)


@query("b_all_blocking", "SELECT id_l, id_r FROM candidates")
def b_all(spark, sf):
    return scoring.candidates(*people(spark, sf)).select(*PAIR)


# ------------------------------------------------------------------------- probabilities
@query("r11_gold_pairs", "SELECT id_l, id_r FROM gold")
def r11(spark, sf):
    return gold(spark, sf)


@query("a03_m_values", f"SELECT variable, {_round('m_value')} FROM m_values")
def a03(spark, sf):
    return rounded(mu.m_values(gold(spark, sf), *people(spark, sf)), "m_value")


@query("a04_u_values", f"SELECT variable, {_round('u_value')} FROM u_values")
def a04(spark, sf):
    return rounded(mu.u_values(*people(spark, sf)), "u_value")


@query("a04_exact_u_values", "SELECT variable, round(u_value, 9) AS u_value FROM exact_u")
def a04_exact(spark, sf):
    return rounded(mu.exact_u_values(*people(spark, sf)), "u_value", digits=9)


@query("r05_weights", "SELECT " + ", ".join(
    f"round({v}_aw, 6) AS {v}_agreement_weight, round({v}_dw, 6) AS {v}_disagreement_weight" for v in VARS) + " FROM weights")
def r05(spark, sf):
    row = mu.weight_row(stage(spark, sf, "m_values"), stage(spark, sf, "u_values"), least=scoring.LEAST_SHARE)
    return rounded(row, *row.columns)


@query("a04_zero_u", "SELECT count(*) AS pairs, CAST(count(*) FILTER (WHERE l.dob = r.dob) AS BIGINT) AS same_dob, "
       "CAST(count(*) AS BIGINT) AS with_score FROM candidates c JOIN (SELECT DISTINCT id, dob FROM l) l ON l.id = c.id_l "
       "JOIN (SELECT DISTINCT id, dob FROM r) r ON r.id = c.id_r")
def a04_zero_u(spark, sf):
    """Pairs with a score when chance never made two birth dates agree: all of them."""
    u = stage(spark, sf, "u_values").select("variable", F.when(F.col("variable") == "dob", 0.0).otherwise(F.col("u_value")).alias("u_value"))
    scores = scoring.match_scores(*people(spark, sf), stage(spark, sf, "m_values"), u, extra=("dob",))
    return scores.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("dob_l") == F.col("dob_r")).alias("same_dob"), F.count("match_score").alias("with_score")
    )


# -------------------------------------------------------------------------------- scores
def _agreements(spark, sf):
    return scoring.with_agreements(scoring.candidates(*people(spark, sf)))


@query("r01_name_agreement", f"SELECT id_l, id_r, {_round('fn1_agreement', 'sn1_agreement')} FROM agreements")
def r01(spark, sf):
    return rounded(_agreements(spark, sf).select(*PAIR, "fn1_agreement", "sn1_agreement"), "fn1_agreement", "sn1_agreement")


@query("r02_dob_agreement", "SELECT c.id_l, c.id_r, round((CASE WHEN l.day = r.day THEN 1.0::DOUBLE / 3 ELSE 0 END) "
       "+ (CASE WHEN l.mon = r.mon THEN 1.0::DOUBLE / 3 ELSE 0 END) + (CASE WHEN l.year = r.year THEN 1.0::DOUBLE / 3 ELSE 0 END), 6) "
       "AS dob_agreement FROM candidates c JOIN (SELECT DISTINCT id, day, mon, year FROM l) l ON l.id = c.id_l "
       "JOIN (SELECT DISTINCT id, day, mon, year FROM r) r ON r.id = c.id_r")
def r02(spark, sf):
    pairs = scoring.candidates(*people(spark, sf)).select(*PAIR, scoring.date_agreement().alias("dob_agreement"))
    return rounded(pairs, "dob_agreement")


@query("r03_dob_rescue", f"SELECT id_l, id_r, {_round('dob_agreement')} FROM agreements WHERE dob_l IS NULL OR dob_r IS NULL")
def r03(spark, sf):
    missing = _agreements(spark, sf).filter(F.col("dob_l").isNull() | F.col("dob_r").isNull())
    return rounded(missing.select(*PAIR, "dob_agreement"), "dob_agreement")


@query("r04_cut_offs", f"SELECT id_l, id_r, {_round(*AGREE)} FROM agreements")
def r04(spark, sf):
    return rounded(_agreements(spark, sf).select(*PAIR, *AGREE), *AGREE)


def _scored(spark, sf):
    return scoring.score_people(*people(spark, sf), stage(spark, sf, "m_values"), stage(spark, sf, "u_values"))


@query("r06_partial_weights", f"SELECT id_l, id_r, {_round(*WEIGHT)} FROM scored WHERE fn1_agreement < 1 OR sn1_agreement < 1 "
       "OR dob_agreement < 1 OR sex_agreement < 1")
def r06(spark, sf):
    partial = F.expr(" OR ".join(f"{a} < 1" for a in AGREE))
    return rounded(scoring.only(_scored(spark, sf), partial).select(*PAIR, *WEIGHT), *WEIGHT)


@query("r07_missing_weights", f"SELECT id_l, id_r, {_round(*WEIGHT)} FROM scored WHERE "
       + " OR ".join(f"{v}_l IS NULL OR {v}_r IS NULL" for v in VARS))
def r07(spark, sf):
    missing = " OR ".join(f"{v}_l IS NULL OR {v}_r IS NULL" for v in VARS)
    return rounded(_scored(spark, sf).filter(missing).select(*PAIR, *WEIGHT), *WEIGHT)


@query("r_match_score", f"SELECT id_l, id_r, {_round(*AGREE, *WEIGHT, 'match_score')} FROM scored")
def r_match_score(spark, sf):
    values = [*AGREE, *WEIGHT, "match_score"]
    return rounded(_scored(spark, sf).select(*PAIR, *values), *values)


@query("r08_score_sum", f"SELECT id_l, id_r, {_round('match_score')} FROM scored WHERE NOT coalesce(abs(age_r - age_l) > 5, FALSE)")
def r08(spark, sf):
    near = _scored(spark, sf).filter(~F.coalesce(scoring.age_gap() > 5, F.lit(False)))
    return rounded(near.select(*PAIR, "match_score"), "match_score")


@query("r09_age_gap", f"SELECT id_l, id_r, age_l, age_r, {_round('match_score')} FROM scored WHERE abs(age_r - age_l) > 5")
def r09(spark, sf):
    far = scoring.far_scores(*people(spark, sf), extra=("age",))
    return rounded(far.select(*PAIR, "age_l", "age_r", "match_score"), "match_score")


@query("r10_thresholds", "SELECT id_l, id_r, CASE WHEN match_score > 40 THEN 'accept' ELSE 'clerical' END AS zone FROM scored "
       "WHERE match_score >= 8.5")
def r10(spark, sf):
    scores = stage(spark, sf, "likely_scores")
    accepted = cb.accepted_by_score(scores).select(*PAIR, F.lit("accept").alias("zone"))
    return accepted.unionByName(cb.clerical_by_score(scores).select(*PAIR, F.lit("clerical").alias("zone")))


# ------------------------------------------------------------------------------- combine
COMBINED = f"id_l, id_r, mkey, {_round('match_score')}, clerical, id_l_count, id_r_count"


@query("r12_combine", f"SELECT id_l, id_r, mkey, {_round('match_score')} FROM combined")
def r12(spark, sf):
    both = cb.combine(stage(spark, sf, "links"), stage(spark, sf, "likely_scores"))
    return rounded(both.select(*PAIR, "mkey", "match_score"), "match_score")


@query("r13_clerical_flag", f"SELECT {COMBINED} FROM combined")
def r13(spark, sf):
    return rounded(cb.combine(stage(spark, sf, "links"), stage(spark, sf, "likely_scores")), "match_score")


@query("r14_clerical_subset", f"SELECT {COMBINED} FROM combined WHERE clerical = 1")
def r14(spark, sf):
    return rounded(cb.clerical(stage(spark, sf, "combined")), "match_score")


@query("r14_flag_counts", "SELECT clerical, count(*) AS n FROM combined GROUP BY clerical")
def r14_counts(spark, sf):
    return cb.flag_counts(stage(spark, sf, "combined"))


# ------------------------------------------------------------------------ clerical loop
@query("c01_cluster_number", "SELECT id_l, id_r, cluster_number FROM links_clustered")
def c01(spark, sf):
    return cluster_number(stage(spark, sf, "links").select(*PAIR), *PAIR)


@query("c01_cluster_orders", """
  SELECT CAST(o_custkey AS VARCHAR) AS customer, CAST(o_orderkey AS VARCHAR) AS order_id,
         dense_rank() OVER (ORDER BY md5('1:' || o_custkey)) AS cluster_number FROM orders""")
def c01_orders(spark, sf):
    """Every customer's orders are one cluster, named by the customer."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("customer"), F.col("o_orderkey").cast("string").alias("order_id")
    )
    return cluster_number(orders, "customer", "order_id")


@query("c01_clusters_by_load", "SELECT id_l, id_r, cluster_number FROM links_clustered")
def c01_by_load(spark, sf):
    """The clusters of the exact keys' links, then those of the others added."""
    links = stage(spark, sf, "links")
    first, rest = (links.filter(f"mkey {sign} 4").select(*PAIR) for sign in ("<=", ">"))
    found = extended(review.pair_clusters(first), pair_edges(rest, *PAIR))
    return numbered_clusters(links.select(*PAIR), found, *PAIR)


@query("c02_ingest_rows", ss.ingest("links_clustered"))
def c02(spark, sf):
    return review.ingest_rows(cluster_number(stage(spark, sf, "links").select(*PAIR), *PAIR))


@query("c03_decided", "SELECT id_l, id_r FROM decided")
def c03(spark, sf):
    return review.decided(decisions(spark, sf))


@query("c04_undecided", "SELECT id_l, id_r FROM to_review")
def c04(spark, sf):
    clerical = cb.clerical(stage(spark, sf, "combined")).select(*PAIR)
    return review.undecided(clerical, decisions(spark, sf))


@query("c04_review_batch", ss.ingest("to_review_clustered"))
def c04_batch(spark, sf):
    return review.review_batch(cb.clerical(stage(spark, sf, "combined")), decisions(spark, sf))


@query("c04_review_batch_by_load", ss.ingest("to_review_clustered"))
def c04_by_load(spark, sf):
    """The clusters before any load, brought up to date after the first and again after the second."""
    clerical, loads = cb.clerical(stage(spark, sf, "combined")).select(*PAIR), decisions(spark, sf)
    before, found = clerical, review.pair_clusters(clerical)
    for load in (1, 2):
        now = staged(review.undecided(clerical, loads.filter(F.col("load_no") <= load)), "to_review")
        before, found = now, staged(review.updated_clusters(found, before, now), "review_clusters")
    return review.clustered_batch(before, found)


@query("c05_latest_decision", "SELECT id_l, id_r, match_status, load_no FROM newest")
def c05(spark, sf):
    return latest(decisions(spark, sf)).select(*PAIR, "match_status", "load_no")


@query("c05_verdicts", "SELECT id_l, id_r, match_status AS verdict FROM newest WHERE match_status IN (0, 1)")
def c05_verdicts(spark, sf):
    accepted, rejected = review.verdicts(decisions(spark, sf))
    return accepted.withColumn("verdict", F.lit(1)).unionByName(rejected.withColumn("verdict", F.lit(0)))


@query("c06_final_links", f"SELECT id_l, id_r, {_round('match_score')}, mkey, clerical FROM final_links")
def c06(spark, sf):
    return rounded(review.final_links(stage(spark, sf, "combined"), decisions(spark, sf)), "match_score")


@query("c07_key_quality", ss.ingest("links_clustered"))
def c07(spark, sf):
    return review.key_quality_batch(stage(spark, sf, "links"))[1]


@query("c07_key_quality_counts", "SELECT mkey, count(*) AS n FROM links GROUP BY mkey")
def c07_counts(spark, sf):
    return count_by(stage(spark, sf, "links"), "mkey")


@query("c08_removed", "SELECT id AS id_l, hh_id AS hh_id_l, pc AS pc_l, dob AS dob_l FROM left_removed")
def c08(spark, sf):
    names = ("raw_left_people", "raw_left_forms", "raw_nicknames", "raw_removals")
    return clean_left_people(*[raw(spark, sf, t) for t in names]).removed
