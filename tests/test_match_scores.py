"""Match scores alone: the same scores, without the names of pairs too far apart in age."""

from fixtures.catalog.registry import people, stage
from pairloom.operators.pairs import PAIR
from pairloom.plans import scoring
from pairloom.plans.combine import combine


def test_match_scores_are_those_of_whole_scoring(spark, sf):
    args = (*people(spark, sf), stage(spark, sf, "m_values"), stage(spark, sf, "u_values"))
    whole = scoring.score_people(*args).select(*PAIR, "match_score")
    short = scoring.match_scores(*args)
    assert short.columns == whole.columns and short.count() > 1000
    assert short.exceptAll(whole).isEmpty() and whole.exceptAll(short).isEmpty()


def test_names_of_pairs_too_far_in_age_are_not_compared(spark, sf):
    pairs = scoring.with_name_scores(scoring.candidates(*people(spark, sf)), ~scoring.too_far())
    far = pairs.filter(scoring.too_far())
    assert far.count() > 100 and far.filter("_fn1_score IS NOT NULL OR _sn_score IS NOT NULL").isEmpty()


def test_pairs_near_in_age_meet_under_bands_and_once(spark, sf):
    left, right = people(spark, sf)
    near = scoring.near_candidates(left, right)
    expected = scoring.candidates(left, right).filter(~scoring.too_far())
    assert expected.filter("age_l IS NULL AND age_r IS NOT NULL").count() > 0
    assert expected.filter("age_r IS NULL AND age_l IS NOT NULL").count() > 0
    found, wanted = near.select(*PAIR), expected.select(*PAIR)
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    far = scoring.far_scores(left, right)
    assert far.count() + wanted.count() == scoring.candidates(left, right).count()
    assert "levenshtein" not in far._jdf.queryExecution().optimizedPlan().toString()


def test_likely_scores_are_all_that_combining_reads(spark, sf):
    args = (*people(spark, sf), stage(spark, sf, "m_values"), stage(spark, sf, "u_values"))
    likely, scores, links = scoring.likely_scores(*args), scoring.match_scores(*args), stage(spark, sf, "links")
    assert 0 < likely.count() < scores.count()
    assert likely.exceptAll(scores).isEmpty()
    short, whole = combine(links, likely), combine(links, scores)
    assert short.exceptAll(whole).isEmpty() and whole.exceptAll(short).isEmpty()


def test_conditions_on_scores_are_not_spelled_out_below_them(spark, sf):
    args = (*people(spark, sf), stage(spark, sf, "m_values"), stage(spark, sf, "u_values"))
    plan = scoring.likely_scores(*args)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("levenshtein(") == 4


def test_whole_names_that_are_their_first_words_are_not_compared_again(spark):
    columns = "fn1_l string, fn1_r string, fn_l string, fn_r string, sn1_l string, sn1_r string, sn_l string, sn_r string"
    rows = [("ANN", "ANNE", "ANN", "ANNE", "LEE", "LEA", "LEE HILL", "LEA"), (None, "ANN", "ANN LEE", "ANN", None, None, None, None)]
    first, second = scoring.with_name_scores(spark.createDataFrame(rows, columns)).orderBy("fn1_r").collect()[::-1]
    assert first["_fn_score"] is None and first["_fn1_score"] == 0.75 and first["_sn_score"] is not None
    # an unknown first word stays unknown, whatever the whole name
    assert second["_fn1_score"] is None and second["_sn_score"] is None
