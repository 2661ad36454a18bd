"""A whole linkage run over stage datasets, stage by stage or at once.

Every stage reads the stages before it from files and writes its own, so a run
can stop and go on at any stage, and no stage carries the lineage of another.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.operators import mu
from pairloom.operators.bands import score_bands
from pairloom.operators.columns import count_by
from pairloom.operators.pairs import PAIR
from pairloom.plans import clerical as review, combine as cb, scoring
from pairloom.plans.household_keys import link_households
from pairloom.plans.households import clean_left_households, clean_right_households
from pairloom.plans.people import clean_left_people, clean_right_people
from pairloom.plans.person_keys import link_people
from pairloom.plans.presearch import presearch
from pairloom.sources.stages import Stages, write_one_csv, write_review_csv


@dataclass(frozen=True)
class Inputs:
    """Raw tables of a run, as read by ``sources.tables``."""

    left_people: DataFrame
    left_forms: DataFrame
    left_households: DataFrame
    right_people: DataFrame
    right_forms: DataFrame
    right_households: DataFrame
    nicknames: DataFrame
    areas: DataFrame
    willingness: DataFrame
    removals: DataFrame | None = None


def clean_stage(stages: Stages, raw: Inputs) -> None:
    """Cleaned people and households of both files, and the people set apart."""
    left = clean_left_people(raw.left_people, raw.left_forms, raw.nicknames, raw.removals)
    right = clean_right_people(
        raw.right_people, raw.right_forms, raw.right_households, raw.nicknames, raw.areas, raw.willingness
    )
    left_people = stages.write(left.people, "clean_left_people")
    right_people = stages.write(right.people, "clean_right_people")
    stages.write(left.students, "left_students_away")
    stages.write(right.students, "right_students_away")
    if left.removed is not None:
        stages.write(left.removed, "left_removed")
    stages.write(clean_left_households(raw.left_households, raw.left_forms, left_people), "clean_left_households")
    stages.write(clean_right_households(raw.right_households, raw.right_forms, right_people), "clean_right_households")


def _people(stages: Stages, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return stages.read(spark, "clean_left_people"), stages.read(spark, "clean_right_people")


def key_stage(stages: Stages, spark: SparkSession) -> None:
    stages.write(link_people(*_people(stages, spark)), "person_links")
    households = [stages.read(spark, f"clean_{side}_households") for side in ("left", "right")]
    stages.write(link_households(*households), "household_links")


def probability_stage(stages: Stages, spark: SparkSession, decisions: DataFrame) -> None:
    left, right = _people(stages, spark)
    gold = cb.gold_pairs(stages.read(spark, "person_links"), decisions)
    stages.write(mu.m_values(gold, left, right), "m_values")
    # the expected share, not that of one random pairing: that of rare values would be 0
    stages.write(mu.exact_u_values(left, right), "u_values")


def score_stage(stages: Stages, spark: SparkSession) -> None:
    left, right = _people(stages, spark)
    m, u = stages.read(spark, "m_values"), stages.read(spark, "u_values")
    scores = stages.write(scoring.score_people(left, right, m, u, extra=("fullname", "uprn", "address")), "scores")
    links = stages.read(spark, "person_links")
    bands = stages.write(score_bands(scores, cb.automatic(links)), "score_bands")
    write_one_csv(bands.orderBy(F.desc("score_max")), stages.path("score_bands", "csv"))


def combine_stage(stages: Stages, spark: SparkSession, more_links: DataFrame | None = None) -> None:
    """``more_links`` may bring links found inside matched households, next to the person links."""
    links = stages.read(spark, "person_links")
    if more_links is not None:
        links = links.unionByName(more_links)
    combined = stages.write(cb.combine(links, stages.read(spark, "scores")), "links_before_review")
    stages.write(cb.clerical(combined), "clerical_links")


def review_stage(stages: Stages, spark: SparkSession, decisions: DataFrame, earlier: Stages | None = None) -> DataFrame:
    """The next review batch: a stage, the file to hand over, and its size.

    With the stages of an ``earlier`` run its clusters are carried on: only
    those that gain or lose a pair by the new loads are worked out again.
    """
    stages.write(review.decided(decisions), "decided_pairs")
    pairs = stages.write(review.undecided(stages.read(spark, "clerical_links").select(*PAIR), decisions), "to_review")
    if earlier is None:
        found = review.pair_clusters(pairs)
    else:
        found = review.updated_clusters(earlier.read(spark, "review_clusters"), earlier.read(spark, "to_review"), pairs)
    batch = stages.write(review.clustered_batch(pairs, stages.write(found, "review_clusters")), "review_batch")
    write_review_csv(batch, stages.root, stages.run_date)
    stages.write(review.batch_size(batch), "review_batch_size")
    return batch


def key_quality_stage(stages: Stages, sample: DataFrame) -> DataFrame:
    """Counts by key of a sample of links made elsewhere, and the batch to review it."""
    counts, batch = review.key_quality_batch(sample)
    stages.write(counts, "key_quality_counts")
    batch = stages.write(batch, "key_quality_batch")
    write_review_csv(batch, stages.root, stages.run_date, "key_quality_pairs")
    return batch


def presearch_stage(stages: Stages, spark: SparkSession) -> DataFrame:
    """Wide-net pairs of the people that no final link holds."""
    found = presearch(*_people(stages, spark), stages.read(spark, "final_links"))
    return stages.write(found, "presearch_pairs")


def final_stage(stages: Stages, spark: SparkSession, decisions: DataFrame) -> DataFrame:
    combined = stages.read(spark, "links_before_review")
    return stages.write(review.final_links(combined, decisions), "final_links")


def run(
    stages: Stages, raw: Inputs, decisions: DataFrame, earlier: Stages | None = None, key_sample: DataFrame | None = None,
    search_unlinked: bool = False,
) -> DataFrame:
    """All stages in order; returns the final links.

    ``earlier`` are the stages of the run before, with another date; ``key_sample``
    a sample of links to review by key; ``search_unlinked`` adds the pre-search
    among the people that no final link holds.
    """
    if earlier is not None and earlier.folder() == stages.folder():
        raise ValueError("an earlier run has a folder of its own")
    spark = raw.left_people.sparkSession
    clean_stage(stages, raw)
    key_stage(stages, spark)
    probability_stage(stages, spark, decisions)
    score_stage(stages, spark)
    combine_stage(stages, spark)
    review_stage(stages, spark, decisions, earlier)
    if key_sample is not None:
        key_quality_stage(stages, key_sample)
    final = final_stage(stages, spark, decisions)
    if search_unlinked:
        presearch_stage(stages, spark)
    return final


def link_counts(stages: Stages, spark: SparkSession) -> DataFrame:
    return count_by(stages.read(spark, "person_links"), "mkey")
