"""The clerical round trip: batches out, decisions in, final links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.config import REVIEWED_SCORE
from pairloom.operators.columns import count_by, one_per_key
from pairloom.operators.components import cluster_number, components, extended, numbered_clusters, pair_edges, reduced
from pairloom.operators.pairs import PAIR, latest
from pairloom.session import staged

FINAL = [*PAIR, "match_score", "mkey", "clerical"]


def decided(decisions: DataFrame) -> DataFrame:
    """Distinct pairs with a decision in any load."""
    return decisions.filter(F.col("match_status").isNotNull()).select(*PAIR).distinct()


def undecided(pairs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Pairs no load has decided yet."""
    return pairs.join(decided(decisions), PAIR, "left_anti")


def ingest_rows(clustered: DataFrame) -> DataFrame:
    """One row per record to review: ``(unique_id, cluster_number, dataset)``."""
    sides = {"id_l": "left", "id_r": "right"}
    rows = F.explode(
        F.array(*[F.struct(F.col(c).alias("unique_id"), F.lit(d).alias("dataset")) for c, d in sides.items()])
    )
    return clustered.select("cluster_number", rows.alias("r")).select("r.unique_id", "cluster_number", "r.dataset").distinct()


def review_batch(clerical: DataFrame, decisions: DataFrame) -> DataFrame:
    """The next batch: undecided clerical pairs, clustered, a row per record."""
    return ingest_rows(cluster_number(undecided(clerical.select(*PAIR), decisions), *PAIR))


def pair_clusters(pairs: DataFrame) -> DataFrame:
    """``(vertex, component)`` of the records of a pair table: what a later load starts from."""
    return components(pair_edges(pairs, *PAIR))


def updated_clusters(stars: DataFrame, before: DataFrame, now: DataFrame) -> DataFrame:
    """The clusters of the pairs ``now`` from those of the pairs ``before``.

    Only clusters that lose a pair and those that a new pair touches change; the
    rounds go over their pairs alone, however large the rest is.
    """
    now, before = now.select(*PAIR).distinct(), before.select(*PAIR).distinct()
    gone, kept, new = (pair_edges(df, *PAIR) for df in (
        before.join(now, PAIR, "left_anti"), before.join(now, PAIR, "left_semi"), now.join(before, PAIR, "left_anti")
    ))
    left = staged(reduced(stars, gone, kept), "clusters_left")
    return extended(left, new)


def clustered_batch(pairs: DataFrame, stars: DataFrame) -> DataFrame:
    """The review batch of pairs whose clusters are known: a row per record."""
    return ingest_rows(numbered_clusters(pairs.select(*PAIR), stars, *PAIR))


def batch_size(batch: DataFrame) -> DataFrame:
    """Rows and clusters of a batch, for the ingest form."""
    return batch.agg(F.count(F.lit(1)).alias("n_rows"), F.max("cluster_number").alias("n_clusters"))


def key_quality_batch(sample: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sampled links per key, and the batch to review them."""
    return count_by(sample, "mkey"), ingest_rows(cluster_number(sample.select(*PAIR), *PAIR))


def verdicts(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected pairs by each pair's latest load."""
    newest = latest(decisions)
    return tuple(newest.filter(F.col("match_status") == status).select(*PAIR) for status in (1, 0))


def final_links(combined: DataFrame, decisions: DataFrame) -> DataFrame:
    """Automatic and accepted links without the rejected ones; an automatic link stands over an accepted one."""
    accepted, rejected = verdicts(decisions)
    own = combined.filter(F.col("clerical") == 0).select(*FINAL)
    reviewed = accepted.select(
        *PAIR, F.lit(REVIEWED_SCORE).cast("double").alias("match_score"), F.lit(None).cast("int").alias("mkey"),
        F.lit(1).alias("clerical"),
    )
    kept = one_per_key(own.unionByName(reviewed), PAIR, ["clerical", "mkey", "match_score"])
    return kept.join(rejected.distinct(), PAIR, "left_anti").select(*FINAL)
