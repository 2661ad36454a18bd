"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairloom.llm import (
    bpe, fingerprints, forest, hyperplanes, jaccard_join, language, licenses, packing, pii, quality, recompression, resampling, samples, toxicity,
)
from pairloom.llm.batches import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_fingerprints")
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    test = samples.held_out(5, 0)
    found = language.prediction(docs, language.fit(docs, ~test))
    return docs.select("doc_id", test.alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def _scored(spark: SparkSession, sf_dir: str, operator, test: Column, accepted: float) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = docs.select("doc_id", test.alias("held_out"), operator.score(docs, operator.fit(docs, labels, ~test)).alias("score"))
    return found.select("*", F.when(F.col("score") >= accepted, 1).otherwise(0).alias("predicted"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, toxicity, samples.held_out(5, 0), 0.5)


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, quality, samples.held_out(4, 2), quality.ACCEPTED)


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = bpe.encode(table(spark, sf_dir, "documents"), *ranks).withColumn("decoded", bpe.decode(F.col("ids"), *ranks))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_hash_forest")
def op4_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(table(spark, sf_dir, "documents"))


_HARD_NEGATIVES_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
        coalesce(list_sum([p[1] * p[2] FOR p IN list_zip(a.x, b.x)]), 0)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
    SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    WHERE 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
)
SELECT * FROM n WHERE rank <= 10
"""


@query("op11_hard_negatives", _HARD_NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hyperplanes.hard_negatives(hyperplanes.whole_vectors(rows), F.col("vec_id") % 100 == 0)


@query("op12_resampling")
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_substring_dedup")
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
