"""Importance resampling: draw the documents whose n-grams look most like those of a target.

All documents and all target texts are counted over hashed n-grams: an n-gram
belongs to the bucket its CRC-32 names.  The gain of a bucket is the logarithm
of its smoothed share in the target over that in the documents; a document's
weight is the sum of the gains of its n-grams, repeats counted.  With a Gumbel
number that follows from its id added, the highest scores are a draw without
replacement in proportion to the weights.

Tasks intern the n-grams of a batch in an open-addressed table whose slots hold
bucket and count.  The first pass adds up the counts of slots by bucket and
sends at most one row a bucket and task; the second lets the slot of every
occurrence gather its gain.  What is counted covers all texts.  The draw sorts
rows of a few numbers by ranges of the score, so no task gets them all.

Defined results: a null text has no n-grams and weight 0.  Rows repeated for an
id are documents of their own and share a Gumbel number; the order among rows
equal in score and id is not fixed, but it makes no difference to the result.  A
row without an id draws as one whose id is the empty text and comes last among
ties.  Without targets or documents all counts are 0 and the gains follow from
the smoothing.  An empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from pairloom.llm import features, shingles
from pairloom.session import staged

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Texts are interned in batches of about so many characters.
BATCH_CHARS = 1_000_000

_SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``(bucket, n)``: how many n-grams of the column ``text`` fall into each bucket."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            found = batch["text"].tolist()
            for part in shingles.chunks(found, BATCH_CHARS):
                total += features.Table(features.grams(found[part], longest), buckets).counts(buckets)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInPandas(count, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the documents, rounded down."""
    buckets, s_all, t_all = len(documents), float(documents.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
        for s, t in zip(documents.astype(float).tolist(), target.astype(float).tolist(), strict=True)
    ], dtype=np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel number that follows from the id, rounded down."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every document."""
    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].astype("Int64")
            for part in shingles.chunks(texts, BATCH_CHARS):
                found = features.grams(texts[part], longest)
                table = features.Table(found, len(gain))
                upto = np.concatenate(([0], np.cumsum(gain[table.bucket][table.of])))
                ends = np.cumsum(found.counts)
                weight = upto[ends] - upto[ends - found.counts]
                noise = np.array([gumbel(None if i is pd.NA else i, seed) for i in ids[part]], dtype=np.int64)
                yield pd.DataFrame({
                    "doc_id": ids[part].array, "n_words": found.words, "n_features": found.counts,
                    "weight": weight, "score": weight + noise,
                })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(weigh, _SCORED)


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The stored rows of :func:`weighted` with ``rank``: 1 and on for the drawn, null for the rest.

    Rows are dealt to ranges of the score; a rank is the place in its range
    and the size of the ranges before it.  Only those sizes reach the driver,
    one number for each of as many ranges as there are shuffle partitions.
    """
    spark = scored.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    long_enough = F.col("n_words") >= least_words
    # rows that are equal in score and id may be many; a fixed random number deals them to several ranges
    placed = staged(
        scored.filter(long_enough).withColumn("_turn", F.rand(seed=SEED))
        .repartitionByRange(ranges, F.desc("score"), F.asc_nulls_last("doc_id"), "_turn").withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    sizes = {r["_range"]: r["n"] for r in placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn, before, shifts = percent * sum(sizes.values()) // 100, 0, []
    for number in sorted(sizes):
        shifts.append((number, before))
        before += sizes[number]
    shift = F.broadcast(spark.createDataFrame(shifts, "_range int, _shift long"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "_turn"))
    numbered = placed.withColumn("_inside", inside).join(shift, "_range").withColumn("rank", (F.col("_shift") + F.col("_inside")).cast("long"))
    numbered = numbered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return numbered.select(*rest.columns).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
    longest: int = LONGEST, seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` of every document; those with a rank are drawn."""
    def collected(texts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, dtype=np.int64)
        for row in bucket_counts(texts, buckets, longest).collect():  # one row a bucket at most
            out[row["bucket"]] = row["n"]
        return out

    gain = gains(collected(docs), collected(target))
    return ranked(staged(weighted(docs, gain, longest, seed), "weighted"), percent, least_words)
