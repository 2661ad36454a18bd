"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage takes ``(spark, docs, sf_dir)``.  All but the last return the columns
of their input; the last returns packed pieces of token ids.  Models are learned
from the tables in ``sf_dir``, not from what earlier stages left.

Defined results: an empty table passes through all stages; documents without an
id are kept by the join, since nothing tells them apart; null texts have no
language and go in the first stage.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import jaccard_join, language, packing, pii, samples, toxicity
from pairloom.llm.batches import small_batches
from pairloom.session import staged

#: A text of no learned language meets a prototype by chance only: its cosine then has a standard
#: deviation of one by the root of the dimensions.  Texts within so many of them are of no learned language;
#: one text in some 500 of foreign script is let through, and learned texts of a few words score just above.
NOISE_DEVIATIONS = 3.25
LEAST_COSINE = NOISE_DEVIATIONS / language.DIMENSIONS**0.5
TOXIC = 0.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language one of the learned languages may be."""
    model = language.fit(_table(spark, sf_dir, "documents"), ~samples.held_out(5, 0))
    found = language.prediction(docs, model)
    return docs.filter((found["lang"] != language.UNKNOWN) & (found["score"] >= LEAST_COSINE))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't judged toxic."""
    model = toxicity.fit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ~samples.held_out(5, 0))
    return docs.filter(toxicity.score(docs, model) < TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near duplicates.

    Of rows that repeat an id and a text one stays.  An id with several texts
    stays if any of them does.
    """
    about = jaccard_join.classes(docs).groupBy("doc_id").agg(
        F.max((F.col("doc_id") == F.col("class_id")).cast("int")).alias("stays"), F.count(F.lit(1)).alias("n")
    )
    about = staged(about.filter("stays = 0 OR n > 1"), "decisions")
    repeated = about.filter("stays = 1").select("doc_id")
    once = docs.join(about.select("doc_id"), "doc_id", "left_anti")
    several = docs.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.select(*docs.columns).unionByName(several.select(*docs.columns))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their places in the sequences."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def _stage(work):
    """A stage that hands whole texts to Python in small batches."""
    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return work(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", _stage(identify_language)),
    ("toxicity", _stage(drop_toxic)),
    ("near_duplicates", _stage(drop_near_duplicates)),
    ("personal_data", _stage(redact_personal_data)),
    ("packing", _stage(pack_tokens)),
]

#: No SQL: languages, toxicity and similarity classes are beyond it; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the stored result of the one before."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
