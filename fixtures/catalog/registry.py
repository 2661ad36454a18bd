"""Registration of queries, and the staged tables many of them start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fixtures import inputs
from fixtures.clean_sql import with_clause
from fixtures.raw_sql import spark_raw
from fixtures.score_sql import CHAIN
from pairloom.operators import mu
from pairloom.plans import combine as cb, scoring
from pairloom.plans.household_keys import link_households
from pairloom.plans.person_keys import link_people
from pairloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL that must give the same rows."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = f"{with_clause(CHAIN, needed=sql)}\n{sql}"
        return fn

    return register


# ------------------------------------------------------------------------ staged inputs
_PATHS: dict[tuple[str, str, str], str] = {}


def stage(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stage dataset over the tables in ``sf_dir``, written once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _PATHS:
        path = scratch_path(spark, name)
        _BUILD[name](spark, sf_dir).write.parquet(path)
        _PATHS[key] = path
    return spark.read.parquet(_PATHS[key])


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark_raw(spark, sf_dir, table)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def people(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return stage(spark, sf_dir, "left_people"), stage(spark, sf_dir, "right_people")


def households(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return stage(spark, sf_dir, "left_households"), stage(spark, sf_dir, "right_households")


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "raw_decisions").select(
        F.col("left_id").alias("id_l"), F.col("right_id").alias("id_r"),
        F.col("match_status").try_cast("int").alias("match_status"), F.col("load_no").cast("int").alias("load_no"),
    )


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cb.gold_pairs(stage(spark, sf_dir, "links"), decisions(spark, sf_dir))


def _left_households(spark, sf):
    return inputs.left_households(spark, sf, stage(spark, sf, "left_people"))


def _right_households(spark, sf):
    return inputs.right_households(spark, sf, stage(spark, sf, "right_people"))


def scored_with(spark, sf):
    """What scoring starts from: both files, m and u."""
    return *people(spark, sf), stage(spark, sf, "m_values"), stage(spark, sf, "u_values")


_BUILD: dict[str, Query] = {
    "left_people": lambda spark, sf: inputs.left_stage(spark, sf).people,
    "right_people": lambda spark, sf: inputs.right_stage(spark, sf).people,
    "left_households": _left_households,
    "right_households": _right_households,
    "links": lambda spark, sf: link_people(*people(spark, sf)),
    "household_links": lambda spark, sf: link_households(*households(spark, sf)),
    "m_values": lambda spark, sf: mu.m_values(gold(spark, sf), *people(spark, sf)),
    "u_values": lambda spark, sf: mu.u_values(*people(spark, sf)),
    "scores": lambda spark, sf: scoring.match_scores(*scored_with(spark, sf)),
    "likely_scores": lambda spark, sf: scoring.likely_scores(*scored_with(spark, sf)),
    "combined": lambda spark, sf: cb.combine(stage(spark, sf, "links"), stage(spark, sf, "likely_scores")),
}


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.select([F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Columns of a cleaned table without their side suffix."""
    s = df.columns[0][-2:]
    return df.select([F.col(c + s).alias(c) for c in columns])


def joined(df: DataFrame, *arrays: str) -> DataFrame:
    """Array columns as text, so both engines compare the same type."""
    return df.select([F.concat_ws("|", F.col(c).cast("array<string>")).alias(c) if c in arrays else F.col(c) for c in df.columns])


def text_of(*arrays: str, prefix: str = "") -> str:
    return ", ".join(f"array_to_string({prefix}{a}, '|') AS {a}" for a in arrays)


STAGES = tuple(_BUILD)
