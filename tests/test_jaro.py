"""Scores of whole columns: those of DuckDB, and of the expression that works pair by pair."""

import random

import numpy as np
import pandas as pd

from fixtures.catalog import QUERIES
from fixtures.catalog.registry import people
from pairloom.functions import jaro, similarity as sim
from pairloom.plans import scoring


def _pairs():
    rng = random.Random(5)
    texts = ["".join(rng.choices("ABCÉ", k=rng.randint(0, 9))) for _ in range(3000)]
    others = ["".join(rng.sample(t, len(t))) if rng.random() < 0.5 else "".join(rng.choices("ABCÉ", k=rng.randint(0, 9))) for t in texts]
    odd = [(None, "A"), ("A", None), (None, None), ("", ""), ("", "A"), ("A", ""), ("A" * 70, "A" * 69 + "B"), ("AB" * 40, "BA" * 50), ("Ł漢", "漢Ł")]
    return list(zip(texts, others, strict=True)) + odd


def test_scores_agree_with_the_expression(spark):
    pairs = spark.createDataFrame(_pairs(), "a string, b string")
    got = pairs.select("a", "b", jaro.jaro_winkler("a", "b").alias("batch"), sim.jaro_winkler("a", "b").alias("single")).collect()
    assert len(got) == len(_pairs()) and [r for r in got if r["batch"] != r["single"]] == []


def test_scores_agree_with_duckdb(duck):
    ascii_only = pd.DataFrame([p for p in _pairs() if None not in p and "".join(p).isascii()], columns=["a", "b"])
    expected = duck.execute("SELECT jaro_winkler_similarity(a, b)::FLOAT AS j FROM ascii_only").fetchnumpy()["j"]
    assert np.array_equal(jaro.scores(ascii_only.a, ascii_only.b).to_numpy(), expected)


def test_pairs_of_the_query_are_not_walked_over_by_interpreted_lambdas(spark, sf):
    assert scoring.candidates(*people(spark, sf)).count() > 1000
    plan = QUERIES["f11_jaro_winkler"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "locate(" not in plan and "ArrowEvalPython" in plan
