import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pairloom.llm import forest, queries

SF = "/root/testdata/sf0.1"


def brute(ids, vectors, asked, k):
    out = {}
    for q in asked:
        scores = (vectors * vectors[ids.index(q)]).sum(axis=1)
        ranked = sorted((-s, i) for i, s in zip(ids, scores, strict=True) if i != q)[:k]
        out[q] = [i for _, i in ranked]
    return out


def test_query_against_brute_force(spark):
    got = queries.QUERIES["op4_hash_forest"](spark, SF).toPandas().sort_values(["query_id", "rank"])
    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pandas()
    vectors = np.stack(rows.embedding.to_numpy()).astype(float)
    ids = rows.vec_id.tolist()
    truth = brute(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    found = got.groupby("query_id").vec_id.apply(list)
    assert set(found.index) == set(truth) and got.groupby("query_id")["rank"].apply(list).map(lambda r: r == list(range(1, 21))).all()
    recall = np.mean([len(set(found[q]) & set(t)) / 20 for q, t in truth.items()])
    assert recall >= 0.9
    at = {i: k for k, i in enumerate(ids)}
    exact = [(vectors[at[q]] * vectors[at[v]]).sum() for q, v in zip(got.query_id, got.vec_id, strict=True)]
    assert np.allclose(got.score, exact, rtol=1e-13)


def test_clustered_vectors_need_few_candidates():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 32))
    vectors = np.repeat(centres, 50, axis=0) + 0.05 * rng.standard_normal((2000, 32))
    tree = forest.Forest(vectors)
    met, scores = tree.candidates(vectors[:100], np.eye(100, 2000, dtype=bool), 10, 0.95)
    assert met.mean() < 0.1
    products = vectors[:100] @ vectors.T
    # a product is worked out once for each vector that was met, and for no other
    assert tree.products == met.sum() == np.isfinite(scores).sum()
    assert np.allclose(scores[met], products[met], rtol=1e-12) and (scores[~met] == -np.inf).all()
    best = np.argsort(-np.where(np.eye(100, 2000, dtype=bool), -np.inf, products), axis=1)[:, :10]
    assert np.take_along_axis(met, best, axis=1).mean() > 0.95


def test_blocks_and_cells(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 30)
    monkeypatch.setattr(forest, "CELL_QUERIES", 7)
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((200, 8)) * rng.uniform(0.1, 4, (200, 1))
    vectors[50:90] = vectors[40]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 5 == 0, 6, 0.999).collect()
    truth = brute(list(range(200)), vectors, range(0, 200, 5), 6)
    found = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in truth}
    assert np.mean([len(set(found[q]) & set(truth[q])) / 6 for q in truth]) > 0.97
    assert all(found[q] == sorted(found[q]) for q in (40, 60) if set(truth[q]) <= {40, *range(50, 90)})


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [2.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (40, [1.0, 1.0, 1.0]), (8, [-1.0, 0.0]),
    ]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in forest.nearest(docs, F.col("vec_id") % 20 == 0, 2).collect()}
    assert got == {(0, 1): (1, 2.0), (0, 2): (20, 0.5), (20, 1): (1, 1.0), (20, 2): (0, 0.5)}
    assert forest.nearest(docs.limit(0), F.col("vec_id") % 20 == 0).count() == 0
