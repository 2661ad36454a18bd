import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import hyperplanes, queries


def brute(rows, anchors, positives=5, negatives=10):
    """Plain loops over ``(id, label, whole numbers)``."""
    out = []
    for a, label, v in rows:
        if a not in anchors:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), b, l) for b, l, w in rows if b != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            hard = [(n, t) for t, n, l in scored if l != label and 30 * -s <= 100 * -t <= 90 * -s][:negatives]
            out += [(a, p, k, n, -s, -t) for k, (n, t) in enumerate(hard, 1)]
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, duck, sf):
    where = f"/root/testdata/{sf}"
    cursor = duck.cursor()
    cursor.execute(f"CREATE OR REPLACE TEMP VIEW embeddings AS SELECT * FROM '{where}/embeddings.parquet'")
    df = queries.QUERIES["op11_hard_negatives"](spark, where)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert as_rows(df) == sorted(cursor.execute(queries.ORACLES["op11_hard_negatives"]).fetchall())


def test_hot_vectors_and_several_blocks(spark):
    """A third of the rows hold one vector; the rest are near or far, with ties and few different scores."""
    rng = np.random.default_rng(3)
    many = [[2.0, 1.0, 0.0]] * 300 + rng.integers(-3, 4, (600, 3)).astype(float).tolist()
    table = spark.createDataFrame([(i, i % 3, v, -1) for i, v in enumerate(many)], "vec_id long, label int, embedding array<double>, part int")
    vectors = hyperplanes.whole_vectors(table)
    old = hyperplanes.BLOCK, hyperplanes.LEAF
    want = brute([(i, i % 3, [int(256 * x) for x in v]) for i, v in enumerate(many)], set(range(0, 900, 50)))
    found, parted = hyperplanes.index(vectors, ways=6, block=100)
    assert found.blocks.count() > 9 and parted.count() == 900
    assert as_rows(hyperplanes.hard_negatives(vectors, F.col("vec_id") % 50 == 0)) == want
    assert (hyperplanes.BLOCK, hyperplanes.LEAF) == old


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.5, 0.25]), (3, 2, [0.5, 0.25]), (4, 2, [-1.0, 0.0]), (5, 1, [1.0, 0.5]), (6, 3, [])]
    good += [(7, 3, []), (8, 4, []), (9, 1, [1.0, 0.5, 0.0]), (10, 1, [1.0, 0.5, 1.0]), (11, 2, [0.0, 1.0, 0.0]), (12, 5, [0.0, 0.0]), (13, 5, [0.0, 0.0])]
    odd = [(20, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (21, 1, None), (22, 1, [1.0, None]), (23, 1, [1.0, nan]), (24, 2, [inf, 0.0]), (25, 2, [1e300, 0.0])]
    table = spark.createDataFrame([(*r, 7, "x") for r in good + odd + good[:3]], "vec_id long, label int, embedding array<double>, score int, anchor_id string")
    got = hyperplanes.hard_negatives(hyperplanes.whole_vectors(table), F.col("vec_id").isNotNull())
    want = brute([(i, l, [int(np.floor(256 * x)) for x in v]) for i, l, v in good], {r[0] for r in good})
    assert as_rows(got) == want and {(0, 5, 1, 2), (6, 7, 1, 8), (9, 10, 1, 11)} <= {r[:4] for r in want}
    assert as_rows(hyperplanes.hard_negatives(hyperplanes.whole_vectors(table.limit(0)), F.col("vec_id") >= 0)) == []
    nobody = hyperplanes.hard_negatives(hyperplanes.whole_vectors(table), F.col("vec_id") > 99)
    assert as_rows(nobody) == []


def test_ranges_save_products_of_clustered_vectors():
    """Windows of clustered vectors need a small part of all products, and find what the whole product finds."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-2000, 2000, (64, 16))
    vectors = (np.repeat(centres, 60, axis=0) + rng.integers(-40, 41, (3840, 16))).astype(float)
    labels = rng.integers(0, 4, 3840)
    tree = hyperplanes.Tree(np.arange(3840), labels, vectors)
    asked = hyperplanes.Asked(np.arange(50), labels[:50], vectors[:50], np.arange(50), np.full(50, -np.inf), np.full(50, np.inf), True)
    ids, scores, products = tree.search(asked, 5)
    all_scores = np.where((labels[:50, None] == labels[None]) & (np.arange(50)[:, None] != np.arange(3840)), vectors[:50] @ vectors.T, -np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(3840), all_scores.shape), -all_scores), axis=1)[:, :5]
    assert (ids == order).all() and (scores == np.take_along_axis(all_scores, order, axis=1)).all()
    assert products < 0.3 * 50 * 3840
    # a narrow window far from the anchor
    asked.low, asked.high, asked.same = scores[:, 4] * 0.5, scores[:, 4] * 0.52, False
    ids, found, products = tree.search(asked, 5)
    all_scores = vectors[:50] @ vectors.T
    fits = (labels[:50, None] != labels[None]) & (all_scores >= asked.low[:, None]) & (all_scores <= asked.high[:, None])
    ranked = -np.sort(-np.where(fits, all_scores, -np.inf), axis=1)[:, :5]
    assert (found == ranked).all() and products < 0.6 * 50 * 3840
