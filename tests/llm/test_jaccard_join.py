import random
from collections import Counter

import pyarrow.parquet as pq
import pytest

from pairloom.llm import jaccard_join as jj, queries
from tests.llm.test_fingerprints import brute_set


def brute_classes(rows, threshold=0.8):
    """``{doc_id: (class_id, n_links)}`` by comparing all texts that share a shingle."""
    sets = [(i, frozenset(brute_set(t)) or t or "") for i, t in rows]
    of = {}
    for k, (_, s) in enumerate(sets):
        for x in s if isinstance(s, frozenset) else [("text", s)]:
            of.setdefault(x, []).append(k)
    parent, links = list(range(len(rows))), Counter()

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, (_, s) in enumerate(sets):
        for m in {m for x in (s if isinstance(s, frozenset) else [("text", s)]) for m in of[x] if m < k}:
            other = sets[m][1]
            if s == other or isinstance(s, frozenset) and len(s & other) * 10 >= 8 * len(s | other):
                links[k] += 1
                links[m] += 1
                parent[root(k)] = root(m)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(i, least.get(root(k), i))
    return Counter((i, least[root(k)], links[k]) for k, (i, _) in enumerate(sets))


def result(df):
    return Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect())


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, sf):
    docs = pq.read_table(f"{sf}/documents.parquet").to_pandas()
    assert result(queries.QUERIES["op9_jaccard_join"](spark, sf)) == brute_classes(list(zip(docs.doc_id, docs.text, strict=True)))


def test_splits_and_tiles(spark, monkeypatch):
    """Buckets far above the limits: every split and tile is taken, and no link is lost."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=90)
    rows = []
    for i in range(260):
        text = list(base)
        for _ in range(rng.choice((0, 1, 2, 4))):
            text[rng.randrange(90)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(rng.choices(words, k=60))) for i in range(40)]
    monkeypatch.setattr(jj, "SMALL", 4)
    monkeypatch.setattr(jj, "TILE", 7)
    got = result(jj.classes(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute_classes(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "!!"), (4, "!!"), (5, "one"), (6, "One."), (5, "one"), (7, "w " * 60_000), (8, "x y z"), (8, "other text of six words here")]
    docs = spark.createDataFrame([(*r, "c", 0) for r in [*rows, (None, "one")]], "doc_id long, text string, text_id string, path int")
    assert result(jj.classes(docs)) == brute_classes(rows)
    assert jj.classes(docs.limit(0)).count() == 0


def test_runs_follow_from_the_recall():
    assert jj.runs_needed(0.99999, 0.8, 1) == 8 and jj.runs_needed(0.99999, 0.8, 4) == 16
    assert jj.runs_needed(0.9) < jj.runs_needed(0.99)
