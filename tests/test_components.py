"""Clusters against union-find, on random graphs, a long chain and a hub."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures.catalog import registry
from pairloom.operators.components import cluster_number, components, extended
from pairloom.plans import clerical as review


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(("1", a))] = find(("2", b))
    return {frozenset(e for e in edges if find(("1", e[0])) == root) for root in {find(("1", a)) for a, _ in edges}}


def _random_edges(n, m, seed):
    rng = random.Random(seed)
    return sorted({(str(rng.randrange(n)), str(rng.randrange(n))) for _ in range(m)})


CASES = {
    "sparse": _random_edges(80, 60, 1),
    "dense": _random_edges(30, 90, 2),
    "chain": [(str(i // 2 + i % 2), str(i // 2)) for i in range(41)],
    "hub": [("hub", str(i)) for i in range(200)] + [("other", "200")],
    "same ids": [("1", "2"), ("2", "1")],
}


@pytest.mark.parametrize("name", CASES)
def test_clusters_equal_union_find(spark, name):
    edges = CASES[name]
    got = cluster_number(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()
    clusters = {}
    for r in got:
        clusters.setdefault(r["cluster_number"], set()).add((r["a"], r["b"]))
    assert len(got) == len(edges)
    assert {frozenset(c) for c in clusters.values()} == _union_find(edges)
    assert sorted(clusters) == list(range(1, len(clusters) + 1))


def _parts(df):
    return sorted((r["vertex"], r["component"]) for r in df.collect())


def _pairs(spark, pairs):
    return spark.createDataFrame(sorted(pairs), "id_l string, id_r string")


LOADS = {
    "some go, some come": (set(_random_edges(40, 45, 3)), set(_random_edges(40, 45, 3)[::2]) | set(_random_edges(40, 20, 4))),
    "a chain is cut": (set(CASES["chain"]), set(CASES["chain"]) - {CASES["chain"][20]}),
    "a chain is joined": (set(CASES["chain"]) - {CASES["chain"][20]}, set(CASES["chain"])),
    "a hub goes": (set(CASES["hub"]), {("other", "200")}),
    "all go": (set(CASES["dense"]), set()),
    "none before": (set(), set(CASES["sparse"])),
    "nothing changes": (set(CASES["dense"]), set(CASES["dense"])),
}


@pytest.mark.parametrize("name", LOADS)
def test_updated_clusters_equal_a_full_run(spark, name):
    before, now = (_pairs(spark, pairs) for pairs in LOADS[name])
    got = review.updated_clusters(review.pair_clusters(before), before, now)
    assert _parts(got) == _parts(review.pair_clusters(now))


def test_an_update_goes_over_changed_clusters_only(spark, monkeypatch):
    from pairloom.operators import components as c

    seen, whole = [], c.components
    monkeypatch.setattr(c, "components", lambda edges: (seen.append(edges.count()), whole(edges))[1])
    pairs = [(f"p{i}", f"p{i}") for i in range(50)] + [("q", "r"), ("q", "s")]
    before = _pairs(spark, pairs)
    stars = whole(c.pair_edges(before, "id_l", "id_r"))
    review.updated_clusters(stars, before, _pairs(spark, [*pairs[:51], ("p1", "p2")])).collect()
    assert seen == [1, 1]  # the edge that q keeps, and the new one


def test_an_edge_inside_a_component_or_repeated_changes_nothing(spark):
    stars = components(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"))
    again = spark.createDataFrame([(3, 1), (1, 3), (1, 3)], "a long, b long")
    assert _parts(extended(stars, again)) == _parts(stars) == [(1, 1), (2, 1), (3, 1)]


def test_ids_must_be_text(spark):
    with pytest.raises(TypeError):
        cluster_number(spark.range(2).select("id", F.lit("x").alias("b")), "id", "b")


def test_at_most_two_rounds_are_kept(spark, tmp_path, monkeypatch):
    from pairloom.operators import components as c

    kept, made = [], iter(range(100))
    monkeypatch.setattr(c, "scratch_path", lambda _, name: f"{tmp_path}/{name}{next(made)}")
    discard = c.discard

    def counted(spark, path):
        kept.append(len(list(tmp_path.iterdir())))
        discard(spark, path)

    monkeypatch.setattr(c, "discard", counted)
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert c.components(chain).select("component").distinct().count() == 1
    assert len(kept) > 1 and max(kept) == 2 and len(list(tmp_path.iterdir())) == 1


def test_scratch_is_cleared(spark):
    from pairloom.session import clear_scratch, scratch_root, staged

    df = staged(spark.range(3), "three")
    assert df.count() == 3
    clear_scratch(spark)
    assert not Path(scratch_root(spark)).exists()
    registry._PATHS.clear()
