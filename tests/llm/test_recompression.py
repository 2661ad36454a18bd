import hashlib
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from pairloom.llm import queries, recompression
from pairloom.llm.recompression import WINDOW


def brute(docs, window=WINDOW):
    """``(doc_id, n_words, n_removed, kept)`` by a dictionary of all windows."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    place, first = lambda i: float("inf") if i is None else i, {}
    for i, words in split:
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            first[key] = min(first.get(key, place(i)), place(i))
    out = []
    for i, words in split:
        gone = {k + j for k in range(len(words) - window + 1) if first[tuple(words[k : k + window])] < place(i) for j in range(window)}
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = pq.read_table(f"{sf}/documents.parquet").to_pandas()
    got = queries.QUERIES["op13_substring_dedup"](spark, sf)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in brute(zip(docs.doc_id.tolist(), docs.text.tolist(), strict=True))]
    assert order(tuple(r) for r in got.collect()) == order(want) and sum(r[2] for r in want) > 1000


@pytest.mark.parametrize("size", [120, 5_000])
def test_passages_runs_and_few_words(spark, monkeypatch, size):
    """Passages of all lengths at all places, words that run and repeat in patterns, chunks of any size."""
    monkeypatch.setattr(recompression, "CHUNK_WORDS", size)
    rng = random.Random(size)
    word = lambda n: [f"w{rng.randint(0, n)}" for _ in range(rng.randint(0, 60))]
    passages = [word(10_000)[:k] for k in (12, 13, 14, 20, 40) for _ in range(3)]
    docs = [(i, " ".join(word(10_000) + rng.choice(passages) + word(10_000) + rng.choice(passages))) for i in rng.sample(range(200), 100)]
    docs += [(200 + i, " ".join(word(1))) for i in range(60)]
    docs += [(300 + i, " ".join(rng.choice([["a"], ["a", "b"], ["a", "a", "b"]]) * rng.randint(3, 30))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert order(tuple(r) for r in recompression.without_repeats(df).collect()) == order(brute(docs))


def test_odd_rows(spark):
    text = " ".join(f"t{i}" for i in range(30))
    docs = [(3, text), (1, text), (3, text), (2, None), (4, ""), (5, " \t\n"), (None, text), (None, text + " end"), (None, " ".join(f"n{i}" for i in range(20)))]
    docs += [(None, docs[-1][1]), (6, "a\tb\x0bc\x0cd\re\nf g h"), (7, "x " * 50_000), (8, "x " * 40), (9, "y" * 200_000 + " " + text), (10, "é😀 " * 20), (11, "é😀 " * 13)]
    df = spark.createDataFrame([(*r, 1, "k") for r in docs], "doc_id long, text string, chunk int, kind string")
    got = recompression.without_repeats(df)
    assert order(tuple(r) for r in got.collect()) == order(brute(docs))
    assert recompression.without_repeats(df.limit(0)).count() == 0
    short = recompression.without_repeats(df, window=5)
    assert order(tuple(r) for r in short.collect()) == order(brute(docs, 5))


def test_equal_passages_get_equal_symbols_inside():
    """After three rounds a passage is cut alike in two surroundings, but for its ends."""
    rng = np.random.default_rng(1)
    passage, sides = rng.integers(1, 1 << 62, 200, dtype=np.uint64), rng.integers(1, 1 << 62, (4, 50), dtype=np.uint64)
    found = [recompression.rounds(np.concatenate((a, passage, b)), np.ones(300, dtype=bool)) for a, b in (sides[:2], sides[2:])]
    inner = [{(s, n) for s, n in zip(f.start.tolist(), f.name.tolist(), strict=True) if 80 <= s < 220} for f in found]
    assert inner[0] == inner[1] and len(inner[0]) < 0.6 * 140
    run = recompression.rounds(np.concatenate((passage[:20], np.repeat(passage[:1], 100), passage[:20])), np.ones(140, dtype=bool), 1)
    assert np.diff(run.start).max() >= 100
