import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from pairloom.llm import fingerprints as fp, queries, shingles


def brute_set(text):
    words, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c.isascii() and not c.isalnum():
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_query_against_brute_force(spark, sf):
    got = {r["doc_id"]: r for r in queries.QUERIES["op1_fingerprints"](spark, sf).collect()}
    docs = pq.read_table(f"{sf}/documents.parquet").to_pandas().sort_values("doc_id", ascending=False)
    ids, texts = docs.doc_id.tolist(), [t or "" for t in docs.text]
    assert sorted(got) == sorted(ids)
    errors = []
    for i, text in enumerate(texts):
        following, row = texts[(i + 1) % len(texts)], got[ids[i]]
        m = len(text) // 3
        edited = text[: len(text) - m] + following[:m]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own = brute_set(text)
        errors += [row["near_edited"] - jaccard(own, brute_set(edited)), row["near_next"] - jaccard(own, brute_set(following))]
        assert row["fingerprint"] == fp.packed(*(x[0] for x in fp.codes([text])))
    assert np.abs(errors).max() < 0.15 and abs(np.mean(errors)) < 0.01


@pytest.mark.parametrize("n", [1, 2, 9])
def test_odd_rows(spark, n):
    rows = [(None, "a b c"), (3, None), (3, None), (2, ""), (7, "!!"), (9, "é" * 7), (5, "word"), (5, "word"), (8, "x " * 40_000)][:n]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, fingerprint string, bucket int")
    got = fp.compare_neighbours(docs).collect()
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(r[0]) for r in rows)
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % n][1] or ""
        m = len(text) // 3
        edited = text[: len(text) - m] + following[:m]
        assert any(r["doc_id"] == doc_id and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() for r in got)
    assert all(0 <= r["near_next"] <= 1 for r in got)


def test_empty_table(spark):
    assert fp.compare_neighbours(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_shingle_counts():
    texts = ["", None, "One", "a b c d", "a b c d e", "A b-c d e f!", "é ü. " * 3]
    hashes, counts = shingles.shingle_hashes(texts)
    assert counts.tolist() == [0, 0, 1, 1, 1, 2, 2]
    assert hashes[2] == hashes[3]


def test_packing_round_trip():
    rows, words = fp.codes(["some words for a text that is long enough", ""])
    assert (fp.unpacked(fp.packed(rows[0], words[0])) == rows[0]).all() and fp.packed(rows[1], words[1]) == ""
