import hashlib
import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from pairloom.llm import bpe, queries

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(PATH, PATTERN)


@pytest.fixture(scope="module")
def theirs(own):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})


@pytest.mark.parametrize("many", [1, 24, 10**9])
def test_replay_against_library(own, theirs, many, monkeypatch):
    monkeypatch.setattr(bpe, "MANY", many)
    own.known.clear()
    rng = random.Random(many)
    texts = [
        "".join(rng.choice(letters) for _ in range(rng.randint(0, 400)))
        for letters in ("ab", "a", "aé中 \n😀'st", "the ing ation", "0123 x", "\x00\x1c \u0085\t", "abcdefghijklmnopqrstuvwxyz", "xX-=_")
        for _ in range(60)
    ] + ["", " ", "a" * 30_000, "<|endoftext|>"]
    assert [x.tolist() for x in own.encode(texts)] == [theirs.encode_ordinary(t) for t in texts]


def test_lesser_rank_goes_first():
    """A merge that brings about a pair of a lesser rank makes its word wait."""
    own = bpe.Bpe.__new__(bpe.Bpe)
    own.ranks = {bytes([b]): 300 + b for b in range(256)} | {b"abc": 1, b"ab": 5, b"ca": 3, b"abca": 9}
    own.tokens = {r: t for t, r in own.ranks.items()}
    own.bits, own.merged, own.known = 10, {}, {}
    own.of_byte = bpe.np.array([own.ranks[bytes([b])] for b in range(256)])
    library = tiktoken.Encoding("x", pat_str=r"[a-z]+", mergeable_ranks=own.ranks, special_tokens={})
    own.find = bpe.regex.compile(r"[a-z]+").findall
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    assert [x.tolist() for x in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_query(spark, sf, theirs):
    got = {r["doc_id"]: r for r in queries.QUERIES["op3_byte_bpe"](spark, sf).collect()}
    docs = pq.read_table(f"{sf}/documents.parquet").to_pandas()
    assert len(got) == len(docs)
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        ids = theirs.encode_ordinary(text or "")
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_rows(spark, theirs):
    rows = [(None, None), (1, ""), (2, "é" * 50_000), (2, "same"), (2, "same")]
    docs = spark.createDataFrame([(*r, [1]) for r in rows], "doc_id long, text string, ids array<int>")
    out = bpe.encode(docs, PATH, PATTERN).withColumn("back", bpe.decode(F.col("ids"), PATH, PATTERN)).collect()
    assert sorted((bytes(r["back"]).decode() for r in out)) == sorted(t or "" for _, t in rows)
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0
    unknown = spark.sql("SELECT array(999999) AS ids UNION ALL SELECT NULL").select(bpe.decode(F.col("ids"), PATH, PATTERN).alias("b"))
    assert {None if r["b"] is None else bytes(r["b"]) for r in unknown.collect()} == {b"", None}
