import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from pairloom.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(lengths, window):
    """Rooms left by plain best-fit decreasing."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(window - length)
    return Counter(rooms)


def of_plan(rows, counts, window):
    used, ranks = Counter(), Counter()
    for length, first_rank, n, windows, first, offset in rows:
        assert first_rank == ranks[length]
        ranks[length] += n
        for turn in range(n):
            sequence, at = first + turn % windows, offset + turn // windows * length
            assert used[sequence] >= 0 and at + length <= window
            used[sequence] += length
    assert ranks == Counter(counts)
    assert sorted(used) == list(range(len(used)))
    return Counter(window - u for u in used.values())


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for window in (7, 16, 61):
        for _ in range(60):
            lengths = [rng.randint(1, window) for _ in range(rng.choice((0, 1, 5, 90)))]
            if rng.random() < 0.3:
                lengths += [rng.randint(1, 3)] * 40
            counts = Counter(lengths)
            assert of_plan(packing.plan(counts, window), counts, window) == one_by_one(lengths, window)


def test_query(spark, sf):
    got = queries.QUERIES["op7_packing"](spark, sf).toPandas()
    tokenizer = Tokenizer.from_file(PATH)
    docs = pq.read_table(f"{sf}/documents.parquet").to_pandas()
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        own = got[got.doc_id == doc_id].sort_values("start")
        assert (own.doc_tokens == len(ids)).all() and own.length.sum() == len(ids)
        at = 0
        for _, r in own.iterrows():
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *rows.length.cumsum().tolist()[:-1]] and rows.length.sum() <= 2048
    assert sorted(set(got.sequence_id)) == list(range(got.sequence_id.nunique()))
    assert one_by_one(got.length.tolist(), 2048) == Counter(2048 - got.groupby("sequence_id").length.sum())


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None), (1, None), (None, "a"), (2, ""), (3, "word " * 9000), (3, "word " * 9000)], "doc_id long, text string"
    ).selectExpr("*", "1 AS length", "'x' AS sequence_id")
    got = packing.packed_documents(docs, PATH).toPandas()
    assert got.length.sum() == 3 * 1 + 2 + 2 * 9001
    assert (got.ids.map(len) == 4 * got.length).all()
    assert packing.packed_digests(docs.limit(0), PATH).count() == 0
