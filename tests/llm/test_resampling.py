import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import xxhash

from pairloom.llm import features, queries, resampling

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, longest=1):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]).encode() for i in range(len(words)) for n in range(1, longest + 1) if i + n <= len(words)]


def brute(docs, target, percent=10, least=20, longest=1):
    """All rows ``(doc_id, n_features, weight, score, rank)`` by plain loops."""
    bucket = lambda g: zlib.crc32(g) % 10000
    s, t = Counter(), Counter()
    for texts, count in (([x for _, x in docs], s), (target, t)):
        for text in texts:
            count.update(map(bucket, grams(text, longest)[1]))
    s_all, t_all = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
    out = []
    for doc_id, text in docs:
        n, found = grams(text, longest)
        weight = sum(gain(bucket(g)) for g in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((n >= least, doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in out if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0))
    drawn = order[: percent * len(order) // 100]
    left = Counter()
    result = [(*r[1:], k) for k, r in enumerate(drawn, 1)]
    left.update(drawn)
    for r in out:
        if left[r]:
            left[r] -= 1
        else:
            result.append((*r[1:], None))
    return Counter(result)


def test_query_against_brute_force(spark):
    for sf in ("sf0.001", "sf0.01"):
        where = f"/root/testdata/{sf}"
        docs, target = (pq.read_table(f"{where}/{t}.parquet").to_pandas() for t in ("documents", "benchmark"))
        df = queries.QUERIES["op12_resampling"](spark, where)
        assert df.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
        got = Counter(tuple(r) for r in df.collect())
        assert got == brute(list(zip(docs.doc_id.tolist(), docs.text.tolist(), strict=True)), target.text.tolist())
        assert sum(n for r, n in got.items() if r[4] is not None) > 0


def test_odd_rows(spark):
    rng = random.Random(2)
    words = ["The", "cat", "É1", "x" * 40, "y" * 33, "日本", "a"]
    docs = [(i % 40, " ".join(rng.choices(words, k=rng.randint(15, 60)))) for i in range(80)]
    docs += [(5, docs[5][1])] * 3 + [(None, docs[0][1]), (None, docs[0][1]), (100, None), (101, ""), (102, " ;; "), (103, "b " * 30_000), (104, "z" * 100_000)]
    target = ["cat cat É1", None, "", "日本"]
    table = spark.createDataFrame([(*r, 1, "w") for r in docs], "doc_id long, text string, weight int, rank string")
    aim = spark.createDataFrame([(t, 3) for t in target], "text string, bucket int")
    for longest in (1, 3):
        got = resampling.resample(table, aim, percent=50, longest=longest).drop("n_words")
        assert Counter(tuple(r) for r in got.collect()) == brute(docs, target, 50, longest=longest)
    assert resampling.resample(table.limit(0), aim).count() == 0
    nothing = resampling.resample(table, aim.limit(0), percent=50).drop("n_words")
    assert Counter(tuple(r) for r in nothing.collect()) == brute(docs, [], 50)


def test_table_of_grams():
    """Hashes are xxHash's, and slots tell bytes apart even if all hashes are equal."""
    rng = random.Random(1)
    texts = ["".join(rng.choice("abAB 9é,😀") for _ in range(rng.randint(0, 300))) for _ in range(100)] + [None, "", "a" * 31 + " " + "a" * 32 + " " + "b" * 33]
    texts.append("x" * 5000 + " " + "x" * 5000 + " " + "x" * 4999 + "y")
    for longest in (1, 3):
        found, want = features.grams(texts, longest), [g for t in texts for g in grams(t, longest)[1]]
        raw = found.buffer.tobytes()
        assert Counter(raw[a : a + n] for a, n in zip(found.starts, found.lengths, strict=True)) == Counter(want)
        assert features.hashes(found).tolist() == [xxhash.xxh64_intdigest(raw[a : a + n]) for a, n in zip(found.starts, found.lengths, strict=True)]
    found = features.grams(texts)
    want = [g for t in texts for g in grams(t)[1]]
    for keys in (None, features.hashes(found) % np.uint64(7), np.zeros(len(want), dtype=np.uint64)):
        table, slots = features.Table(found, 50, keys), defaultdict(set)
        for g, slot in zip(want, table.of.tolist(), strict=True):
            slots[g].add(slot)
        assert all(len(s) == 1 for s in slots.values()) and len(set.union(*slots.values())) == len(slots)
        assert all(table.bucket[next(iter(s))] == zlib.crc32(g) % 50 and table.count[next(iter(s))] == want.count(g) for g, s in slots.items())
