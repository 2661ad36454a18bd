import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pairloom.llm import quality, queries, samples, toxicity

SF = "/root/testdata/sf0.1"


# 352 toxic documents to learn from, 97 held out, some of which hold no toxic word at all
@pytest.mark.parametrize(("name", "label", "folds", "fold", "accepted", "least"), [
    ("op6_toxicity", "toxic", 5, 0, 0.5, 0.85), ("op8_quality", "quality", 4, 2, 0.7, 0.97),
])
def test_held_out_accuracy(spark, name, label, folds, fold, accepted, least):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % folds == fold)).all()
    assert (got.predicted == (got.score >= accepted)).all()
    known = got[got.held_out].merge(pq.read_table(f"{SF}/labels.parquet").to_pandas(), on="doc_id")
    assert min((known.predicted == known[label])[known[label] == k].mean() for k in (0, 1)) > least


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_odd_rows(spark, operator):
    texts = [None, "", "some words here, and more", "SHOUT!! LOUD!! NOISE!!", "word " * 60_000, "plain words again"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(1, "", "x"), (None, "a", None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(2, 1), (3, 0), (3, 0), (5, 1), (4, None), (99, 0), (None, 1)], "doc_id long, label int")
    model = operator.fit(docs, labels, F.lit(True), "label", (9, 9))
    got = docs.select("doc_id", operator.score(docs, model).alias("p")).collect()
    assert len(got) == 8 and all(0 <= r["p"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["p"] for r in got}
    assert by_id[2] > by_id[3] and by_id[0] == by_id[1]
    nothing = operator.fit(docs, labels.limit(0), F.lit(True), "label", (9, 9))
    assert {r["p"] for r in docs.select(operator.score(docs, nothing).alias("p")).collect()} == {0.0}
    assert docs.limit(0).select(operator.score(docs, model)).collect() == []


def brute_subwords(text):
    words, word = [], b""
    for b in (text or "").encode() + b" ":
        if chr(b).isalnum() and b < 128 or b >= 128:
            word += bytes([b])
        elif word:
            words, word = words + [word], b""
    return sum(max(0, len(w) + 2 - n + 1) for w in words for n in toxicity.SIZES) + len(words)


def test_subwords_by_definition():
    texts = ["a", "ab cd", None, "", "idiot!! été", "x" * 40]
    of, buckets = toxicity.subwords(texts)
    assert np.bincount(of, minlength=len(texts)).tolist() == [brute_subwords(t) for t in texts]
    same = [set(buckets[of == k]) for k in (0, 1)]
    assert same == [set(toxicity.subwords([t])[1]) for t in texts[:2]]


def test_unseen_misspelling():
    bad = ["you total idiots go now", "an idiotic thing it is", "such an idiot again here"] * 8
    good = ["you all go there now", "a lovely thing it is", "such a friend again here"] * 8
    model = toxicity.train(bad + good, [1] * 24 + [0] * 24)
    worse, better = toxicity.scores(["idiotts everywhere idioot", "flowers everywhere today"], model)
    assert worse > better


WORD = re.compile(rb"[A-Za-z0-9\x80-\xff]+")
SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
KINDS = [set(range(48, 58)), set(range(65, 91)), set(range(97, 123)), set(range(192, 256)), set(range(128, 192)), {32}, {10},
         {*range(10), *range(11, 32), 127}]


def brute_measures(text):
    """The measures of one text, counted one by one."""
    raw = (text or "").encode()
    words = [w.lower() for w in WORD.findall(raw)]
    runs = [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else []
    lines = text.split("\n") if text else []
    some, size = max(1, len(words)), max(1, len(raw))
    counts = [raw.count(bytes([b])) for b in SIGNS] + [sum(b in kind for b in raw) for kind in KINDS]
    return [math.sqrt(c / size) for c in counts] + [
        math.log1p(len(words)), math.log1p(len(raw)), len(raw) / some, len(set(words)) / some, max(Counter(words).values(), default=0) / some,
        len(set(runs)) / max(1, len(runs)), len(words) / (len(lines) + 1), len(set(lines)) / max(1, len(lines)),
    ]


def sigma(x):
    return 1 / (1 + math.exp(-max(-30, min(30, x))))


def given(name):
    return pq.read_table(f"/root/testdata/sf0.01/{name}.parquet").to_pandas()


def parts(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels")]


def test_quality_scores_by_definition(spark):
    """Every score of the query is the sigma of the worth of measures that are counted here one by one."""
    got = {r["doc_id"]: r["score"] for r in queries.QUERIES["op8_quality"](spark, "/root/testdata/sf0.01").collect()}
    model = quality.fit(*parts(spark), ~samples.held_out(4, 2))
    docs = given("documents")
    assert set(got) == set(docs.doc_id)
    shift = math.log(quality.ACCEPTED / (1 - quality.ACCEPTED)) - model.threshold
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        worth = sum((v - c) * w for v, c, w in zip(brute_measures(text), model.centre, model.weights, strict=True))
        assert math.isclose(got[doc_id], sigma(worth + shift), abs_tol=1e-9)


def test_quality_weights_prefer_the_better_text(spark):
    """The pairs it learned from: most good documents are worth more than most poor ones, and the threshold parts them best."""
    model = quality.fit(*parts(spark), ~samples.held_out(4, 2))
    known = given("documents").merge(given("labels"), on="doc_id")
    known = known[[zlib.crc32(str(i).encode()) % 4 != 2 for i in known.doc_id]]
    worth = np.array([np.dot(np.array(brute_measures(t)) - model.centre, model.weights) for t in known.text])
    good, poor = worth[known.quality == 1], worth[known.quality == 0]
    assert (good[:, None] > poor[None, :]).mean() > 0.97

    def parted(cut):
        return (good >= cut).mean() + (poor < cut).mean()

    assert parted(model.threshold) >= max(map(parted, worth)) - 0.02


def test_toxicity_scores_by_definition(spark):
    """Every score of the query follows from the bags of single words, put together here text by text."""
    got = {r["doc_id"]: r["score"] for r in queries.QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    model = toxicity.fit(*parts(spark), ~samples.held_out(5, 0))
    docs, bags = given("documents"), {}
    assert set(got) == set(docs.doc_id)
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        bag = Counter()
        for word, n in Counter(w.lower() for w in WORD.findall((text or "").encode())).items():
            if word not in bags:
                bags[word] = Counter(toxicity.subwords([word.decode()])[1].tolist())
            bag.update({bucket: n * m for bucket, m in bags[word].items()})
        total = sum(map(math.sqrt, bag.values())) + toxicity.UNKNOWN_WEIGHT
        score = sum(float(model.weights[b]) * math.sqrt(n) for b, n in bag.items()) / total
        assert math.isclose(got[doc_id], sigma(score + model.intercept), abs_tol=1e-4)


def test_quality_learns_from_every_labelled_document(spark):
    """More documents than a sample held before: each stands in a pair, and the centre is that of them all."""
    n = 7000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string"), F.when(F.col("id") % 5 == 0, " !!")).alias("text"))
    docs = docs.withColumn("text", F.coalesce("text", F.concat(F.lit("some words "), F.col("doc_id").cast("string"))))
    labels = docs.select("doc_id", (F.col("doc_id") % 5 != 0).cast("int").alias("quality"))
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    model = quality.fit(docs, labels, F.lit(True))
    assert np.allclose(model.centre, quality.measures(texts).mean(axis=0), atol=1e-9)
    known = docs.select("doc_id", (F.col("doc_id") % 5 != 0).cast("int").alias("label"), F.array(F.col("doc_id").cast("double")).alias("values"))
    met = quality.pairs(known, n // 5, n - n // 5).collect()
    assert len(met) >= quality.PAIRS and len({(r["good"][0], r["poor"][0]) for r in met}) == len(met)
    assert {r["good"][0] for r in met} | {r["poor"][0] for r in met} == set(map(float, range(n)))
    assert all(r["good"][0] % 5 and not r["poor"][0] % 5 for r in met)
