import zlib

import numpy as np
import pyarrow.parquet as pq

from pairloom.llm import language, queries, samples
from pyspark.sql import functions as F


def slow_bundle(text):
    """Bundle by the definition, one trigram after the other."""
    slots, vectors = language._tables()
    seen = [0, *(slots[ord(c)] for c in text.lower()), 0]
    total = np.zeros(language.DIMENSIONS)
    for a, b, c in zip(seen, seen[1:], seen[2:], strict=False):
        if b:
            total += np.roll(vectors[a], 2).astype(int) * np.roll(vectors[b], 1) * vectors[c]
    return total / np.linalg.norm(total) if total.any() else total


def test_bundles_by_definition():
    texts = ["Der Öl, the", "", None, "1 2 !", "é中文 x", "aaaa " * 50]
    assert np.allclose(language.bundles(texts), [slow_bundle(t or "") for t in texts], atol=1e-5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op10_language"](spark, sf).toPandas()
    docs = pq.read_table(f"{sf}/documents.parquet").to_pandas().merge(got, on="doc_id")
    assert len(docs) == len(got) == 1000
    assert (docs.held_out == docs.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert (docs.lang == docs.lang_pred)[docs.held_out].mean() > 0.97
    assert docs.score.between(0, 1).all()


def test_odd_rows(spark):
    rows = [(i, "die von und der das", "de") for i in range(20)] + [(i, "the of and to in", "en") for i in range(20, 40)]
    rows += [(None, None, None), (40, None, "en"), (41, "", None), (42, "12 !", "de"), (43, "the of " * 50_000, None), (43, "the of", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = language.fit(docs, F.lit(True))
    got = {(r["doc_id"], r["text"]): r["p"] for r in docs.select("*", language.prediction(docs, model).alias("p")).collect()}
    assert model[0] == ["de", "en"] and all(got[i, t]["lang"] == lang for i, t, lang in rows[:40])
    assert [got[k][0] for k in ((None, None), (41, ""), (42, "12 !"), (43, "the of"))] == ["und", "und", "und", "en"]
    empty = docs.limit(0)
    assert empty.select(language.prediction(empty, language.fit(empty, F.lit(True))).alias("p")).collect() == []
    assert language.fit(docs, F.lit(False))[0] == []


def test_samples_are_bounded(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 10 = 0, 'rare', 'hot') AS label")
    got = {r["label"]: r["count"] for r in samples.sample(rows, "label", 500).groupBy("label").count().collect()}
    assert all(400 < got[k] < 600 for k in ("rare", "hot"))
