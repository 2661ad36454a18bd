import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from pairloom.llm import pii, toxicity
from tests.llm.test_jaccard_join import brute_classes
from tests.llm.test_pii import brute

SF = "/root/testdata/sf0.01"


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_stages_against_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stored, source = [], pq.read_table(f"{SF}/documents.parquet").to_pylist()
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        stored.append(docs.toPandas())
    language, polite, different, redacted, packed = stored

    # language: what goes has no letters or is like no language
    gone = {r["doc_id"] for r in source} - set(language.doc_id)
    assert all(r["n_chars"] < 40 or not any(c.isalpha() for c in r["text"]) for r in source if r["doc_id"] in gone) and len(gone) < 20

    # toxicity: the model's score decides, and agrees with held-out labels
    labels = pq.read_table(f"{SF}/labels.parquet").to_pandas()
    train = labels[labels.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 != 0)].set_index("doc_id").toxic
    of = {r["doc_id"]: r["text"] or "" for r in source}
    model = toxicity.train([of[i] for i in sorted(train.index)], [int(train[i]) for i in sorted(train.index)])
    score = toxicity.scores(language.text.tolist(), model)
    assert set(polite.doc_id) == set(language.doc_id[score < cp.TOXIC])

    # near duplicates: the least id of each class
    classes = brute_classes(list(zip(polite.doc_id, polite.text, strict=True)))
    assert set(different.doc_id) == {c for _, c, _ in classes} and len(different) < len(polite)

    # personal data: every span is replaced, the rest is as it was
    want = {}
    for doc_id, text, found in zip(different.doc_id, different.text, brute(different.text.tolist()), strict=True):
        at, out = 0, ""
        for span in filter(None, found[5].split(",")):
            kind, start, end = span.split(":")
            if int(start) >= at:
                out += text[at : int(start)] + f"[{kind.upper()}]"
            at = max(at, int(end))
        want[doc_id] = out + text[at:]
    assert dict(zip(redacted.doc_id, redacted.text, strict=True)) == want
    assert not any(pii.KINDS[0] in f"{x}" and "@mail" in x for x in redacted.text)

    # packing: every token once
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc_id, text in want.items():
        own = packed[packed.doc_id == doc_id].sort_values("start")
        ids = np.concatenate([np.frombuffer(x, dtype="<u4") for x in own.ids]).tolist()
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    for _, part in packed.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum().tolist()[:-1]] and part.length.sum() <= 2048


def test_odd_rows(spark):
    texts = [(1, "the and of in it is"), (1, "the and of in it is"), (1, "another text of some other words"), (2, None), (3, ""), (None, "with no id at all, it is here"), (4, "the and of in it is")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long, class_id string")
    kept = cp.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert rows(kept.select("doc_id", "text")) == Counter([(1, texts[0][1]), (1, texts[2][1]), (2, None), texts[5]])
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert cp.identify_language(spark, docs, SF).filter(F.col("text").isNull()).count() == 0
    assert cp.drop_toxic(spark, docs, SF).columns == docs.columns


def test_unlearned_languages_go(spark):
    """Texts in scripts that no learned language has go, but for one in some hundreds; learned texts stay, short ones too."""
    rng = np.random.default_rng(0)
    foreign = ["".join(map(chr, rng.integers(low, high, 60))) for low, high in ((0x4E00, 0x9000), (0x430, 0x450), (0x3B1, 0x3C9)) for _ in range(300)]
    foreign += ["Все люди рождаются свободными и равными в своем достоинстве и правах", "すべての人間は、生まれながらにして自由であり"]
    known = [r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist() if r["text"] and r["n_chars"] > 100]
    short = [" ".join(t.split()[:8]) for t in known]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "", "", 1) for i, t in enumerate([*foreign, *known, *short])], columns)
    kept = {r["doc_id"] for r in cp.identify_language(spark, docs, SF).select("doc_id").collect()}
    n = len(foreign)
    assert len([i for i in kept if i < n]) <= 0.01 * n
    assert len([i for i in kept if n <= i < n + len(known)]) >= 0.995 * len(known)
    assert len([i for i in kept if i >= n + len(known)]) >= 0.97 * len(short)
