"""Toxicity scores from a bag of subwords, with embeddings trained for the task.

A text is the bag of its subwords: every three to five bytes in a row of a word
together with its two edges, and every whole word.  Subwords share a bounded
number of embeddings by their hash.  The embeddings are averaged, and a linear
softmax gives the probability of either label; embeddings and softmax are
trained together by stochastic gradient steps in numpy.  A misspelt or inflected word the
training never met still shares most of its subwords with one that it met.

As the average and the softmax's inputs are linear, a trained model is one
number for each embedding: what it adds to the difference of the two inputs.
That is all that is sent to the tasks.

A subword met n times weighs the square root of n, so a word repeated without
end doesn't drown the rest, and the average is drawn towards zero by the weight
of UNKNOWN_WEIGHT unknown subwords, so a text of a few words needs more than one
odd word to be judged.  The intercept is fixed, so no evidence means label 0;
the result is put as if both labels were equally frequent.

Defined results: a null text counts as empty; texts without subwords have the
score of the intercept, as if the average were zero.  Rows with null labels are
not learned from.  Without both labels nothing is learned: all scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm import samples, shingles

BUCKET_BITS = 17
SIZES = (3, 4, 5)
DIMENSIONS = 8
UNKNOWN_WEIGHT = 60
#: Documents of each label, 0 and 1, that a model is fitted on.
PER_LABEL = (3000, 1500)
#: Training steps, and the most often that a document takes part in them.
STEPS, EPOCHS = 850, 30
_BATCH = 32
_RATE = 10.0
#: Squared gradient that an embedding has seen at the start: rare subwords, whose own sum stays small, move little.
_FAMILIAR = 1e-3
_EDGE = 0
#: The log odds of label 1 before the labels' frequencies are evened out, for a text without known subwords.
_NO_EVIDENCE = -2.5
_U = np.uint64


def subwords(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The text and the bucket of every subword."""
    parts = [b"\0" + (t or "").encode("utf-8", "surrogatepass") + b"\0" for t in texts]
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
    lengths = np.array([len(p) for p in parts])
    of = np.repeat(np.arange(len(parts)), lengths)
    inside = shingles._IS_WORD[raw]
    terms = np.where(inside, shingles._BYTE_HASH[raw], _U(_EDGE))
    docs, found = [], []
    for n in SIZES:
        windows = len(raw) - n + 1
        if windows <= 0:
            continue
        total, middle = np.zeros(windows, dtype=_U), np.ones(windows, dtype=bool)
        for k in range(n):
            total += terms[k : k + windows] * _PLACE[k]
            if 0 < k < n - 1:
                middle &= inside[k : k + windows]
        docs.append(of[:windows][middle])
        found.append(total[middle] + _U(n))
    words, counts = shingles.word_hashes(texts)
    docs.append(np.repeat(np.arange(len(counts)), counts))
    found.append(words)
    buckets = shingles.mix(np.concatenate(found)) >> _U(64 - BUCKET_BITS)
    return np.concatenate(docs), buckets.astype(np.int64)


_PLACE = shingles.seeded(max(SIZES), 6) | _U(1)


@dataclass
class Model:
    intercept: float
    weights: np.ndarray  # one number for each bucket


def _bags(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text, the bucket and the share of every distinct subword of the texts, by text."""
    of, buckets = subwords(texts)
    keys, counts = np.unique((of << BUCKET_BITS) | buckets, return_counts=True)
    of, weights = keys >> BUCKET_BITS, np.sqrt(counts)
    total = np.bincount(of, weights=weights, minlength=len(texts)) + UNKNOWN_WEIGHT
    return of, keys & ((1 << BUCKET_BITS) - 1), (weights / total[of]).astype(np.float32)


def _training_bags(texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    bags = []
    for part in shingles.chunks(texts):
        of, buckets, shares = _bags(texts[part])
        ends = np.searchsorted(of, np.arange(1, part.stop - part.start))
        bags += zip(np.split(buckets.astype(np.int32), ends), np.split(shares, ends), strict=True)
    return bags


def train(texts: Sequence[str], labels: Sequence[int], seed: int = 1) -> Model:
    """Fit embeddings and softmax jointly, with steps scaled by past gradients."""
    y = np.asarray(labels, dtype=np.float32)
    if len(set(labels)) < 2:
        return Model(float("-inf"), np.zeros(1 << BUCKET_BITS, dtype=np.float32))
    rng, bags = np.random.default_rng(seed), _training_bags(texts)
    embeddings = rng.uniform(-0.1, 0.1, ((1 << BUCKET_BITS), DIMENSIONS)).astype(np.float32)
    softmax, bias = rng.uniform(-1, 1, (2, DIMENSIONS)).astype(np.float32), np.array([-_NO_EVIDENCE / 2, _NO_EVIDENCE / 2], dtype=np.float32)
    past, past_embeddings = np.full(softmax.shape, 1e-8, dtype=np.float32), np.full(len(embeddings), _FAMILIAR, dtype=np.float32)
    for _ in range(min(EPOCHS, -(-STEPS * _BATCH // len(bags)))):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), _BATCH):
            rows = [bags[i] for i in order[start : start + _BATCH] if len(bags[i][0])]
            target = y[[i for i in order[start : start + _BATCH] if len(bags[i][0])]]
            if not rows:
                continue
            buckets, shares = (np.concatenate(x) for x in zip(*rows, strict=True))
            of = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
            firsts = np.cumsum([0, *(len(r[0]) for r in rows[:-1])])
            mean = np.add.reduceat(embeddings[buckets] * shares[:, None], firsts, axis=0)
            inputs = mean @ softmax.T + bias
            high = np.exp(inputs - inputs.max(axis=1, keepdims=True))
            error = high / high.sum(axis=1, keepdims=True)
            error -= np.stack([1 - target, target], axis=1)
            used, place = np.unique(buckets, return_inverse=True)
            # a text moves an embedding by its share times one vector: first sum the shares for each embedding and text
            share = np.zeros((len(used), len(rows)), dtype=np.float32)
            share[place, of] = shares
            step = share @ (error @ softmax)
            past_embeddings[used] += (step * step).mean(axis=1)
            embeddings[used] -= _RATE * step / np.sqrt(past_embeddings[used])[:, None]
            gradient = error.T @ mean
            past += gradient * gradient
            softmax -= 0.1 * gradient / np.sqrt(past)
    as_frequent = np.log((y == 0).sum() / (y == 1).sum())
    return Model(float(_NO_EVIDENCE + as_frequent), embeddings @ (softmax[1] - softmax[0]))


def scores(texts: Sequence[str | None], model: Model) -> np.ndarray:
    """The probability of label 1 for each text."""
    out = np.zeros(len(texts))
    for part in shingles.chunks(texts):
        of, buckets, shares = _bags(texts[part])
        out[part] = np.bincount(of, weights=model.weights[buckets] * shares, minlength=part.stop - part.start)
    return 1 / (1 + np.exp(-np.clip(out + model.intercept, -30, 30))) if np.isfinite(model.intercept) else out * 0


def fit(
    docs: DataFrame, labels: DataFrame, trainable: Column, label_col: str = "toxic", per_label: tuple[int, int] = PER_LABEL
) -> Model:
    """A model learned on the driver from about ``per_label`` documents of either label."""
    rows = samples.labelled(docs, labels, label_col, trainable, per_label).orderBy("doc_id").collect()
    return train([r["text"] for r in rows], [r["label"] for r in rows])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """A column with each text's probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(scores(texts.tolist(), sent.value))

    return scored(F.col(text_col).cast("string"))
