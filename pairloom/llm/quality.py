"""Quality scores learned from preference pairs.

By the Bradley-Terry model, a document with worth a is preferred to one with
worth b with probability sigma(a - b).  Worth is a linear function of measures
of the text, so the weights follow from a logistic loss on the differences of
measures over pairs of a good and a poor document.  Every labelled document
stands in a pair, and Spark fits the weights.  A quantile of the worth of all
training texts is the threshold between the two labels: the one that parts
the labels best, counted over all of them.  A score is sigma of the worth,
shifted so that the threshold stands at ``ACCEPTED``.

Defined results: a null text counts as empty; an empty text has measures of
zero and a score like any other.  Rows with null labels are not learned from.
Without both labels nothing is learned: all scores are 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm import samples, shingles
from pairloom.operators.numbering import numbered, shuffled_order
from pairloom.session import staged

ACCEPTED = 0.7
#: Pairs that a model is fitted on, at least: documents of small tables stand in several.
PAIRS = 30_000
_PENALTY = 1e-4
_ROUNDS = 100
_QUANTILES = 400
#: Ranks of the approximate quantiles are off by one in this many at most; what a cut parts is counted exactly.
_ACCURACY = 100_000
_U = np.uint64

_BYTES = np.arange(256)
_IS_SIGN = (_BYTES > 32) & (_BYTES < 127) & ~shingles._IS_WORD
#: Columns of byte counts: one for each ASCII sign, then kinds of bytes.
_KIND = np.zeros(256, dtype=np.int64)
_KIND[_IS_SIGN] = np.arange(_IS_SIGN.sum())
_FIRST = int(_IS_SIGN.sum())
for _n, _of in enumerate((
    (_BYTES >= 48) & (_BYTES <= 57), (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122),
    _BYTES >= 192, (_BYTES >= 128) & (_BYTES < 192), _BYTES == 32, _BYTES == 10, (_BYTES < 32) & (_BYTES != 10) | (_BYTES == 127),
)):
    _KIND[_of] = _FIRST + _n
_KINDS = _FIRST + 8


def _distinct(of: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different hashes each text has, and how often its commonest occurs."""
    order = np.lexsort((hashes, of))
    o, h = of[order], hashes[order]
    new = np.flatnonzero(np.concatenate(([True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])))) if len(o) else np.zeros(0, int)
    most = np.zeros(n)
    np.maximum.at(most, o[new], np.diff(np.append(new, len(o))))
    return np.bincount(o[new], minlength=n), most


def measures(texts: Sequence[str | None]) -> np.ndarray:
    """A row of measures for each text."""
    n = len(texts)
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(p) for p in parts])
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
    of = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(of * _KINDS + _KIND[raw], minlength=n * _KINDS).reshape(n, _KINDS)
    words, n_words = shingles.word_hashes(texts)
    n_different, commonest = _distinct(np.repeat(np.arange(n), n_words), words, n)
    runs, n_runs = shingles.shingle_hashes(texts)
    different_runs, _ = _distinct(np.repeat(np.arange(n), n_runs), runs, n)
    lines = [t.split("\n") if t else [] for t in texts]
    some = np.maximum(n_words, 1)
    rest = np.stack([
        np.log1p(n_words), np.log1p(sizes), sizes / some, n_different / some, commonest / some,
        different_runs / np.maximum(n_runs, 1), n_words / np.array([len(x) + 1 for x in lines]),
        [len(set(x)) / max(1, len(x)) for x in lines],
    ], axis=1)
    return np.concatenate([np.sqrt(kinds / np.maximum(sizes, 1)[:, None]), rest], axis=1)


@dataclass
class Model:
    centre: np.ndarray
    weights: np.ndarray
    threshold: float

    def worth(self, values: np.ndarray) -> np.ndarray:
        return (values - self.centre) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        shift = np.log(ACCEPTED / (1 - ACCEPTED))
        return 1 / (1 + np.exp(-np.clip(self.worth(values) - self.threshold + shift, -30, 30)))


def _all_measures(texts: Sequence[str | None]) -> np.ndarray:
    return np.concatenate([measures(texts[part]) for part in shingles.chunks(texts)] or [measures([])])


def _numbered(known: DataFrame, label: int) -> DataFrame:
    """``(doc_id, label, place)`` of the documents of a label, in a random order from 0."""
    ids = known.filter(F.col("label") > 0 if label else F.col("label") <= 0).select("doc_id", "label")
    placed = numbered(ids, shuffled_order(F.col("doc_id").cast("string"), "quality"), ["doc_id"], "place")
    return placed.withColumn("place", F.col("place") - 1)


def pairs(known: DataFrame, n_poor: int, n_good: int) -> DataFrame:
    """``(good, poor)``: measures of pairs of a good and a poor document of ``(doc_id, label, values)``, in random order.

    Documents of the commoner label stand in one pair, or in so many that there are
    ``PAIRS``; those of the other label stand in as many more as it takes.
    """
    many, few = (1, 0) if n_good > n_poor else (0, 1)
    n_many, n_few = max(n_good, n_poor), min(n_good, n_poor)
    rounds = -(-PAIRS // n_many)
    sides = [known.select("doc_id", "values").join(_numbered(known, of), "doc_id") for of in (many, few)]
    left = sides[0].select(F.col("values").alias("many"), "place", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"))
    left = left.select("many", ((F.col("place") + F.col("round")) % n_few).alias("place"))
    met = left.join(sides[1].select("place", F.col("values").alias("few")), "place")
    return met.select(*[F.col("many" if of == many else "few").alias(name) for name, of in (("good", 1), ("poor", 0))])


def _weights(known: DataFrame, n_poor: int, n_good: int, spread: np.ndarray) -> np.ndarray:
    """Weights of the measures in units of their spread: the least logistic loss on the differences of pairs."""
    units = F.array(*[F.lit(float(x)) for x in 1 / spread])
    met = pairs(known, n_poor, n_good)
    # a pair seen from the other side has the opposite difference and the opposite label, and the same loss
    seen = met.select("good", "poor", F.pmod(F.xxhash64("good", "poor"), F.lit(2)).cast("double").alias("label"))
    sign = F.col("label") * 2 - 1
    difference = F.zip_with(F.zip_with("good", "poor", lambda x, y: x - y), units, lambda d, u: d * u)
    rows = seen.select("label", array_to_vector(F.transform(difference, lambda d: d * sign)).alias("features"))
    learner = LogisticRegression(maxIter=_ROUNDS, regParam=_PENALTY, fitIntercept=False, standardization=False)
    return learner.fit(rows).coefficients.toArray()


def _threshold(known: DataFrame, model: Model) -> float:
    """The quantile of the worth of all training texts that parts the labels best."""
    sent = known.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def worth(values: pd.Series) -> pd.Series:
        return pd.Series(sent.value.worth(np.stack(values.tolist())) if len(values) else np.zeros(0))

    @F.pandas_udf("int")
    def cuts_passed(of: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, of.to_numpy(), side="right").astype(np.int32))

    worths = known.select((F.col("label") > 0).alias("good"), worth("values").alias("worth"))
    shares = [float(q) for q in np.linspace(0, 1, _QUANTILES + 1)]
    cuts = np.unique(worths.agg(F.percentile_approx("worth", shares, _ACCURACY)).first()[0])
    counted = worths.groupBy("good", cuts_passed("worth").alias("passed")).count().collect()
    found = np.zeros((2, len(cuts) + 1))
    for r in counted:
        found[int(r["good"]), r["passed"]] += r["count"]
    below = found.cumsum(axis=1)[:, :-1]  # texts of either label that a cut stands above
    poor, good = found.sum(axis=1)
    parted = 1 - below[1] / good + below[0] / poor
    return float(cuts[parted >= parted.max() - 1e-12].mean())


def fit(
    docs: DataFrame, labels: DataFrame, trainable: Column, label_col: str = "quality", per_label: tuple[int, int] | None = None
) -> Model | None:
    """A model learned from all labelled documents, or from about ``per_label`` of either label.

    The texts are measured where they are, and their measures stored: a row of some
    fifty numbers, however long a text is.  The driver gets sums, weights and counts.
    """
    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_all_measures(texts.tolist())))

    wanted = samples.known_labels(labels, label_col, trainable)
    if per_label is not None:
        wanted = samples.few_labels(wanted, per_label)
    # measured before the join, so that no text is shuffled
    values = docs.select(F.col("doc_id").cast("long").alias("doc_id"), measured(F.col("text").cast("string")).alias("values"))
    known = staged(values.join(wanted, "doc_id").groupBy("doc_id", "label").agg(F.min("values").alias("values")), "quality_measures")
    n_good, n = known.agg(F.count_if(F.col("label") > 0), F.count(F.lit(1))).first()
    if not 0 < n_good < n:
        return None
    summary = Summarizer.metrics("mean", "variance").summary(array_to_vector("values"))
    found = known.select(summary.alias("found")).first()["found"]
    centre, spread = found["mean"].toArray(), np.sqrt(found["variance"].toArray() * (n - 1) / n) + 1e-3
    model = Model(centre, _weights(known, n - n_good, n_good, spread) / spread, 0.0)
    return Model(centre, model.weights, _threshold(known, model))


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> Column:
    """A column with each text's score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        values = texts.tolist()
        return pd.Series(sent.value.score(_all_measures(values)) if sent.value else np.zeros(len(values)))

    return scored(F.col(text_col).cast("string"))
