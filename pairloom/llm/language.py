"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1.  Three letters in a row
are bound into one vector: the first is rotated twice, the second once, and
the three are multiplied.  The bound vectors of a text are added up (bundled).
A language's prototype is the sum of the unit vectors of its training texts,
and a text is given the language whose prototype is nearest by cosine.

Letters are small letters of any script; all else is a gap between words, which
has a vector of its own.  Code points share a bounded number of vectors.

Defined results: a null text, or one without letters, is ``und`` with score 0,
and so is every text if nothing could be learned.  Equal cosines go to the
first language in alphabetical order.  Null languages are not learned from.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm import samples, shingles

DIMENSIONS = 1024
_SLOT_BITS = 10
#: Training texts of a language.
PER_LANGUAGE = 1500
#: Tasks that bundle the training texts; each sends a sum for every language.
FIT_TASKS = 16
#: Texts bundled at once; with CHUNK_CHARS it bounds the table of counts.
_TEXTS = 128
UNKNOWN = "und"


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The slot of every code point, 0 for a gap, and the vector of every slot."""
    points = np.arange(0x110000, dtype=np.uint64)
    letters = np.array([chr(i).isalpha() for i in range(0x110000)])
    # code points below 0x180 (European letters) have slots of their own
    hashed = 0x180 + (shingles.mix(points) % np.uint64((1 << _SLOT_BITS) - 0x180)).astype(np.int64)
    slots = np.where(letters, np.where(points < 0x180, points.astype(np.int64), hashed), 0)
    bits = shingles.seeded((DIMENSIONS // 64) << _SLOT_BITS, 10).view(np.uint8)
    vectors = np.unpackbits(bits).reshape(1 << _SLOT_BITS, DIMENSIONS).astype(np.int8) * 2 - 1
    return slots.astype(np.int32), vectors


def _trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The text and the number of every three letters or gaps around a letter."""
    slots, _ = _tables()
    joined = "\n\n".join(t.lower() for t in texts) + "\n\n"
    found = slots[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    lengths = np.array([len(t.lower()) + 2 for t in texts])
    of = np.repeat(np.arange(len(texts)), lengths)
    before, after = np.concatenate(([0], found[:-1])), np.concatenate((found[1:], [0]))
    middle = found != 0
    number = (before[middle].astype(np.int64) << (2 * _SLOT_BITS)) | (found[middle].astype(np.int64) << _SLOT_BITS) | after[middle]
    return of[middle], number


def bundles(texts: Sequence[str | None]) -> np.ndarray:
    """A row with the unit bundle of each text, or zeros if it has no letters."""
    _, vectors = _tables()
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    for start in range(0, len(texts), _TEXTS):
        part = [t or "" for t in texts[start : start + _TEXTS]]
        of, number = _trigrams(part)
        if not len(of):
            continue
        used, place = np.unique(number, return_inverse=True)
        mask = (1 << _SLOT_BITS) - 1
        bound = np.roll(vectors[used >> (2 * _SLOT_BITS)], 2, axis=1)
        bound *= np.roll(vectors[(used >> _SLOT_BITS) & mask], 1, axis=1)
        bound *= vectors[used & mask]
        counts = np.bincount(of * len(used) + place, minlength=len(part) * len(used)).reshape(len(part), -1)
        sums = np.zeros((len(part), DIMENSIONS), dtype=np.float32)
        for low in range(0, len(used), 4096):
            sums += counts[:, low : low + 4096].astype(np.float32) @ bound[low : low + 4096].astype(np.float32)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        out[start : start + len(part)] = np.divide(sums, norms, out=np.zeros_like(sums), where=norms > 0)
    return out


def fit(docs: DataFrame, trainable: Column, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes.

    Learned from about ``per_language`` texts of every language, chosen by the
    hash of the id.  Tasks send one sum for each language they meet.
    """
    def bundled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch["lang"].to_numpy(), batch["text"].tolist()
            for part in shingles.chunks(texts):
                rows = bundles(texts[part])
                for lang in set(langs[part]):
                    sums[lang] = sums.get(lang, 0) + rows[langs[part] == lang].astype(np.float64).sum(axis=0)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "bundle": [s.tolist() for s in sums.values()]})

    rows = docs.filter(trainable).select(F.col("doc_id"), F.col("lang").cast("string"), F.col("text").cast("string")).filter("lang IS NOT NULL AND text IS NOT NULL")
    chosen = samples.sample(rows, "lang", per_language)
    sums: dict[str, np.ndarray] = {}
    for r in chosen.select("lang", "text").repartition(FIT_TASKS).mapInPandas(bundled, "lang string, bundle array<double>").collect():
        sums[r["lang"]] = sums.get(r["lang"], 0) + np.array(r["bundle"])
    sums = {k: v for k, v in sorted(sums.items()) if np.linalg.norm(v) > 0}
    return list(sums), np.array([v / np.linalg.norm(v) for v in sums.values()]).reshape(len(sums), DIMENSIONS)


def prediction(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> Column:
    """A column ``{lang, score}``; the score is the cosine, at least 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs, prototypes = sent.value
        names = np.array([*langs, UNKNOWN], dtype=object)
        for texts in batches:
            values = texts.tolist()
            best, score = np.full(len(values), len(langs)), np.zeros(len(values))
            for part in shingles.chunks(values) if langs else ():
                rows = bundles(values[part])
                near = rows.astype(np.float64) @ prototypes.T
                known = rows.any(axis=1)
                best[part] = np.where(known, near.argmax(axis=1), len(langs))
                score[part] = np.where(known, np.clip(near.max(axis=1), 0, 1), 0)
            yield pd.DataFrame({"lang": names[best], "score": score})

    return predicted(F.col(text_col).cast("string"))
