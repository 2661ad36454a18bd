"""Document fingerprints: one-permutation MinHash, densified, cut to a few bits a bin.

Every shingle is hashed once.  The leading bits of the hash choose a bin, the
rest is the value; a bin keeps its least value.  An empty bin borrows from the
filled bin that a fixed random sequence, the same for all texts, meets first
(optimal densification).  Four bits of every bin are kept, so two unlike bins
agree with probability 1/16, which :func:`likeness` corrects for.

Defined results: equal texts have equal fingerprints.  A null text counts as an
empty one.  Texts without words have the empty fingerprint; they are fully
alike among themselves (1.0) and unlike any other (0.0).  Rows without an id
stand behind all others; rows with one id stand together, in the order of
their texts' hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pairloom.llm import shingles

BIN_BITS = 9
BINS = 1 << BIN_BITS
KEPT_BITS = 4
_CHANCE = 1 / (1 << KEPT_BITS)
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Ranges of the id that a shuffle partition gets on average.
RANGES_PER_PARTITION = 4
_LEAST = -(1 << 63)

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _densified(least: np.ndarray) -> np.ndarray:
    """Fill the empty bins of rows that have a filled one."""
    filled = least != _FREE
    row, place = np.nonzero(~filled & filled.any(axis=1)[:, None])
    out, attempt = least.copy(), 0
    while len(row):
        attempt += 1
        step = shingles.mix(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt << 20))
        donor = (step >> np.uint64(64 - BIN_BITS)).astype(np.int64)
        found = filled[row, donor]
        out[row[found], place[found]] = least[row[found], donor[found]]
        row, place = row[~found], place[~found]
    return out


def codes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A row of BINS small codes for each text, and whether the text has words."""
    hashes, counts = shingles.shingle_hashes(texts)
    least = np.full(len(counts) * BINS, _FREE)
    of = np.repeat(np.arange(len(counts)), counts)
    np.minimum.at(least, of * BINS + (hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64), hashes & (_FREE >> np.uint64(BIN_BITS)))
    dense = _densified(least.reshape(-1, BINS))
    return (shingles.mix(dense) & np.uint64((1 << KEPT_BITS) - 1)).astype(np.uint8), counts > 0


def packed(row: np.ndarray, has_words: bool) -> str:
    """The fingerprint as hexadecimal text, two codes a byte."""
    return ((row[0::2] << KEPT_BITS) | row[1::2]).tobytes().hex() if has_words else ""


def unpacked(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), dtype=np.uint8)
    return np.stack([raw >> KEPT_BITS, raw & ((1 << KEPT_BITS) - 1)], axis=1).reshape(-1)


def likeness(a: np.ndarray, b: np.ndarray, a_words: np.ndarray, b_words: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of the shingle sets behind rows of codes, from 0 to 1."""
    equal = (a == b).mean(axis=1)
    near = np.clip((equal - _CHANCE) / (1 - _CHANCE), 0, 1)
    return np.where(a_words & b_words, near, (a_words == b_words).astype(float))


def fingerprint_column(text_col: str = "text"):
    """A column with the fingerprint of each text."""
    @F.pandas_udf("string")
    def fingerprint(texts: pd.Series) -> pd.Series:
        values, out = texts.tolist(), []
        for part in shingles.chunks(values):
            rows, words = codes(values[part])
            out += map(packed, rows, words)
        return pd.Series(out, dtype=object)

    return fingerprint(F.col(text_col))


# ------------------------------------------------------------------ neighbours by id
def _in_order(docs: DataFrame) -> DataFrame:
    """Rows ``(bucket, guard, key, doc_id, text)``: descending ranges of the id, each with a copy of the next range's first row.

    Range bounds and the greatest id of each range are the only data that meet
    on the driver: some numbers for each range.  The texts are shuffled once.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = RANGES_PER_PARTITION * partitions
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("key"))
    found = ids.approxQuantile("key", [i / wanted for i in range(1, wanted)], 0.25 / wanted)
    bounds = F.lit(sorted({int(b) for b in found}) or [0]).cast("array<long>")
    steps = F.lit([1 << i for i in reversed(range(wanted.bit_length()))])

    def bucket_of(key):
        """How many bounds are not above the key, by bisection."""
        return F.aggregate(
            steps, F.lit(0),
            lambda low, step: F.when(
                (low + step <= F.size(bounds)) & (F.get(bounds, low + step - 1) <= key), low + step
            ).otherwise(low),
        )

    tops = {r["bucket"]: r["top"] for r in ids.groupBy(bucket_of(F.col("key")).alias("bucket")).agg(F.max("key").alias("top")).collect()}
    used = sorted(tops)
    greatest, before = [None] * (max(used, default=0) + 1), [None] * (max(used, default=0) + 1)
    for place, bucket in enumerate(used):
        greatest[bucket] = tops[bucket]
        before[bucket] = used[(place + 1) % len(used)]  # the first row of all comes again behind the last
    own = F.col("bucket")
    copied = F.when(
        F.get(F.lit(greatest).cast("array<long>"), own) == F.col("key"),
        F.struct(F.get(F.lit(before).cast("array<int>"), own).alias("bucket"), F.lit(True).alias("guard")),
    )
    placed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("bucket", bucket_of(F.col("key")))
    spread = placed.select(
        F.explode(F.filter(
            F.array(F.struct(own.alias("bucket"), F.lit(False).alias("guard")), copied), lambda x: x.isNotNull()
        )).alias("place"), "key", "doc_id", "text",
    ).select("place.*", "key", "doc_id", "text")
    return spread.repartition(partitions, "bucket").sortWithinPartitions(
        "bucket", "guard", F.desc("key"), F.xxhash64("text"), "text"
    )


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fingerprint every row, its edited text and its next row; a bucket ends with its first guard."""
    pending: tuple | None = None
    for batch in batches:
        rows = list(zip(batch["bucket"], batch["guard"], batch["doc_id"], batch["text"], strict=True))
        if pending is not None:
            rows.insert(0, pending)
        pending = rows[-1]
        ready = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[1] and a[0] == b[0]]
        for part in shingles.chunks([a[3] for a, _ in ready]):
            yield _rows(ready[part])


def _rows(ready: list[tuple]) -> pd.DataFrame:
    texts, following = [a[3] for a, _ in ready], [b[3] for _, b in ready]
    edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, following, strict=True)]
    rows, words = codes(texts)
    edited_rows, edited_words = codes(edited)
    # the next row of most rows is a row of this chunk: only the last one's text is new here
    last_row, last_words = codes(following[-1:])
    next_rows, next_words = np.concatenate([rows[1:], last_row]), np.concatenate([words[1:], last_words])
    for i in range(len(ready) - 1):
        if ready[i][1] is not ready[i + 1][0]:
            (next_rows[i],), (next_words[i],) = codes(following[i : i + 1])
    return pd.DataFrame({
        "doc_id": pd.Series([None if pd.isna(a[2]) else int(a[2]) for a, _ in ready], dtype="Int64"),
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
        "fingerprint": list(map(packed, rows, words)),
        "edited_fingerprint": list(map(packed, edited_rows, edited_words)),
        "near_edited": likeness(rows, edited_rows, words, edited_words),
        "near_next": likeness(rows, next_rows, words, next_words),
    })


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of all ``(doc_id, text)`` rows, of their edited texts, and their likeness.

    The next document is the one with the next lower id; after the last comes
    the first, which may be the document itself.  The edited text has its last
    third replaced by as many leading code points of the next text, or all it has.
    """
    return _in_order(docs).select("bucket", "guard", "doc_id", "text").mapInPandas(_compared, SCHEMA)
