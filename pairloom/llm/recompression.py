"""Removal of repeated passages, found by recompression.

A passage of WINDOW words that also starts in a document with a smaller id is
removed, each of its words.  Comparing the names of all windows would shuffle
one row a word, so texts are first compressed: in each of ROUNDS rounds
neighbours become one symbol if they are equal (a run) or if a bit of their names
sends one left and the other right (a pair).  Whether two neighbours join
depends on them alone, so equal passages are cut alike but for their ends, and a
symbol's name is a hash of what it stands for: global without a dictionary.
What lies around a cut of the last round, as far as the cut depends on it, is an
interior name: a window that repeats holds the same interior names wherever it
stands.

The tables travel as chunks of documents: their words, coded and compressed, in
one row.  Spark then compares names in two rounds.  In the first, chunks ask
which interior names occur in several documents (windows without any ask for
themselves); whole documents are asked for as well, so that a copy of a smaller
document is settled.  In the second, windows all of whose interior names
are shared ask whether they occur in a document with a smaller id; there a
window is named by 96 bits of two independent hashes of its words.  A name is
asked for once by each chunk, whatever the number of its copies, and the
answers are one bit a name.

Defined results: words are longest runs without ASCII white space, unchanged; a
null or empty text has none.  Rows repeated for an id are documents of their
own, and neither is smaller than the other; rows without an id come after all
others.  Documents of fewer words than a window lose nothing.  An empty table
gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pairloom.llm import shingles
from pairloom.session import staged

WINDOW = 13
ROUNDS = 3
#: Words of a chunk, or one longer document.
CHUNK_WORDS = 250_000
#: Words of all chunks for each bucket of names that one task compares.
BUCKET_WORDS = 2_000_000

CHUNK = "chunk long, words long, ids binary, known binary, counts binary, vocabulary binary, codes binary"
ASK = "kind int, bucket long, chunk long, names binary, more binary"
ANSWER = "kind int, bucket long, chunk long, n int, bits binary"
RESULT = "doc_id long, n_words long, n_removed long, kept string"
_SHARED, _WHOLE, _WINDOWS = 0, 1, 2

_U = np.uint64
_LAST = np.iinfo(np.int64).max


# ------------------------------------------------------------------------------- chunks
def _pack(x: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(x if isinstance(x, bytes) else x.tobytes())


def _unpack(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=kind)


def _chunk_row(number: int, ids: list, texts: list[list[bytes]]) -> dict:
    codes, vocabulary = pd.factorize(np.array([w for words in texts for w in words], dtype=object))
    return {
        "chunk": number, "words": len(codes), "ids": _pack(np.array([_LAST if i is None else i for i in ids], dtype="<i8")),
        "known": _pack(np.array([i is not None for i in ids])), "counts": _pack(np.array([len(t) for t in texts], dtype="<i8")),
        "vocabulary": _pack(b" ".join(vocabulary.tolist())), "codes": _pack(codes.astype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")),
    }


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    number, ids, texts, words = TaskContext.get().partitionId() << 32, [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].astype("Int64").tolist(), batch["text"].tolist(), strict=True):
            found = (text or "").encode("utf-8", "surrogatepass").split()
            if ids and words + len(found) > CHUNK_WORDS:
                yield pd.DataFrame([_chunk_row(number, ids, texts)])
                number, ids, texts, words = number + 1, [], [], 0
            ids.append(None if doc_id is pd.NA else doc_id)
            texts.append(found)
            words += len(found)
    if ids:
        yield pd.DataFrame([_chunk_row(number, ids, texts)])


class Chunk:
    """Documents of a chunk, their words in one row with a separator before, between and after them."""

    def __init__(self, row) -> None:
        self.number = int(row["chunk"])
        self.ids, self.known = _unpack(row["ids"], "<i8"), _unpack(row["known"], bool)
        self.counts = _unpack(row["counts"], "<i8")
        self.vocabulary = np.array(_unpack(row["vocabulary"], np.uint8).tobytes().split(b" "), dtype=object)
        codes = _unpack(row["codes"], "<u1").view("<u2" if len(self.vocabulary) <= 1 << 16 else "<u4")
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.vocabulary.tolist())), dtype="<u8").reshape(-1, 2)
        self.starts = 1 + np.cumsum(self.counts + 1) - (self.counts + 1)
        self.is_word = np.ones(int(self.counts.sum()) + len(self.counts) + 1, dtype=bool)
        self.is_word[np.concatenate(([0], self.starts + self.counts))] = False
        self.codes = np.zeros(len(self.is_word), dtype=np.int64)
        self.codes[self.is_word] = codes
        self.doc = np.zeros(len(self.is_word), dtype=np.int64)
        self.doc[1:] = np.repeat(np.arange(len(self.ids)), self.counts + 1)
        self.first, self.second = np.where(self.is_word, digests[self.codes].T, _U(0))
        self.separators = np.concatenate(([0], np.cumsum(~self.is_word)))

    def whole(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the places from each start to before its end are words of one document."""
        inside = (starts >= 0) & (ends <= len(self.is_word))
        return inside & (self.separators[np.minimum(ends, len(self.is_word))] == self.separators[np.maximum(starts, 0)])

    def windows(self, window: int) -> np.ndarray:
        """Where a window of words begins."""
        return np.flatnonzero(self.whole(np.arange(len(self.is_word)), np.arange(len(self.is_word)) + window))


# ------------------------------------------------------------------------- recompression
@dataclass
class Symbols:
    """Symbols in order: names, where they begin, and the places ``low`` to ``high`` that the cut before each depends on."""

    name: np.ndarray
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray


def rounds(words: np.ndarray, is_word: np.ndarray, number: int = ROUNDS) -> Symbols:
    """The symbols after ``number`` rounds; separators stay symbols of their own."""
    start = np.arange(len(words))
    s, single = Symbols(words, start, start, start), ~is_word
    for turn in range(number):
        right = (shingles.mix(s.name + _U(turn + 1)) >> _U(63)).astype(bool)
        joined = np.zeros(len(s.name), dtype=bool)
        joined[1:] = (s.name[1:] == s.name[:-1]) | (~right[:-1] & right[1:])
        joined[1:] &= ~single[1:] & ~single[:-1]
        # a cut that stays depends on the symbols on both its sides, and so on the cuts before and after it
        low, high = s.low.copy(), s.high.copy()
        low[1:], high[:-1] = np.minimum(s.low[:-1], s.start[:-1]), np.maximum(s.high[1:], s.start[1:])
        low[0], high[-1] = -1, len(words) + 1
        at = np.flatnonzero(~joined)
        sizes = np.diff(np.append(at, len(joined)))
        head, tail = s.name[at], s.name[at + sizes - 1]
        runs = np.add.reduceat((s.name == np.repeat(head, sizes)).astype(np.int64), at)
        # a run of one symbol, then maybe a run of another: both and their lengths make the name
        made = shingles.mix(shingles.mix(head + runs.astype(_U)) ^ shingles.mix(tail - (sizes - runs).astype(_U)))
        s, single = Symbols(np.where(sizes == 1, head, made), s.start[at], low[at], high[at]), single[at]
    return s


def _multipliers(window: int, seed: int) -> np.ndarray:
    return shingles.seeded(window + 1, seed) | _U(1)


def named(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Hashes of the words from each start on, at most a window of them."""
    times = _multipliers(window, seed)
    total = lengths.astype(_U) * times[window]
    for k in range(window):
        on = lengths > k
        total += np.where(on, words[np.where(on, starts + k, 0)] * times[k], _U(0))
    return shingles.mix(total)


@dataclass
class Interior:
    """What a chunk asks in the first round, and which windows depend on it."""

    names: np.ndarray  # of interior names, then of windows without any; 48 bits each
    doc: np.ndarray
    low: np.ndarray  # the first and the last window that hold a name
    high: np.ndarray


def interior(chunk: Chunk, skipped: np.ndarray, window: int) -> Interior:
    """Names of a chunk's documents but the ``skipped``."""
    symbols = rounds(chunk.first, chunk.is_word)
    good = (symbols.high - symbols.low <= window) & chunk.whole(symbols.low, symbols.high)
    low, high = symbols.low[good], symbols.high[good]
    holders = np.zeros(len(chunk.is_word) + 1, dtype=np.int64)
    np.add.at(holders, np.maximum(high - window, 0), 1)
    np.add.at(holders, low + 1, -1)
    at = chunk.windows(window)
    alone = at[np.cumsum(holders)[at] == 0]
    starts, lengths = np.concatenate((low, alone)), np.concatenate((high - low, np.full(len(alone), window)))
    asked = ~skipped[chunk.doc[starts]]
    starts, lengths = starts[asked], lengths[asked]
    names = named(chunk.first, starts, lengths, window, 21) >> _U(16)
    return Interior(names, chunk.doc[starts], np.maximum(starts + lengths - window, 0), starts)


def _candidates(chunk: Chunk, found: Interior, shared: np.ndarray, settled: np.ndarray, window: int) -> np.ndarray:
    """Windows all of whose names are shared."""
    missing = np.zeros(len(chunk.is_word) + 1, dtype=np.int64)
    np.add.at(missing, found.low[~shared], 1)
    np.add.at(missing, found.high[~shared] + 1, -1)
    at = chunk.windows(window)
    return at[(np.cumsum(missing)[at] == 0) & ~settled[chunk.doc[at]]]


# ------------------------------------------------------------------------- asking
def _distinct(names: np.ndarray, more: np.ndarray, ids: np.ndarray):
    """Sorted distinct names: the first of each group, the group of each row, and each group's least and greatest id."""
    order = np.lexsort((more, names))
    a, b = names[order], more[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(order) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    of = np.empty(len(order), dtype=np.int64)
    of[order] = np.cumsum(new) - 1
    if not len(at):
        return a, b, of, ids[:0], ids[:0]
    return a[at], b[at], of, np.minimum.reduceat(ids[order], at), np.maximum.reduceat(ids[order], at)


def _slices(names: np.ndarray, bits: int, buckets: int) -> Iterator[tuple[int, slice]]:
    """Buckets and their parts of sorted names of so many bits."""
    if not len(names):
        return
    bucket = ((names >> _U(bits - 32)) * _U(buckets)) >> _U(32)
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(names)], strict=True):
        yield int(bucket[a]), slice(a, b)


def _six(names: np.ndarray) -> bytes:
    return names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _of_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


class Asking:
    """A chunk's names of one kind: the rows to send, and the answers put back to them."""

    def __init__(self, chunk: Chunk, kind: int, names: np.ndarray, more: np.ndarray, doc: np.ndarray) -> None:
        self.chunk, self.kind = chunk.number, kind
        self.own = chunk.ids[doc]
        self.names, self.more, self.of, self.least, self.greatest = _distinct(names, more, self.own)

    def rows(self, buckets: int) -> Iterator[tuple]:
        for bucket, part in _slices(self.names, 48 if self.kind == _SHARED else 64, buckets):
            if self.kind == _SHARED:
                yield self.kind, bucket, self.chunk, _six(self.names[part]), np.packbits(self.least[part] < self.greatest[part]).tobytes()
            else:
                names = self.names[part].astype("<u8").tobytes() + self.more[part].astype("<u4").tobytes()
                yield self.kind, bucket, self.chunk, names, _pack(self.least[part].astype("<i8"))

    def answered(self, answers: pd.DataFrame) -> np.ndarray:
        """One answer for each name that was handed in."""
        mine = answers[answers["kind"] == self.kind].sort_values("bucket")
        parts = [np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n) for bits, n in zip(mine["bits"], mine["n"], strict=True)]
        yes = np.concatenate(parts).astype(bool) if parts else np.zeros(0, dtype=bool)
        if len(yes) != len(self.names):
            raise ValueError(f"chunk {self.chunk} asked for {len(self.names)} names and got {len(yes)} answers")
        if self.kind == _SHARED:
            return yes[self.of]
        return yes[self.of] | (self.least[self.of] < self.own)


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    """Answers to all that was asked of one bucket: whether a name is in several documents, or in one with a smaller id."""
    shared = int(group["kind"].iloc[0]) == _SHARED
    if shared:
        names = list(map(_of_six, group["names"]))
        seen = [np.unpackbits(np.frombuffer(m, dtype=np.uint8), count=len(n)).astype(np.int64) for m, n in zip(group["more"], names, strict=True)]
        more = [np.zeros(len(n), dtype=np.uint32) for n in names]
    else:
        sizes = [len(x) // 12 for x in group["names"]]
        names = [np.frombuffer(x, dtype="<u8", count=n) for x, n in zip(group["names"], sizes, strict=True)]
        more = [np.frombuffer(x, dtype="<u4", offset=8 * n) for x, n in zip(group["names"], sizes, strict=True)]
        seen = [_unpack(x, "<i8") for x in group["more"]]
    ends = np.cumsum([len(n) for n in names])
    values = np.concatenate(seen)
    _, _, of, least, greatest = _distinct(np.concatenate(names), np.concatenate(more), values)
    yes = (np.bincount(of)[of] > 1) | (greatest[of] > 0) if shared else least[of] < values
    bits = [np.packbits(x).tobytes() for x in np.split(yes, ends[:-1])]
    return pd.DataFrame({
        "kind": group["kind"], "bucket": group["bucket"], "chunk": group["chunk"], "n": [len(n) for n in names], "bits": bits,
    })


# ------------------------------------------------------------------------- rounds of Spark
def _whole(chunk: Chunk, window: int) -> tuple[Asking, np.ndarray, np.ndarray]:
    """Documents of a window and more, asked for as wholes, and which those are."""
    times = _multipliers(1, 23)[0]
    at = np.flatnonzero(chunk.counts >= window)
    digests = [
        xxhash.xxh3_128_digest((chunk.first[s : s + n] * times).tobytes() + chunk.second[s : s + n].tobytes())
        for s, n in zip(chunk.starts[at].tolist(), chunk.counts[at].tolist(), strict=True)
    ]
    both = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    asking = Asking(chunk, _WHOLE, both[:, 0], both[:, 1].astype(np.uint32), at)
    copied = np.zeros(len(chunk.ids), dtype=bool)  # of a smaller document of this chunk
    copied[at] = asking.least[asking.of] < asking.own
    return asking, at, copied


def _first_questions(chunk: Chunk, window: int) -> tuple[Asking, Interior, Asking, np.ndarray, np.ndarray]:
    whole, at, copied = _whole(chunk, window)
    found = interior(chunk, copied, window)
    return Asking(chunk, _SHARED, found.names, np.zeros(len(found.names), dtype=np.uint32), found.doc), found, whole, at, copied


def _second_questions(chunk: Chunk, answers: pd.DataFrame, window: int) -> tuple[Asking, np.ndarray, np.ndarray]:
    shared, found, whole, at, settled = _first_questions(chunk, window)
    settled[at] |= whole.answered(answers)
    windows = _candidates(chunk, found, shared.answered(answers), settled, window)
    lengths = np.full(len(windows), window)
    names, more = (named(values, windows, lengths, window, seed) for values, seed in ((chunk.first, 25), (chunk.second, 27)))
    return Asking(chunk, _WINDOWS, names, (more >> _U(32)).astype(np.uint32), chunk.doc[windows]), windows, settled


def _kept(chunk: Chunk, answers: pd.DataFrame, window: int) -> pd.DataFrame:
    asking, windows, settled = _second_questions(chunk, answers, window)
    gone = windows[asking.answered(answers)]
    change = np.zeros(len(chunk.is_word) + 1, dtype=np.int64)
    np.add.at(change, gone, 1)
    np.add.at(change, gone + window, -1)
    removed = (np.cumsum(change)[:-1] > 0) | settled[chunk.doc]
    removed &= chunk.is_word
    upto = np.concatenate(([0], np.cumsum(removed)))
    texts = []
    for start, n in zip(chunk.starts.tolist(), chunk.counts.tolist(), strict=True):
        codes = chunk.codes[start : start + n][~removed[start : start + n]]
        texts.append(b" ".join(chunk.vocabulary[codes].tolist()).decode("utf-8", "surrogatepass"))
    ids = pd.array(chunk.ids, dtype="Int64")
    ids[~chunk.known] = pd.NA
    n_removed = upto[chunk.starts + chunk.counts] - upto[chunk.starts]
    return pd.DataFrame({"doc_id": ids, "n_words": chunk.counts, "n_removed": n_removed, "kept": texts})


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: every document without the passages that a document with a smaller id has, its words joined by one space."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = staged(rows.mapInPandas(_chunks, CHUNK), "chunks")
    total = chunks.agg(F.sum("words")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_WORDS))

    def ask_first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                shared, _, whole, _, _ = _first_questions(Chunk(row), window)
                yield pd.DataFrame([*shared.rows(buckets), *whole.rows(buckets)], columns=["kind", "bucket", "chunk", "names", "more"])

    def ask_second(_, chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        asking, _, _ = _second_questions(Chunk(chunk.iloc[0]), answers, window)
        return pd.DataFrame(list(asking.rows(buckets)), columns=["kind", "bucket", "chunk", "names", "more"])

    def keep(_, chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return _kept(Chunk(chunk.iloc[0]), answers, window)

    def answered(asked: DataFrame, name: str) -> DataFrame:
        return staged(asked.groupBy("kind", "bucket").applyInPandas(_compare, ANSWER), name)

    def told(answers: DataFrame, function, schema: str) -> DataFrame:
        return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(function, schema)

    first = answered(chunks.mapInPandas(ask_first, ASK), "first_answers")
    second = answered(told(first, ask_second, ASK), "second_answers")
    return told(first.unionByName(second), keep, RESULT)
