"""Packing of token sequences by best-fit decreasing over the whole corpus.

Documents become ids, closed by an end id.  Documents longer than a window are
cut into full windows and a rest.  Best-fit decreasing then takes the pieces
from the longest to the shortest and puts each into the window with the least
room that still holds it; a segment tree over room finds that window.

The method sees nothing of a piece but its length, and there are at most
WINDOW lengths.  So it runs on the counts of pieces by length: pieces of one
length and windows of one room are moved together, and the plan has a few rows
for each length, whatever the size of the corpus.  Spark numbers the pieces of
each length (salted, so that a common length is no single task's work) and
looks their places up in the plan.

Defined results: a null or empty text is a document of the end id alone; rows
with one id are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import functools
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from pairloom.llm import shingles
from pairloom.session import staged

WINDOW = 2048
END_ID = 1

#: Stretches of a generation: a Python worker remembers those met in the current and in the one before.
GENERATION = 100_000
#: Characters that the tokenizer gets in one piece; longer pieces cost more a character.
_PART_CHARS = 20_000
_GAPS = re.compile("[ \n\r\t]+")
#: Characters whose small letter, composition or kind is not plain (the dotted capital I among them), or that start a special token.
_BEYOND_LATIN = re.compile("[\u0130\u0250-\U0010ffff]|<\\|")
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_KINDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")

#: The letters that stand for bytes in byte-level tokens: visible signs for themselves, all others in turn for 256 and on.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
_BYTE_LETTERS = "".join(_OTHERS.get(b, chr(b)) if b != 0x20 else " " for b in range(256))

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"
_PLAN = "length long, first_rank long, pieces long, windows long, first_sequence long, first_offset long"


class _Words:
    """Ids of the tokenizer's stretches of text, each encoded once.

    The tokenizer never joins characters across white space, so a text's ids
    are those of its white-space separated stretches.  A text of Latin letters
    alone is also cut by kind of character and put into small letters, as the
    tokenizer itself does before its merges; the last token of such a stretch
    is marked as the end of a word, so no offsets are needed.  The memory of
    stretches lasts as long as the Python worker.  When it is full those not
    met since it was last full are forgotten, so common ones stay.
    """

    def __init__(self, tokenizer_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        # the same merges without what comes before them: it is done for whole lines of words at once
        bare = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(1 + max(vocabulary.values()), dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        beyond = [bool("<|" in t if t.isascii() else _BEYOND_LATIN.search(t)) for t in texts]
        split = [_GAPS.split(t) if b else _KINDS.findall(t.lower()) for t, b in zip(texts, beyond, strict=True)]
        if len(self.known) > GENERATION:
            self.known, self.older = {}, self.known
        for kind, encoded in ((False, self._words_encoded), (True, self._encoded)):
            met = set(itertools.chain.from_iterable(itertools.compress(split, [b is kind for b in beyond]))).difference(self.known)
            again = {w: self.older[w] for w in met if w in self.older}
            self.known.update(again)
            new = list(met.difference(again)) if again else list(met)
            if new:
                self.known.update(zip(new, encoded(new), strict=True))
        for words in split:
            yield b"".join(map(self.known.__getitem__, words))

    def _words_encoded(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words that the tokenizer takes as one each: a word's last token tells that it ends."""
        line, _ = codecs.charmap_decode(" ".join(words).encode("utf-8"), "strict", _BYTE_LETTERS)
        cuts, at = [0], _PART_CHARS
        while at < len(line) and (at := line.find(" ", at)) >= 0:
            cuts.append(at)
            at += _PART_CHARS
        parts = [line[a:b] for a, b in itertools.pairwise([*cuts, len(line)])]
        found = np.concatenate([np.array(e.ids, dtype="<u4") for e in self.bare.encode_batch_fast(parts, add_special_tokens=False)])
        bounds = (4 * np.flatnonzero(self.ends[found]) + 4).tolist()
        if len(bounds) != len(words) or bounds[-1] != 4 * len(found):
            return self._encoded(words)
        ids = found.tobytes()
        return (ids[a:b] for a, b in itertools.pairwise([0, *bounds]))

    def _encoded(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each stretch, from one call for all: offsets tell the stretch of an id."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4").tobytes()
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.fromiter((o[0] for o in found.offsets), dtype=np.int64, count=len(found.ids))
        bounds = [0, *(4 * np.searchsorted(starts, ends)).tolist()]
        return (ids[a:b] for a, b in itertools.pairwise(bounds))


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Documents as pieces of at most a window; ``ids`` holds little-endian unsigned 32-bit numbers."""
    end, step = end_id.to_bytes(4, "little"), 4 * window

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _words(tokenizer_path)
        for batch in batches:
            doc_ids, texts = batch["doc_id"].tolist(), [t or "" for t in batch["text"]]
            for part in shingles.chunks(texts):
                rows = []
                for doc_id, encoded in zip(doc_ids[part], words.encode(texts[part]), strict=True):
                    ids = encoded + end
                    rows += [
                        (doc_id, at // 4, len(ids[at : at + step]) // 4, ids[at : at + step], len(ids) // 4)
                        for at in range(0, len(ids), step)
                    ]
                out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens"])
                yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(cut, PIECES)


@functools.cache
def _words(tokenizer_path: str) -> _Words:
    return _Words(tokenizer_path)


class _Rooms:
    """Ranges of windows by their room; a segment tree finds the least room that is enough."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.open = [False] * (2 * self.size)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def _mark(self, room: int) -> None:
        node = self.size + room
        self.open[node] = bool(self.ranges[room])
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def add(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.ranges[room].append((first, count))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        taken = self.ranges[room].pop()
        self._mark(room)
        return taken

    def tightest(self, least: int) -> int | None:
        node = self.size + least
        while not self.open[node]:
            while node & 1:  # a right child: nothing of its parent lies further right
                node //= 2
            if not node:
                return None
            node += 1
        while node < self.size:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.size


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of pieces by length.

    A row sends the pieces of a length with ranks ``first_rank`` and on,
    dealt in turn, to ``windows`` sequences from ``first_sequence``; the first
    of each begins at ``first_offset``.
    """
    rooms, rows, sequences = _Rooms(window), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = rooms.tightest(length)
            if room is None:  # open as many windows as all that is left needs
                room, first = window, sequences
                available = -(-left // (window // length))
                sequences += available
            else:
                first, available = rooms.take(room)
            each = room // length
            # windows that take as many pieces as they hold, then one that takes the rest
            full = min(available, left // each)
            rest = left - full * each if full < available else 0
            for windows, held, at in ((full, each, first), (1, rest, first + full)):
                if windows and held:
                    rows.append((length, rank, windows * held, windows, at, window - room))
                    rooms.add(room - held * length, at, windows)
                    rank += windows * held
                    left -= windows * held
            rooms.add(room, first + full + bool(rest), available - full - bool(rest))
    return rows


def pack(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of :func:`pieces` with ``sequence_id`` and ``offset``; other columns are kept.

    ``found`` is read twice, so it should be a stored table.
    """
    spark = found.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "start", "doc_tokens")
    ranked = (
        salted.withColumn("_inside", F.row_number().over(inside)).join(shifts, ["length", "_salt"])
        .withColumn("_rank", F.col("_shift") + F.col("_inside") - 1)
    )
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # a few rows for each of at most `window` lengths: small enough for every task
    places = F.broadcast(spark.createDataFrame(plan(counts, window), _PLAN))
    turn = F.col("_rank") - F.col("first_rank")
    within = (F.col("_rank") >= F.col("first_rank")) & (F.col("_rank") < F.col("first_rank") + F.col("pieces"))
    here = ranked.alias("r").join(places.alias("p"), (F.col("r.length") == F.col("p.length")) & within)
    return here.select(
        *[F.col(f"r.{c}") for c in found.columns],
        (F.col("first_sequence") + turn % F.col("windows")).alias("sequence_id"),
        (F.col("first_offset") + F.floor(turn / F.col("windows")) * F.col("r.length")).alias("offset"),
    )


def packed_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their ids and places."""
    return pack(staged(pieces(docs, tokenizer_path, window, end_id), "pieces"), window)


def packed_digests(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """As :func:`packed_documents`, with the CRC-32 of each piece's ids instead of the ids."""
    found = pieces(docs, tokenizer_path, window, end_id).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return pack(staged(found, "pieces"), window)
