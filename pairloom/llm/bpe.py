"""Byte-level BPE by replaying merges over a whole batch of words.

Texts are split into words by the tokenizer's pattern, and each new word of a
batch is encoded once.  All new words stand in one row of symbols, linked to
their neighbours.  An inverted index leads from a merge to the positions of its
token pairs; merges are applied in the order of their ranks, each at all its
positions, and only the pairs with the two touched neighbours are entered anew.

Inside a word the result must be that of always merging the leftmost pair of
the least rank.  A merge may bring about a pair of a lesser rank; the word's
other positions then wait until that one is done.  Words never touch, so their
order among each other is free.

Defined results: a null or empty text has no ids; bytes that are no UTF-8 can't
occur in a text.  An unknown id decodes to nothing.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm import shingles

#: Words that a Python worker remembers before it starts anew.
MAX_KNOWN = 300_000
#: Symbols that are merged at once, about.
MAX_SYMBOLS = 500_000
#: Texts are encoded in chunks of about so many characters: the larger, the more words share a merge.
CHUNK_CHARS = 1_000_000
#: Positions from which on a pair is merged at all of them in one step.
MANY = 24


class _Row:
    """Words in one row of symbols, and the inverted index from token pairs to positions."""

    def __init__(self, bpe: Bpe, symbols: np.ndarray, firsts: np.ndarray) -> None:
        n = len(symbols)
        self.bpe, self.bits, self.sym = bpe, bpe.bits, symbols.astype(np.int64)
        self.after, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        self.after[np.append(firsts[1:], n) - 1], self.before[firsts] = -1, -1
        self.of = np.zeros(n, dtype=np.int64)
        self.of[firsts[1:]] = 1
        self.of = np.cumsum(self.of)
        self.positions: dict[int, list[np.ndarray]] = {}
        self.pairs: dict[int, list[int]] = {}  # by rank
        self.heap: list[int] = []
        at = np.flatnonzero(self.after >= 0)
        self._enter(at, (self.sym[at] << self.bits) | self.sym[at + 1])

    def _ranks(self, pairs: np.ndarray) -> np.ndarray:
        return np.array([self.bpe.merge(p) for p in pairs.tolist()], dtype=np.int64)

    def _enter(self, at: np.ndarray, pairs: np.ndarray) -> None:
        """Enter positions under their pairs, as far as these can merge."""
        if not len(at):
            return
        order = np.argsort(pairs, kind="stable")
        at, pairs = at[order], pairs[order]
        starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])).tolist()
        for a, b in zip(starts, [*starts[1:], len(at)], strict=True):
            self._enter_one(int(pairs[a]), at[a:b])

    def _enter_one(self, pair: int, at: np.ndarray) -> None:
        rank = self.bpe.merge(pair)
        if rank < 0:
            return
        if pair in self.positions:
            self.positions[pair].append(at)
            return
        self.positions[pair] = [at]
        if rank in self.pairs:
            self.pairs[rank].append(pair)
        else:
            self.pairs[rank] = [pair]
            heappush(self.heap, rank)

    def merge_all(self) -> None:
        while self.heap:
            rank = heappop(self.heap)
            pairs = self.pairs.pop(rank)
            at = np.unique(np.concatenate([x for p in pairs for x in self.positions.pop(p)]))
            if len(at) < MANY or len(pairs) > 1 or pairs[0] >> self.bits == pairs[0] & ((1 << self.bits) - 1) or not self._merge_together(rank, pairs[0], at):
                self._merge_in_turn(rank, at)

    def _merge_together(self, rank: int, pair: int, at: np.ndarray) -> bool:
        """Merge one pair of different tokens everywhere; False, and nothing done, if that could bring about a lesser rank."""
        sym, after, before, bits = self.sym, self.after, self.before, self.bits
        left, right = pair >> bits, pair & ((1 << bits) - 1)
        at = at[(sym[at] == left) & (after[at] >= 0)]
        other = after[at]
        at, other = at[sym[other] == right], other[sym[other] == right]
        follower, leader = after[other], before[at]
        has_follower, has_leader = follower >= 0, leader >= 0
        meanwhile = np.concatenate([(rank << bits) | sym[follower[has_follower]], (sym[leader[has_leader]] << bits) | rank, [(rank << bits) | rank]])
        found = self._ranks(np.unique(meanwhile))
        if ((found >= 0) & (found < rank)).any():
            return False
        sym[at], sym[other] = rank, -1
        after[at], after[other] = follower, -1
        before[follower[has_follower]] = at[has_follower]
        leader = before[at]  # as it is after the merge
        has_leader = leader >= 0
        places = np.concatenate([at[has_follower], leader[has_leader]])
        self._enter(places, (sym[places] << bits) | sym[after[places]])
        return True

    def _merge_in_turn(self, rank: int, at: np.ndarray) -> None:
        """Merge from left to right; words that get a pair of a lesser rank wait with the rest of theirs."""
        sym, after, before, bits, merge = self.sym, self.after, self.before, self.bits, self.bpe.merge
        waiting, blocked = {}, -1
        for p in at.tolist():
            q = int(after[p])
            if q < 0 or sym[p] < 0:
                continue
            pair = (int(sym[p]) << bits) | int(sym[q])
            if merge(pair) != rank:
                continue  # a neighbour was merged away meanwhile
            if self.of[p] == blocked:
                waiting.setdefault(pair, []).append(p)
                continue
            follower, leader = int(after[q]), int(before[p])
            sym[p], sym[q], after[p], after[q] = rank, -1, follower, -1
            if follower >= 0:
                before[follower] = p
                blocked = self._touched(p, (rank << bits) | int(sym[follower]), rank, blocked)
            if leader >= 0:
                blocked = self._touched(leader, (int(sym[leader]) << bits) | rank, rank, blocked)
        for pair, places in waiting.items():
            self._enter_one(pair, np.array(places))

    def _touched(self, place: int, pair: int, rank: int, blocked: int) -> int:
        found = self.bpe.merge(pair)
        if found >= 0:
            self._enter_one(pair, np.array([place]))
        return int(self.of[place]) if 0 <= found < rank else blocked


class Bpe:
    """Encoder and decoder for a file of ranks and the pattern of its words."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.bits = max(self.tokens).bit_length()
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.find = regex.compile(pattern).findall
        self.merged: dict[int, int] = {}
        self.known: dict[str, bytes] = {}

    def merge(self, pair: int) -> int:
        """The id that a pair merges into, -1 if none."""
        found = self.merged.get(pair)
        if found is None:
            left, right = self.tokens[pair >> self.bits], self.tokens[pair & ((1 << self.bits) - 1)]
            found = self.merged[pair] = self.ranks.get(left + right, -1)
        return found

    def _replay(self, words: list[bytes]) -> Iterator[bytes]:
        """The ids of each word as little-endian 32-bit numbers."""
        lengths = np.array([len(w) for w in words])
        firsts = np.cumsum(lengths) - lengths
        row = _Row(self, self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)], firsts)
        row.merge_all()
        kept = row.sym >= 0
        bounds = np.append(0, np.cumsum(kept))[np.append(firsts, len(kept))] * 4
        ids = row.sym[kept].astype("<i4").tobytes()
        return (ids[a:b] for a, b in itertools.pairwise(bounds.tolist()))

    def _learn(self, words: list[str]) -> None:
        new: list[str] = []
        size = 0
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(raw)
            if whole is not None:
                self.known[word] = whole.to_bytes(4, "little")
                continue
            new.append(word)
            size += len(raw)
            if size > MAX_SYMBOLS:
                self.known.update(zip(new, self._replay([w.encode("utf-8", "surrogatepass") for w in new]), strict=True))
                new, size = [], 0
        if new:
            self.known.update(zip(new, self._replay([w.encode("utf-8", "surrogatepass") for w in new]), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.find(t) for t in texts]
        if len(self.known) > MAX_KNOWN:
            self.known.clear()
        self._learn(list(set(itertools.chain.from_iterable(split)).difference(self.known)))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype="<i4") for words in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens.get(i, b"") for i in ids])


@functools.cache
def _bpe(ranks_path: str, pattern: str) -> Bpe:
    return Bpe(ranks_path, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` of all texts."""
    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = _bpe(ranks_path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for part in shingles.chunks(texts, CHUNK_CHARS):
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[part].array, "ids": bpe.encode(texts[part])})

    return docs.select(F.col("doc_id"), F.col("text").cast("string")).mapInPandas(
        encoded, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>"
    )


def decode(ids: Column, ranks_path: str, pattern: str) -> Column:
    """The bytes of an array of ids."""
    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = _bpe(ranks_path, pattern)
        for batch in batches:
            yield pd.Series([None if x is None else bpe.decode(x.tolist()) for x in batch], dtype=object)

    return decoded(ids)
