"""Word n-grams of many texts at once, and a table that gives equal ones one slot.

A word is a longest run of ASCII letters, digits and characters beyond ASCII;
ASCII capitals count as small letters.  An n-gram is n words in a row, joined
by one space.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import xxhash

_U = np.uint64
#: The five fixed primes of the public 64-bit xxHash.
_P1, _P2, _P3, _P4, _P5 = map(_U, (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
))
_STRIPE = 32  # from this length on a hash works in stripes; such n-grams are hashed one by one
_LANE = 8

_CODES = np.arange(256)
_LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
_IS_WORD = (_CODES >= 128) | ((_CODES >= 48) & (_CODES <= 57)) | ((_LOWER >= 97) & (_LOWER <= 122))


@dataclass
class Grams:
    """Places of n-grams in ``buffer``, text by text, and how many words and n-grams each text has."""

    buffer: np.ndarray  # small letters, one space after each word, and zeros at the end
    starts: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    counts: np.ndarray


def grams(texts: Sequence[str | None], longest: int = 1) -> Grams:
    """All runs of one to ``longest`` words of each text."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8)
    inside = _IS_WORD[raw]
    before = np.concatenate(([False], inside[:-1]))
    begins, closes = inside & ~before, before & ~inside  # a sign follows every word: the last byte is one
    buffer = np.where(closes, np.uint8(32), _LOWER[raw])[inside | closes]
    buffer = np.concatenate((buffer, np.zeros(_LANE, dtype=np.uint8)))
    lengths = np.flatnonzero(closes) - np.flatnonzero(begins)
    starts = np.cumsum(lengths + 1) - lengths - 1
    bounds = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)))
    words = np.diff(np.searchsorted(np.flatnonzero(begins), bounds))
    if longest == 1:
        return Grams(buffer, starts, lengths, words, words)
    of = np.repeat(np.arange(len(words)), words)
    left = np.cumsum(words)[of] - np.arange(len(of))  # words from here to the end of the text
    size, first = np.meshgrid(np.arange(longest), np.arange(len(of)))
    there = size < left[:, None]
    first, last = first[there], (first + size)[there]
    return Grams(
        buffer, starts[first], starts[last] + lengths[last] - starts[first], words, np.bincount(of[first], minlength=len(words)),
    )


def _lanes(buffer: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buffer, _LANE)[at]).view("<u8").reshape(-1)


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << _U(bits)) | (x >> _U(64 - bits))


def hashes(found: Grams) -> np.ndarray:
    """The 64-bit xxHash of each n-gram, worked out for all of one length together."""
    out = np.empty(len(found.starts), dtype=_U)
    order = np.argsort(found.lengths, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(found.lengths[order])) + 1):
        if not len(some):
            continue
        length, at = int(found.lengths[some[0]]), found.starts[some]
        if length >= _STRIPE:
            out[some] = [xxhash.xxh64_intdigest(found.buffer[a : a + length].tobytes()) for a in at.tolist()]
            continue
        h, done = np.full(len(some), _P5 + _U(length)), 0
        while length - done >= 8:
            h = _turn(h ^ (_turn(_lanes(found.buffer, at + done) * _P2, 31) * _P1), 27) * _P1 + _P4
            done += 8
        if length - done >= 4:
            h = _turn(h ^ ((_lanes(found.buffer, at + done) & _U(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
            done += 4
        for k in range(done, length):
            h = _turn(h ^ (found.buffer[at + k].astype(_U) * _P5), 11) * _P1
        h = (h ^ (h >> _U(33))) * _P2
        h = (h ^ (h >> _U(29))) * _P3
        out[some] = h ^ (h >> _U(32))
    return out


def _same_bytes(found: Grams, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether n-grams ``a`` and ``b``, of equal lengths, hold equal bytes."""
    equal, lengths = np.ones(len(a), dtype=bool), found.lengths[a]
    for done in range(0, min(int(lengths.max(initial=0)), 4 * _LANE), _LANE):
        on = np.flatnonzero(lengths > done)
        # bytes beyond the end of an n-gram are shifted out
        beyond = (8 * np.clip(_LANE - (lengths[on] - done), 0, _LANE - 1)).astype(_U)
        x, y = (_lanes(found.buffer, found.starts[side[on]] + done) << beyond for side in (a, b))
        equal[on] &= x == y
    for k in np.flatnonzero(equal & (lengths > 4 * _LANE)).tolist():
        x, y, n = int(found.starts[a[k]]), int(found.starts[b[k]]), int(lengths[k])
        equal[k] = x == y or found.buffer[x : x + n].tobytes() == found.buffer[y : y + n].tobytes()
    return equal


class Table:
    """An open-addressed table of n-grams: one slot for all that hold equal bytes.

    ``of`` is the slot of each n-gram, ``bucket`` and ``count`` belong to slots.
    A slot is looked for from the hash on, one place further each time; an
    n-gram only settles where hash, length and bytes are its own.
    """

    def __init__(self, found: Grams, buckets: int, keys: np.ndarray | None = None) -> None:
        n = len(found.starts)
        keys = hashes(found) if keys is None else keys
        size = 1 << max(4, (2 * n).bit_length())
        owner = np.full(size, -1, dtype=np.int64)
        self.of, slot, open_ = np.empty(n, dtype=np.int64), (keys & _U(size - 1)).astype(np.int64), np.arange(n)
        while len(open_):
            at = slot[open_]
            free = owner[at] < 0
            owner[at[free]] = open_[free]  # of several one stays
            holder = owner[at]
            same = (keys[holder] == keys[open_]) & (found.lengths[holder] == found.lengths[open_])
            maybe = np.flatnonzero(same)
            same[maybe] = _same_bytes(found, holder[maybe], open_[maybe])
            self.of[open_[same]] = at[same]
            open_ = open_[~same]
            slot[open_] = (slot[open_] + 1) & (size - 1)
        self.used = np.flatnonzero(owner >= 0)
        self.count = np.bincount(self.of, minlength=size)
        self.bucket = np.zeros(size, dtype=np.int64)
        raw, firsts = found.buffer.tobytes(), owner[self.used]
        places = zip(found.starts[firsts].tolist(), (found.starts[firsts] + found.lengths[firsts]).tolist(), strict=True)
        self.bucket[self.used] = [zlib.crc32(raw[a:b]) % buckets for a, b in places]

    def counts(self, buckets: int) -> np.ndarray:
        """How many n-grams fall into each bucket."""
        return np.bincount(self.bucket[self.used], weights=self.count[self.used], minlength=buckets).astype(np.int64)
