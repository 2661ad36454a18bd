"""Hashed word shingles of whole texts, worked out for many texts at once.

A word is a longest run of ASCII letters, digits and characters beyond ASCII;
ASCII capitals count as small letters.  A shingle is five words in a row.  A
text of one to four words has one shingle of all its words, a text without
words (null, empty, signs only) has none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SHINGLE_WORDS = 5
#: Texts are hashed in chunks of about so many characters, which bounds memory.
CHUNK_CHARS = 300_000

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers, the same on every machine."""
    return mix((np.arange(1, n + 1, dtype=_U) + _U(seed << 32)) * _U(0x9E3779B97F4A7C15))


_BASE = _U(0x9E3779B97F4A7C15)
_PLACE = seeded(SHINGLE_WORDS, 2) | _U(1)


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256)
    lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    word = (codes >= 128) | ((codes >= 48) & (codes <= 57)) | ((lower >= 97) & (lower <= 122))
    return seeded(256, 1)[lower], word


_BYTE_HASH, _IS_WORD = _byte_tables()


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=_U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8)
    inside = _IS_WORD[raw]
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    bounds = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)))
    counts = np.diff(np.searchsorted(starts, bounds))
    if not len(starts):
        return np.zeros(0, dtype=_U), counts
    ends = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
    lengths = ends - starts
    offsets = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(offsets, lengths)
    terms = _BYTE_HASH[raw[inside]] * _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, offsets) + lengths.astype(_U)), counts


def shingle_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all texts in order, and the number of shingles of each text."""
    words, counts = word_hashes(texts)
    if not len(words):
        return words, counts
    n = len(words)
    first = np.cumsum(counts) - counts
    of = np.repeat(np.arange(len(counts)), counts)
    left = (first + counts)[of] - np.arange(n)
    total = np.zeros(n, dtype=_U)
    for k in range(SHINGLE_WORDS):
        reach = max(0, n - k)
        total[:reach] += np.where(left[:reach] > k, words[k:] * _PLACE[k], _U(0))
    whole = (left >= SHINGLE_WORDS) | (np.arange(n) == first[of]) & (counts[of] < SHINGLE_WORDS)
    return mix(total[whole]), np.bincount(of[whole], minlength=len(counts))


def chunks(texts: Sequence[str | None], chars: int = CHUNK_CHARS) -> Iterator[slice]:
    """Runs of texts of at most ``chars`` characters, or one longer text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if size and size + n > chars:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts))
