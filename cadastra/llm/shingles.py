"""Words and word shingles as 64-bit hashes (numpy inside Spark tasks).

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; only ``A-Z`` is
lower-cased, so ``bytes.lower().split()`` yields exactly the words. A shingle
is a window of ``n`` consecutive words; a text with fewer words than ``n`` but
at least one is a single shingle; a text without words (or null) has none.
Two different shingles share a hash with probability about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import xxhash

_M = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer: a bijection on uint64 whose output bits look independent."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes (uint64) of one text."""
    w = word_hashes(text)
    if len(w) == 0:
        return w
    if len(w) < n:
        acc = np.uint64(len(w))
        with np.errstate(over="ignore"):
            for h in w:
                acc = acc * _M + h
        return mix64(np.array([acc], np.uint64))
    acc = np.zeros(len(w) - n + 1, np.uint64)
    for k in range(n):
        acc = acc * _M + w[k : len(w) - n + 1 + k]
    s = np.sort(mix64(acc))  # numpy's unique takes several times as long
    return s[np.r_[True, s[1:] != s[:-1]]]


def set_signature(s: np.ndarray) -> int:
    """One signed 64-bit value naming a shingle set; equal sets have equal signatures."""
    return int(np.frombuffer(xxhash.xxh3_64_digest(s.tobytes())[::-1], "<i8")[0])
