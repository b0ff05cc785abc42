"""Vectorised word and n-gram hashing of one text (numpy, no Spark).

Words are maximal runs of bytes outside U+0020 and U+0009..U+000D; A-Z count as
a-z.  A word's 64-bit hash is a polynomial over its bytes, taken from prefix
sums of the whole text, so no Python loop runs over words or characters.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_SEED = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _SEED.integers(0, 2**64, 256, dtype=np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_STEP = _U(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("p")
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        p = np.full(size, _U(_BASE))
        q = np.full(size, _U(_BASE_INV))
        p[0] = q[0] = 1
        _powers["p"], _powers["q"] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _powers["p"], _powers["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """Final avalanche of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def run_bounds(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hash of each byte span ``raw[start:end]``."""
    if not len(starts):
        return np.empty(0, np.uint64)
    p, q = _power_table(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTE)[raw] * p[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * q[starts])


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, in order."""
    if not text:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = run_bounds(~_SPACE[raw])
    return span_hashes(raw, starts, ends)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows, in order; empty if there are fewer words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc = acc * _STEP + words[j : j + n]
    return mix(acc + _U(k))


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct k-word shingles; a shorter text is one shingle; no words: empty."""
    words = word_hashes(text)
    if not len(words):
        return words
    return np.unique(grams(words, min(k, len(words))))


def set_id(shingles: np.ndarray) -> int:
    """64-bit id (signed) of a sorted shingle set, equal for equal sets."""
    if not len(shingles):
        return 0
    order = np.arange(1, len(shingles) + 1, dtype=np.uint64)
    value = mix(np.array([(mix(shingles * _STEP + order) * (order | _U(1))).sum(dtype=np.uint64) + _U(len(shingles))]))
    return int(value.view(np.int64)[0])
