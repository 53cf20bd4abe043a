"""Sets of word n-grams as 64-bit hashes, vectorised over the bytes of a text.

Words are runs of bytes other than ASCII white space, in lower case.  A text
with fewer than ``n`` words has the sequence of all its words as only n-gram; a
text without words has none.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15                      # odd, hence invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_power = [np.ones(1, np.uint64), np.ones(1, np.uint64)]     # of the base and its inverse, grown when needed


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    if len(_power[0]) < n:
        size = max(n, 1 << 16, 2 * len(_power[0]))
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _power[k] = np.cumprod(steps)
    return _power


def word_hashes(text: str) -> np.ndarray:
    b = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    word = ~_SPACE[b]
    edge = np.diff(word.view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * power[:len(b)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start])


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    n = min(n, len(w))
    h = np.zeros(len(w) - n + 1, np.uint64)
    for j in range(n):
        h = h * _STEP + w[j:len(w) - n + 1 + j]
    return np.unique(mix(h + np.uint64(n)))
