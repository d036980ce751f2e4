"""Words of many texts at once: bounds and hashes by array arithmetic over the UTF-8 bytes."""

from __future__ import annotations

import numpy as np

# Words are runs of ASCII letters and digits and of all bytes over 127; A-Z count as a-z.
FOLD = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
IN_WORD = np.array([48 <= c <= 57 or 97 <= FOLD[c] <= 122 or c >= 128 for c in range(256)])
STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, hence with an inverse modulo 2**64
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))
VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)  # a fixed number per byte


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    if n > 1:
        out[1:] = base
        np.cumprod(out, out=out)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bounds(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, and start and end of each word."""
    data = FOLD[np.frombuffer(text, np.uint8)]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = IN_WORD[data]
    turns = np.diff(inside)
    return data, np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span, equal for equal bytes wherever they stand."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(VALUE[data] * _powers(STEP, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(BACK, n + 1)[starts])


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words, from the hashes of the words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = out * STEP + words[i : len(words) - n + 1 + i]
    return mix(out)
