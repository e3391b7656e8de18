"""SetSketch registers of shingle sets: exponentially spaced truncated minima, their bands and joint estimation.

Register i of a set is ``floor(shift - log_b(min over elements of an exponential variate))`` cut to a byte: a maximum, so
sketches of parts merge by maximum. Two sets' registers agree more often the more alike the sets are, which makes bands of registers
locality-sensitive; the counts of registers above, below and equal give the Jaccard similarity by maximum likelihood.
"""

from __future__ import annotations

import numpy as np

from polyscribe.llm.kernels import mix

REGISTERS = 192
BASE, SHIFT = 1.1, 8.0
_RNG = np.random.Generator(np.random.PCG64(77))
_XOR = _RNG.integers(0, 2**32, REGISTERS, dtype=np.uint32)
_MUL = _RNG.integers(0, 2**32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_BAND_MUL = _RNG.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(elements: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Registers (rows x REGISTERS, uint8) of the non-empty sets that begin at ``starts`` in the 64-bit ``elements``."""
    u = (elements >> np.uint64(32)).astype(np.uint32)
    low = np.empty((REGISTERS, len(starts)), np.uint32)
    v = np.empty_like(u)
    for r in range(REGISTERS):
        np.bitwise_xor(u, _XOR[r], out=v)
        np.multiply(v, _MUL[r], out=v)
        np.bitwise_xor(v, v >> np.uint32(15), out=v)
        np.minimum.reduceat(v, starts, out=low[r])
    x = -np.log1p(-(low.T.astype(np.float64) + 0.5) / 2**32)
    return np.clip(np.floor(SHIFT - np.log(x) / np.log(BASE)), 0, 255).astype(np.uint8)


def rows_a_band(threshold: float) -> int:
    """The longest bands that a pair at the threshold misses altogether with a chance under one in a million."""
    chance = lambda r: (1 - threshold**r) ** (REGISTERS // r)
    return max((r for r in range(1, 13) if chance(r) < 1e-6), default=1)


def band_keys(registers: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` registers of each row (int64)."""
    bands = registers.shape[1] // rows
    r = (registers[:, : bands * rows].astype(np.uint64) + np.uint64(1)) * _BAND_MUL[: bands * rows]
    return mix(r.reshape(len(registers), bands, rows).sum(2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)


def first_common_band(a: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """For row pairs that share a band, the number of the first one shared."""
    bands = a.shape[1] // rows
    return (a == b)[:, : bands * rows].reshape(len(a), bands, rows).all(2).argmax(1)


def likeness(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of row pairs by maximum likelihood over (above, below, equal) register counts, sizes known.

    With relative sizes u + v = 1 the chance of 'above' is p(u - v J) and of 'below' p(v - u J), where
    p(x) = -log_b(1 - x (b - 1) / b). The likelihood is concave in J; a golden-section search finds its top.
    """
    above, below = (a > b).sum(1), (a < b).sum(1)
    same = REGISTERS - above - below
    u = size_a / (size_a + size_b)
    v = 1 - u
    p = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def value(j):
        pa, pb = p(u - v * j), p(v - u * j)
        return above * np.log(pa) + below * np.log(pb) + same * np.log(np.clip(1 - pa - pb, 1e-9, 1))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    g = (np.sqrt(5) - 1) / 2
    c, d = high - g * (high - low), low + g * (high - low)
    fc, fd = value(c), value(d)
    for _ in range(24):
        left = fc > fd
        low, high = np.where(left, low, c), np.where(left, d, high)
        c, d = high - g * (high - low), low + g * (high - low)
        fc, fd = value(c), value(d)
    return (low + high) / 2
