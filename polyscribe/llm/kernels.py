"""Vectorised text kernels over Arrow string columns (numpy, no per-row Python in the inner loops).

A *word* is a maximal run of bytes other than space and ``\\x09``-``\\x0D``; on UTF-8 that equals the
code-point pattern ``[^\\x20\\x09-\\x0D]+`` because no multi-byte sequence contains those bytes.
Hashes are fixed functions of the bytes: reruns, executors and Python processes agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_RNG = np.random.Generator(np.random.PCG64(20240229))
#: One random 64-bit value a byte, and the odd base of the polynomial over them.
_TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(1, 2**62)) * 8 + 5
_INVERSE = pow(_BASE, -1, 2**64)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x *= _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    x ^= x >> np.uint64(33)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        done = 1
        while done < size:
            step = np.uint64(pow(base, done, 2**64))
            have[done : 2 * done] = have[:done] * step
            done *= 2
        _powers[base] = have
    return have[:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def pieces(offsets: np.ndarray, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer text stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row where its words begin (n + 1 values)."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(raw)]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes, by prefix sums of a polynomial."""
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * powers(_BASE, len(raw)), out=prefix[1:])
    h = (prefix[stops] - prefix[starts]) * powers(_INVERSE, len(raw) + 1)[starts]
    return mix(h + (stops - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def shingle_hashes(h: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """A hash of each n consecutive entries of h (len(h) - n + 1 values), by doubling."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out, width, power, run = None, 0, 1, mix(h + np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        while power <= n:
            if n & power:
                if out is None:
                    out, width = run, power
                else:
                    a = np.uint64((0xD6E8FEB86659FD93 + 2 * (power + 64 * seed)) & (2**64 - 1) | 1)
                    m = len(h) - width - power + 1
                    out, width = mix(run[:m] * a + out[power : power + m]), width + power
            if 2 * power <= n:
                b = np.uint64((0xA0761D6478BD642F + 2 * (power + 64 * seed)) & (2**64 - 1) | 1)
                m = len(run) - power
                run = mix(run[:m] * b + run[power:])
            power *= 2
    return out


def row_of(starts: np.ndarray, n: int) -> np.ndarray:
    """For item offsets ``starts`` (rows + 1), the row of each of the n items."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def word_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, most: int = 1_000_000) -> np.ndarray:
    """span_hashes in runs of about ``most`` bytes, so that temporary arrays stay small."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(stops, a + most, "right")))
        out[i:j] = span_hashes(raw[a : stops[j - 1]], starts[i:j] - a, stops[i:j] - a)
        i = j
    return out
