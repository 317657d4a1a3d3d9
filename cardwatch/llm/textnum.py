"""Words and hashes of many texts at once, as array operations over their bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word; texts lie one after the other at `offsets`, `breaks` marks bytes between words."""
    solid = ~breaks[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
    after = np.concatenate([solid[1:], [False]]) if len(data) else solid
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        steps = np.full(size, b, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


@lru_cache(maxsize=2)
def _values(which: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[1 - which]))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads each input bit over all 64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHash:
    """Hash of any range of one buffer, of bytes or of 64-bit values, in constant time."""

    def __init__(self, data: np.ndarray, which: int = 0):
        size = 1 << max(10, int(len(data)).bit_length())
        self.up, self.down = _powers(_BASES[which], size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        values = _values(which)[data] if data.dtype == np.uint8 else data
        np.cumsum(values * self.up[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def join_hashes(parts: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive hashes; the result is shorter by k - 1."""
    out = np.zeros(max(0, len(parts) - k + 1), np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(_BASES[0]) + parts[j : j + len(out)])
    return out
