"""Hashes of many runs of bytes at once."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xBF58476D1CE4E5B9)
LAST = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * STEP
    x = (x ^ (x >> np.uint64(27))) * LAST
    return x ^ (x >> np.uint64(31))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = 1 << int(n).bit_length()
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for i, factor in enumerate((BASE, inverse)):
            _POWERS[i] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, factor)]), dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of bytes times powers up to each place: differences hash any run of bytes."""
    factors, _ = powers(len(data) + 1)
    return np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * factors[: len(data)], dtype=np.uint64)])


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes, the same wherever it stands."""
    _, inverses = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def window_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from each place on."""
    n = len(sums) - 1
    _, inverses = powers(len(sums))
    return mix((sums[width:] - sums[: n + 1 - width]) * inverses[: n + 1 - width] + np.uint64(width))
