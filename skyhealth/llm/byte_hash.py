"""Hashes of many substrings of one byte array from one prefix sum."""

from __future__ import annotations

import numpy as np

from skyhealth.llm.common import mix64

_ODD = 0x5851F42D4C957F2D
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out, size = np.ones(n, np.uint64), 1
    while size < n:
        m = min(size, n - size)
        out[size:size + m] = out[:m] * np.uint64(pow(base, size, 1 << 64))
        size += m
    return out


class ByteHash:
    """A polynomial hash modulo 2^64 over random values of the bytes, finished
    with the length: the same for equal bytes, wherever they lie."""

    _up = _down = np.zeros(0, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(ByteHash._up) < n + 1:
            ByteHash._up = _powers(_ODD, n + 1)
            ByteHash._down = _powers(pow(_ODD, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * ByteHash._down[:n], out=self.sums[1:])

    def hash(self, first: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Hash of the ``size`` bytes from each ``first`` on."""
        h = (self.sums[first + size] - self.sums[first]) * ByteHash._up[first]
        return mix64(h ^ (np.asarray(size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
