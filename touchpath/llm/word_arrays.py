"""Words of a UTF-8 text as arrays: bounds and hashes, without a Python object per word."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Powers:
    """Powers of the hash base and of its inverse, as long as the longest text so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, BASE))]).astype(np.uint64)
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, _INVERSE))]).astype(np.uint64)
        return self.up, self.down


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def bounds(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` in an array of bytes."""
    inside = np.zeros(len(text) + 2, dtype=bool)
    np.logical_not((text - np.uint8(9) <= 4) | (text == 32), out=inside[1:-1])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hashes of ranges of ``values`` (bytes, or hashes of words)."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: bytes, powers: Powers) -> np.ndarray:
    text = np.frombuffer(data, np.uint8)
    return range_hashes(text, *bounds(text), powers)
