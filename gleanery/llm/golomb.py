"""Golomb coding of sorted 64-bit fingerprints (parameter a power of two, so the remainder is a fixed number of bits)."""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray, bits: int) -> tuple[bytes, int]:
    """Code ascending distinct `values` below 2**bits; returns the bytes and the remainder's width."""
    values = values.astype(np.uint64)
    n = len(values)
    if not n:
        return b"", 0
    gaps = np.diff(values, prepend=np.uint64(0))
    gaps[1:] -= np.uint64(1)
    width = max(0, int(np.log2(max(1.0, (1 << bits) / n * 0.69))))
    high, low = gaps >> np.uint64(width), gaps & np.uint64((1 << width) - 1)
    # unary part: `high` zeros then a one
    ends = np.cumsum(high.astype(np.int64) + 1)
    unary = np.zeros(int(ends[-1]), dtype=np.uint8)
    unary[ends - 1] = 1
    shifts = np.arange(width, dtype=np.uint64)
    fixed = ((low[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    return np.packbits(np.concatenate((unary, fixed))).tobytes(), width


def decode(data: bytes, n: int, width: int) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype=np.uint64)
    stream = np.unpackbits(np.frombuffer(data, dtype=np.uint8))
    ends = np.flatnonzero(stream)[:n]  # the unary part comes first, so its ones are the first n
    high = np.diff(ends, prepend=-1) - 1
    fixed = stream[ends[-1] + 1 : ends[-1] + 1 + n * width].reshape(n, width).astype(np.uint64)
    low = (fixed << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) if width else np.zeros(n, dtype=np.uint64)
    gaps = (high.astype(np.uint64) << np.uint64(width)) + low
    gaps[1:] += np.uint64(1)
    return np.cumsum(gaps, dtype=np.uint64)
