"""Words and hashes of whole batches of text in numpy, without a Python object for each word.

A polynomial hash of every byte range comes from one running sum: with h[i] the sum of byte[j] * p**j over j < i,
(h[end] - h[start]) * p**-start is the hash of the range, modulo 2**64. Two random odd bases are kept apart where
equality must be beyond doubt.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


#: Values that are summed at one time; the tables of powers are as long, whatever the length of a text.
BLOCK = 1 << 19
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of base and of its inverse, `size` of them at least (BLOCK + 1 at most); one table for each base, which grows."""

    def run(b: int) -> np.ndarray:
        out = np.full(min(1 << max(16, size.bit_length()), BLOCK + 1), b & (2**64 - 1), dtype=U)
        out[0] = 1
        return np.multiply.accumulate(out)

    if base not in _tables or len(_tables[base][0]) < size:
        _tables[base] = run(base), run(pow(base, -1, 2**64))
    return _tables[base]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits (a 64-bit finaliser)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE_A) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each pair; the length takes part."""
    n = len(values)
    if not len(starts):
        return np.zeros(0, dtype=U)
    power, inverse = _powers(base, min(n, BLOCK) + 1)
    if n <= BLOCK:
        run = np.zeros(n + 1, dtype=U)
        np.cumsum((values.astype(U) + U(1)) * power[:n], out=run[1:])
        total = (run[ends] - run[starts]) * inverse[starts]
    else:  # the sums at all starts and ends, block by block: base ** (block * BLOCK) and its inverse carry them on
        places = np.concatenate((starts, ends))
        order = np.argsort(places, kind="stable")
        cuts = np.searchsorted(places[order], np.arange(0, n + BLOCK, BLOCK))
        sums = np.empty(len(places), dtype=U)
        before, factor = 0, 1
        step, back = pow(base, BLOCK, 2**64), pow(base, -BLOCK, 2**64)
        backs = []
        for k in range(len(cuts) - 1):
            block = values[k * BLOCK : (k + 1) * BLOCK]
            run = np.zeros(len(block) + 1, dtype=U)
            np.cumsum((block.astype(U) + U(1)) * power[: len(block)], out=run[1:])
            own = order[cuts[k] : cuts[k + 1]]
            sums[own] = run[places[own] - k * BLOCK] * U(factor) + U(before)
            before = (before + int(run[-1]) * factor) & (2**64 - 1)
            factor = factor * step & (2**64 - 1)
            backs.append(pow(back, k, 2**64))
        last = order[cuts[-1] :]
        sums[last] = U(before)  # ends behind the last value
        total = (sums[len(starts) :] - sums[: len(starts)]) * inverse[starts % BLOCK] * np.array(backs + [0], dtype=U)[starts // BLOCK]
    return mix(total + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True, cut at row offsets: starts, ends and the row of each."""
    n = len(inside)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def per_row(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets into items sorted by row: items of row r are out[r]:out[r + 1]."""
    return np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n)))).astype(np.int64)


def _fold() -> bytes:
    table = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalnum() else 32
    return bytes(table)


#: Bytes of words: ASCII letters (folded to lower case), digits and every byte beyond ASCII; the rest becomes a blank.
FOLD = _fold()


def words(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded words of a batch: starts, ends (in bytes), row of each and its hash."""
    folded = np.frombuffer(raw.translate(FOLD), dtype=np.uint8)
    starts, ends, row = runs(folded != 32, offsets)
    return starts, ends, row, range_hash(folded, starts, ends)


def shingles(hashes: np.ndarray, row: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of k consecutive words for each row, sorted by row and hash; fewer words than k make one shingle."""
    if not len(hashes):
        return np.zeros(0, dtype=U), np.zeros(n_rows + 1, dtype=np.int64)
    off = per_row(row, n_rows)
    count = np.diff(off)
    acc = np.zeros(len(hashes), dtype=U)
    for i in range(k):  # a word beyond its row takes no part
        shifted = np.zeros(len(hashes), dtype=U)
        shifted[: max(len(hashes) - i, 0)] = hashes[i:]
        if i:
            at = np.flatnonzero(np.arange(len(hashes)) + i >= off[row + 1])
            shifted[at] = 0
        acc = acc * U(BASE_B) + mix(shifted + U(i + 1))
    keep = np.arange(len(hashes)) + k <= off[row + 1]
    short = np.flatnonzero((count > 0) & (count < k))
    keep[off[short]] = True
    made, at = mix(acc[keep]), per_row(row[keep], n_rows)
    parts = [np.unique(made[at[i] : at[i + 1]]) for i in range(n_rows)]
    return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)
