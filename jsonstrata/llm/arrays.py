"""Words and hashes of a text column as numpy arrays, many documents at a time.

All hashes are 64-bit and wrap. A polynomial over the bytes of a stretch comes from two prefix sums,
so the hash of every word costs a fixed number of array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the polynomials; the second makes an independent hash.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes handled by one round of array operations.
PIECE = 1 << 18
#: White space of the word definition: space, tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A copy of ``x`` with all bits spread over all bits."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, U64)
    up = np.concatenate([one, np.cumprod(np.full(size, base, U64), dtype=U64)])
    down = np.concatenate([one, np.cumprod(np.full(size, pow(base, -1, 1 << 64), U64), dtype=U64)])
    return up, down


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse, at least ``size`` of them; sizes double, so few are made."""
    return _powers(base, max(PIECE, 1 << max(size - 1, 1).bit_length()))


def stretches(data: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """The hash of each ``data[start:end]``; ``start`` ascends. Memory follows the longest stretch."""
    out = np.empty(len(start), U64)
    i = 0
    while i < len(start):
        low = int(start[i])
        # Short stretches stay within the smallest tables of powers.
        j = max(i + 1, int(np.searchsorted(start, low + PIECE // 2)))
        high = int(end[i:j].max())
        up, down = powers(base, high - low + 1)
        sums = np.zeros(high - low + 1, U64)
        np.cumsum((data[low:high].astype(U64) + U64(1)) * up[: high - low], out=sums[1:])
        first = start[i:j] - low
        out[i:j] = (sums[end[i:j] - low] - sums[first]) * down[first]
        i = j
    return mix(out ^ (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: none) one after another, and the offsets of the texts."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    bounds = np.zeros(1, kind)
    if len(column):
        bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    text = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return text[int(bounds[0]) : int(bounds[-1])], (bounds - bounds[0]).astype(np.int64)


def spans(bounds: np.ndarray, limit: int = 4 * PIECE, most: int = 4096) -> Iterator[tuple[int, int]]:
    """Ranges of up to ``most`` texts of up to ``limit`` bytes together; a longer text is a range of its own."""
    i = 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1)
        j = min(j, i + most)
        yield i, j
        i = j


def words(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run of bytes that are ``inside``."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    mask = inside[data]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first[edges] = mask[edges]
    last[edges - 1] = mask[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(bounds, start, "right") - 1


def runs(values: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every ``k`` consecutive values of one owner, and where it starts."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    up, _ = powers(BASES[1], k)
    total = np.zeros(n, U64)
    for t in range(k):
        total += values[t : t + n] * up[t + 1]
    at = np.flatnonzero(owner[:n] == owner[k - 1 :])
    return mix(total[at]), at


def shingles(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each text's shingles of ``k`` words, in order.

    Words are separated by white space, with A to Z in lower case. A text of fewer words has its
    whole sequence as one shingle; a text without words has none.
    """
    data = LOWER[data]
    start, end, owner = words(data, bounds, ~SPACE)
    value = stretches(data, start, end)
    out, at = runs(value, owner, k)
    counts = np.bincount(owner, minlength=len(bounds) - 1)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if not len(short):
        return out, owner[at]
    firsts = np.searchsorted(owner, short)
    whole = np.zeros(len(short), U64)
    up, _ = powers(BASES[1], k)
    for t in range(k - 1):
        has = counts[short] > t
        whole[has] += value[firsts[has] + t] * up[t + 1]
    whole = mix(whole ^ counts[short].astype(U64) << U64(56))
    values, owners = np.concatenate([out, whole]), np.concatenate([owner[at], short])
    order = np.argsort(owners, kind="stable")
    return values[order], owners[order]
