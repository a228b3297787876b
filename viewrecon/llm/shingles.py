"""Sets of five-word shingles, hashed to 64 bits, from whole texts, without a loop over words.

A-Z count as lower case; words are matches of ``[^\\x20\\x09-\\x0D]+``. A text of one to four words is one
shingle, the whole sequence; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
#: Bytes of text that are hashed at once; a longer text is a block of its own.
BLOCK = 1 << 20

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _U(0xD6E8FEB86659FD93)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, _INVERSE):
            p = np.full(max(n, BLOCK), _U(base))
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        _powers = tuple(made)
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their offsets; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data, offsets


def _block(data: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """data: bytes of some texts; starts: their offsets and the end."""
    n = len(data)
    if not n:
        yield from (np.empty(0, np.uint64) for _ in starts[1:])
        return
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = starts[(starts > 0) & (starts < n)]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    up, down = _powers_to(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    words = _mix((sums[end + 1] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    at = np.searchsorted(begin, starts)
    k = len(words) - WIDTH + 1
    if k > 0:
        rolled = words[:k].copy()
        for i in range(1, WIDTH):
            rolled = rolled * _STEP + words[i : i + k]
        rolled = _mix(rolled)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= WIDTH:
            yield np.unique(rolled[a : b - WIDTH + 1])
        elif b > a:
            whole = _U(int(b - a))
            for w in words[a:b]:
                whole = whole * _STEP + w
            yield _mix(np.array([whole + _U(0x5851F42D4C957F2D)]))
        else:
            yield np.empty(0, np.uint64)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes in order."""
    data, offsets = text_bytes(column)
    with np.errstate(over="ignore"):
        i, n = 0, len(offsets) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1)
            j = min(j, n)
            yield from _block(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            i = j
