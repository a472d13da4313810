"""Words, lines and windows of many documents at once, as numpy passes over their UTF-8 bytes.

White space is ASCII (0x20, 0x09-0x0D), so byte boundaries are code-point boundaries.
"""

from __future__ import annotations

import numpy as np

#: Hashes of spans are two polynomials modulo 2^31 - 1 with bases drawn once: different spans of n bytes agree with a
#: chance of (n / 2^31)^2, whatever their bytes (modulo a power of two some regular texts always agree).
_PRIME, _FOLD = np.uint64((1 << 31) - 1), np.uint64(31)
_DRAWN = np.random.default_rng(20240607)
_CODE = _DRAWN.integers(1, (1 << 31) - 1, 256, dtype=np.uint64)
_BASES = tuple(int(x) for x in _DRAWN.integers(1 << 20, (1 << 31) - 1, 2))
#: For rolling hashes, which only choose places.
_ROLL = np.uint64(0x9E3779B97F4A7C15)
_BYTE = (_DRAWN.integers(1, 1 << 63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _fold(x: np.ndarray) -> np.ndarray:
    """A number congruent modulo 2^31 - 1, below 2^32 where x is below 2^62."""
    return (x & _PRIME) + (x >> _FOLD)


#: Powers of each base so far, extended as texts need them.
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    """base^0 .. base^(size - 1) modulo 2^31 - 1."""
    out = _POWERS.get(base)
    if out is None or len(out) < size:
        out, n = np.ones(size + (size >> 3), np.uint32), 1
        while n < len(out):
            step = np.uint64(pow(base, n, int(_PRIME)))
            out[n : 2 * n] = _fold(_fold(out[: min(n, len(out) - n)] * step))
            n *= 2
        _POWERS[base] = out
    return out[:size]


def _tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse, up to n."""
    return [(_powers(x, n + 1), _powers(pow(x, -1, int(_PRIME)), n + 1)) for x in _BASES]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Two rows P with P[i] congruent to the sum of code(data[j]) * base^j for j < i."""
    out = np.zeros((2, len(data) + 1), np.uint64)
    code = _CODE[data]
    for row, (up, _) in zip(out, _tables(len(data)), strict=True):
        np.cumsum(_fold(code * up[:-1]), out=row[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Content hashes of data[start:end], with the length mixed in."""
    got = []
    for row, (_, down) in zip(prefix, _tables(prefix.shape[1] - 1), strict=True):
        x = _fold(_fold(_fold(_fold(row[end] - row[start])) * down[start]))
        x = _fold(x)
        got.append(np.where(x >= _PRIME, x - _PRIME, x))
    return mix((got[0] << np.uint64(32) | got[1]) + (end - start).astype(np.uint64) * _ROLL)


def rolled(values: np.ndarray, width: int, base: int = int(_ROLL)) -> np.ndarray:
    """For every ``width`` values in a row, the polynomial of them modulo 2^64."""
    part, size, out, done = values, 1, np.zeros(len(values), np.uint64), 0
    while width:
        if width & 1:  # out covers ``done`` values, part the next ``size``
            n = len(values) - done - size + 1
            out = out[:n] * np.uint64(pow(base, size, 1 << 64)) + part[done : done + n]
            done += size
        width >>= 1
        if width:
            part = part[:-size] * np.uint64(pow(base, size, 1 << 64)) + part[size:]
            size *= 2
    return out


def rolling_hash(data: np.ndarray, width: int) -> np.ndarray:
    """A cheap hash of every ``width`` bytes, finalised."""
    return mix(rolled(_BYTE[data], width))


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each word's document. Words never cross documents."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.concatenate(([False], inside))  # before[i]: byte i-1 is in a word
    after = np.concatenate((inside, [False]))
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def per_doc(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one per byte or item) between consecutive offsets; empty ranges give 0."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[off[1:]] - total[off[:-1]]


def repeated(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks over items: its (document, hash) occurs twice or more; it is not the first of its kind."""
    order = np.lexsort((h, doc))  # stable: equal items stay in text order
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    many, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order] = same
    many[order] = same | np.append(same[1:], False)
    return many, later
