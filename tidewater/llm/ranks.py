"""Prefix-doubling ranks of byte strings, and the positions that stand for a stretch of windows."""

from __future__ import annotations

import numpy as np

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
GRAM = 32
_PLACE_BITS = np.uint64(24)
#: Bytes ranked at once; a longer text is taken in pieces that overlap by a window.
PIECE = 1 << 22


def pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rank of the string that has rank x first and rank y at an offset: a 64-bit value of the pair."""
    z = x * _A
    z ^= z >> np.uint64(32)
    z += y
    z *= _B
    z ^= z >> np.uint64(29)
    return z


def doubled(data: np.ndarray, upto: list[int]) -> list[np.ndarray]:
    """Ranks of the strings of each length in ``upto`` (ascending) that start at each position of ``data`` (uint8).

    Ranks of length 1, 2, 4, ... come from pairs of ranks at growing offsets; a length that
    is no power of two overlaps two ranks of the power below it.
    """
    rank, k, out = (data.astype(np.uint64) + np.uint64(1)) * _C, 1, []
    for length in upto:
        while 2 * k <= length and len(rank) > k:
            rank, k = pair(rank[:-k], rank[k:]), 2 * k
        off = length - k
        out.append(rank if not off else pair(rank[:-off], rank[off:]) if len(rank) > off else rank[:0])
    return out


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    k = 1
    while 2 * k <= width:
        keys, k = np.minimum(keys[:-k], keys[k:]), 2 * k
    off = width - k
    return np.minimum(keys[:-off], keys[off:]) if off else keys


def anchors(gram: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last): the windows of ``width`` grams from ``first`` to ``last`` have their least gram at ``place``.

    Which one is least depends on the window's own bytes only, so equal windows have theirs
    at the same offset, wherever they stand.
    """
    key = gram * _A
    key ^= key >> np.uint64(31)
    place = np.arange(len(gram), dtype=np.uint64)
    low = window_minima((key >> _PLACE_BITS << _PLACE_BITS) | place, width)
    at = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    turn = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate(([0], turn))
    return at[first], first, np.concatenate((turn, [len(at)])) - 1
