"""Character q-grams as 64-bit codes, and an inverted index of them that fits in a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20


def points(text: str) -> np.ndarray:
    """The code points of ``text``."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def codes(chars: np.ndarray, q: int) -> np.ndarray:
    """A polynomial hash of each ``q`` consecutive code points, by doubling."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        # have[i]: the hash of `width` characters from i; power: the base to that width.
        power, width, have = _BASE, 1, chars.astype(np.uint64) + np.uint64(1)
        total, done = np.zeros(n, np.uint64), 0
        while True:
            if q & width:
                total = total * power + have[done : done + n]
                done += width
            if done == q:
                return total ^ (total >> np.uint64(29))
            have = have[:-width] * power + have[width:]
            power, width = power * power, width * 2


class Index:
    """Codes of the grams of several patterns, with where each occurs."""

    def __init__(self, found: list[tuple[int, np.ndarray, np.ndarray]]):
        """``found``: (pattern, codes, their positions in it)."""
        code = np.concatenate([c for _, c, _ in found] or [np.zeros(0, np.uint64)])
        order = np.argsort(code, kind="stable")
        self.pattern = np.concatenate([np.full(len(c), i, np.int64) for i, c, _ in found] or [np.zeros(0, np.int64)])[order]
        self.position = np.concatenate([p for _, _, p in found] or [np.zeros(0, np.int64)]).astype(np.int64)[order]
        self.code, first = np.unique(code[order], return_index=True)
        self.first = np.append(first, len(code))
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self._slot(self.code)] = True

    @staticmethod
    def _slot(code: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (code * _BASE) >> np.uint64(64 - _BITS)

    def _found(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``code`` of known codes, the first row of each in the index, and how many rows it has."""
        at = np.flatnonzero(self.seen[self._slot(code)])
        if not len(at) or not len(self.code):
            return (np.zeros(0, np.int64),) * 3
        k = np.minimum(np.searchsorted(self.code, code[at]), len(self.code) - 1)
        same = self.code[k] == code[at]
        at, k = at[same], k[same]
        return at, self.first[k], self.first[k + 1] - self.first[k]

    def slices(self, code: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All (place in ``code``, pattern, position in the pattern) with equal codes, about ``most`` at a time."""
        at, first, n = self._found(code)
        total = np.cumsum(n)
        cuts = np.searchsorted(total, np.arange(most, total[-1] if len(total) else 0, most), "right")
        for i, j in zip([0, *cuts], [*cuts, len(at)]):
            if j > i:
                m = n[i:j]
                rows = np.repeat(first[i:j] - np.concatenate(([0], np.cumsum(m)[:-1])), m) + np.arange(m.sum())
                yield np.repeat(at[i:j], m), self.pattern[rows], self.position[rows]

    def hits(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All of :meth:`slices` at once."""
        parts = list(self.slices(code))
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3

    def bands(self, code: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """:func:`bands` of all hits, of which only a slice is held at a time."""
        have = (np.zeros(0, np.int64),) * 3
        for part in self.slices(code):
            pattern, low, count = (np.concatenate(x) for x in zip(have, bands(*part, widths)))
            order = np.lexsort((low, pattern))
            pattern, low, count = pattern[order], low[order], count[order]
            starts = np.flatnonzero(np.append(True, (np.diff(pattern) != 0) | (np.diff(low) != 0)))
            have = pattern[starts], low[starts], np.add.reduceat(count, starts)
        return have


def bands(at: np.ndarray, pattern: np.ndarray, position: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hits counted in overlapping diagonal bands: (pattern, lowest diagonal, hits).

    A pattern's bands are twice ``widths[pattern]`` wide and begin at every
    multiple of it, so any diagonals that are less than a width apart share one.
    """
    width = widths[pattern]
    band = (at - position) // width
    key = np.concatenate([np.stack([pattern, band]), np.stack([pattern, band - 1])], axis=1)
    if not key.shape[1]:
        return (np.zeros(0, np.int64),) * 3
    span = int(key[1].max() - key[1].min()) + 1
    flat, count = np.unique(key[0] * span + (key[1] - key[1].min()), return_counts=True)
    pattern = flat // span
    return pattern, (flat % span + key[1].min()) * widths[pattern], count
