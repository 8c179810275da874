"""Code points of whole batches of texts, and their classes, as numpy arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and its lower-case code point (itself where that isn't one)."""
    points = [chr(i) for i in range(0x110000)]
    letter = np.array([c.isalpha() for c in points])
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(letter):
        small = points[i].lower()
        if len(small) == 1:
            lower[i] = ord(small)
    return letter, lower


def code_points(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts back to back, and n + 1 offsets into them. raw, at: as from common.bytes_of()."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return points, heads[at]


def runs(at: np.ndarray, most_texts: int, most_points: int):
    """(first, last + 1) of runs of texts with at most so many texts and points, or else one text."""
    k, n = 0, len(at) - 1
    while k < n:
        m = min(n, k + most_texts, max(k + 1, int(np.searchsorted(at, at[k] + most_points, side="right")) - 1))
        yield k, m
        k = m
