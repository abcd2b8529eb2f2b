"""Character shingles of normalised texts, computed for whole batches at once.

Normalised: lower case, letters and digits only. A shingle is a substring of five characters; a text's shingles are a set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np

WIDTH = 5
MIN_INSTRUCTION, MIN_LONG = 20, 60
_P = np.uint64(0x9E3779B97F4A7C15)


@cache
def _alnum() -> np.ndarray:
    return np.frombuffer(bytes(chr(i).isalnum() for i in range(0x110000)), dtype=np.bool_)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Normal:
    """The normalised texts of a batch as one array of code points, with each text's start and end. Null counts as empty."""

    def __init__(self, texts: Sequence[str | None]):
        low = [(t or "").lower() for t in texts]
        codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        keep = _alnum()[codes]
        before = np.concatenate([[0], np.cumsum(keep)])
        ends = np.cumsum([len(t) for t in low]) if low else np.zeros(0, dtype=np.int64)
        self.codes = codes[keep]
        self.ends = before[ends].astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64) if len(low) else self.ends
        self.lengths = self.ends - self.starts

    def digest(self, i: int) -> bytes:
        return hashlib.blake2b(self.codes[self.starts[i] : self.ends[i]].tobytes(), digest_size=16).digest()

    def shingles(self, tag: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of all windows, text after text, and how many each text has. Another tag gives other hashes."""
        counts = np.maximum(self.lengths - (WIDTH - 1), 0)
        if not counts.sum():
            return np.zeros(0, dtype=np.uint64), counts
        c = self.codes.astype(np.uint64)
        m = len(c) - WIDTH + 1
        h = c[:m] + np.uint64(tag)
        for k in range(1, WIDTH):
            h = h * _P + c[k : m + k]
        first = np.cumsum(counts) - counts
        at = np.arange(counts.sum()) + np.repeat(self.starts - first, counts)
        return mix(h[at]), counts


def blocks(rows: int, size: int = 256) -> Iterator[tuple[int, int]]:
    for lo in range(0, rows, size):
        yield lo, min(rows, lo + size)


def shingle_set(text: str | None) -> frozenset[str]:
    t = "".join(filter(str.isalnum, (text or "").lower()))
    return frozenset(t[i : i + WIDTH] for i in range(len(t) - WIDTH + 1))


def jaccard(a: frozenset[str], b: frozenset[str]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if both else 0.0
