"""Word-shingle sets of texts as sorted 64-bit hashes, computed for many texts at once.

Words are runs of bytes other than the blanks, A-Z lower-cased. A shingle is
``size`` consecutive words; a text of fewer words has its whole sequence as its only
shingle, a text without words has none. Hashes depend on the words alone: two texts
share a hash if they share the shingle (unequal shingles of one pair of texts collide
with a chance below n^2 / 2^64).
"""

from __future__ import annotations

import string

import numpy as np

from marquee.llm.common import BLANKS

_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_RNG = np.random.default_rng(991)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS.encode())] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Holds the powers of the polynomial hash for the longest block seen."""

    def __init__(self, size: int = 5):
        self.size = size
        self.power = self.inverse = np.ones(1, np.uint64)
        self.turn = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            for name, base in (("power", _BASE), ("inverse", inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def _words(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word of a byte array."""
        self._grow(len(raw) + 1)
        word = np.concatenate(([False], ~_BLANK[raw], [False]))
        edge = np.flatnonzero(word[1:] != word[:-1])
        start, end = edge[0::2], edge[1::2]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * self.power[:len(raw)])))
        return start, mix((total[end] - total[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        raws = [(t or "").encode("utf-8", "replace").translate(_LOWER) for t in texts]
        offset = np.cumsum([0, *(len(r) + 1 for r in raws)])
        start, word = self._words(np.frombuffer(b" ".join(raws), np.uint8))
        cut = np.searchsorted(start, offset)                    # first word of each text
        count = np.diff(cut)
        n, k = len(word), self.size
        windows = np.zeros(max(0, n - k + 1), np.uint64)
        for i in range(k):
            windows += mix(word[i:n - k + 1 + i] * self.turn[i]) if n >= k else windows
        windows = mix(windows + np.uint64(k))
        out = []
        for a, c in zip(cut.tolist(), count.tolist()):
            if c >= k:
                out.append(np.unique(windows[a:a + c - k + 1]))
            elif c:
                own = word[a:a + c]
                whole = sum(int(mix(own[i:i + 1] * self.turn[i])[0]) for i in range(c)) + c
                out.append(mix(np.array([whole & (2**64 - 1)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out
