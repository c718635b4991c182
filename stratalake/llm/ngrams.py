"""Hashed n-grams of whole texts, computed on arrays of bytes; used inside Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes hashed at once; longer texts go in blocks that end between words.
BLOCK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread hashes over all 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes:
    """Hashes of the words of a text (split at ASCII white space), block by block."""

    def __init__(self) -> None:
        self.powers = np.zeros(0, np.uint64)
        self.inverses = np.zeros(0, np.uint64)

    def _reach(self, n: int) -> None:
        if n > len(self.powers):
            size = max(n, 1 << 16)
            self.powers = np.cumprod(np.full(size, _ODD))
            self.inverses = np.cumprod(np.full(size, _INVERSE))

    def of(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``words, tails``: a hash of each word, and one of its last two bytes."""
        at = 0
        while at < len(text):
            end = min(len(text), at + BLOCK)
            while end < len(text) and text[end] not in b" \t\n\v\f\r":
                end = min((p for c in b" \t\n\v\f\r" if (p := text.find(bytes([c]), end)) >= 0), default=len(text))
            yield self._block(np.frombuffer(text, np.uint8, end - at, at))
            at = end

    def _block(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = np.zeros(len(block) + 2, np.int8)
        inside[1:-1] = (block != 32) & ((block < 9) | (block > 13))
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self._reach(len(block) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((block + np.uint64(1)) * self.powers[: len(block)])))
        words = mixed((sums[ends] - sums[starts]) * self.inverses[starts])
        last = block[ends - 1].astype(np.uint64)
        before = np.where(ends - starts > 1, block[ends - 2], 0).astype(np.uint64)
        return words, mixed(last * np.uint64(256) + before + np.uint64(1))
