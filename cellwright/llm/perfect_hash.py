"""A minimal perfect hash over pairs of 64-bit hashes, by levels of bits: at each level the keys that
fall alone on a bit take it, the others go on to the next. A key's number is the rank of its bit."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .tokens import mix

#: Bits of a level for each key that reaches it. Half of the keys and more stay at each level.
_SPREAD = 1.5


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(h1 ^ mix(h2 + np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """sizes: bits of each level; bits: those of all levels, one after the other."""

    sizes: list[int]
    bits: np.ndarray

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        """Of keys whose pairs of hashes differ."""
        sizes, levels = [], []
        while len(h1):
            if len(sizes) == 128:
                raise ValueError("two keys have the same hashes")
            size = 8 * -(-int(_SPREAD * len(h1) + 8) // 8)
            at = _place(h1, h2, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            sizes.append(size)
            on = ~alone[at]
            h1, h2 = h1[on], h2[on]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    @classmethod
    def load(cls, sizes: list[int], packed: bytes) -> PerfectHash:
        return cls(list(sizes), np.unpackbits(np.frombuffer(packed, np.uint8), count=sum(sizes)).astype(bool))

    def packed(self) -> bytes:
        return np.packbits(self.bits).tobytes()

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The number of each key, from 0 on without a gap. A key that was not there at the building gets
        -1 or the number of another, which its fingerprint tells."""
        rank = np.cumsum(self.bits) - 1
        out, left, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = base + _place(h1[left], h2[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = rank[at[hit]]
            left, base = left[~hit], base + size
        return out
