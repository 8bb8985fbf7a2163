"""Static binary fuse filters (three hashes, 16-bit fingerprints) as vector operations.

Built once for a fixed set of 64-bit keys and never changed. A key of the set is always
found; another key is found by mistake about once in 65,536 times.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

_ROUNDS = 100


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer over keys moved by the seed."""
    h = keys + np.uint64(seed)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


@dataclass(frozen=True)
class FuseFilter:
    seed: int
    segment: int  # length of a segment, a power of two
    cells: np.ndarray  # uint16

    @staticmethod
    def shape(n: int) -> tuple[int, int]:
        """Segment length and number of cells for n keys."""
        segment = 4 if n <= 1 else 1 << min(18, max(2, int(math.log(n) / math.log(3.33) + 2.25)))
        factor = 2.0 if n <= 1 else max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(n))
        segments = max(1, math.ceil(n * factor / segment) - 2)
        return segment, (segments + 2) * segment

    @staticmethod
    def _positions(h: np.ndarray, segment: int, size: int) -> np.ndarray:
        """Three cells for each key, in three neighbouring segments."""
        first = size // segment - 2
        at = ((h >> np.uint64(32)) * np.uint64(first) >> np.uint64(32)).astype(np.int64) * segment
        low = np.uint64(segment - 1)
        inner = [(h >> np.uint64(s)) & low for s in (0, 18)]
        inner.append((h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) & low)
        return np.stack([at + i * segment + x.astype(np.int64) for i, x in enumerate(inner)], 1)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Peels keys that own a cell, all of a round at once, then fills cells backwards."""
        keys = np.unique(keys.astype(np.uint64))
        segment, size = cls.shape(len(keys))
        for seed in range(1, _ROUNDS):
            h = _mixed(keys, seed * 0x9E3779B9)
            where = cls._positions(h, segment, size)
            left = np.arange(len(keys))
            order = []
            while len(left):
                cells = where[left]
                degree = np.bincount(cells.ravel(), minlength=size)
                single = degree[cells] == 1
                peeled = single.any(1)
                if not peeled.any():
                    break
                order.append((left[peeled], single[peeled].argmax(1)))
                left = left[~peeled]
            if len(left):
                continue
            out = np.zeros(size, np.uint16)
            marks = cls._marks(h)
            for rows, own in reversed(order):
                cells = where[rows]
                out[cells[np.arange(len(rows)), own]] = 0
                held = out[cells]
                held[np.arange(len(rows)), own] = 0
                out[cells[np.arange(len(rows)), own]] = marks[rows] ^ np.bitwise_xor.reduce(held, axis=1)
            return cls(seed * 0x9E3779B9, segment, out)
        raise RuntimeError(f"no filter for {len(keys)} keys")

    @staticmethod
    def _marks(h: np.ndarray) -> np.ndarray:
        return (h ^ h >> np.uint64(16) ^ h >> np.uint64(48)).astype(np.uint16)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        h = _mixed(keys.astype(np.uint64), self.seed)
        found = np.bitwise_xor.reduce(self.cells[self._positions(h, self.segment, len(self.cells))], axis=1)
        return found == self._marks(h)
