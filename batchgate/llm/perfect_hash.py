"""Minimal perfect hashes of 64-bit keys with stored fingerprints.

Level after level, keys hash into twice as many positions as there are keys
left; a key alone at its position is settled there. A key's slot is the number
of settled positions before its own, so n keys take the slots 0..n-1. Any other
key also gets a slot or none; the fingerprint kept there tells it apart.
"""

from __future__ import annotations

import numpy as np

from batchgate.llm.common import mix

SPREAD = 2
LEVELS = 40
_STEP = 0xD6E8FEB86659FD93


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(keys ^ np.uint64((level + 1) * _STEP % (1 << 64)))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 1000) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes = sizes.astype("<i8")  # positions of each level, multiples of 8
        self.bits = bits  # one byte for 8 positions, all levels end to end
        ones = np.unpackbits(bits).reshape(-1, 8).sum(1) if len(bits) else np.zeros(0, np.int64)
        self.before = np.r_[0, np.cumsum(ones)]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys."""
        left, sizes, parts = keys.astype(np.uint64), [], []
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("keys are not distinct")
            size = -(-SPREAD * len(left) // 8) * 8
            at = (_hash(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            settled = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(settled))
            left = left[~settled[at]]
        return cls(np.array(sizes, np.int64), np.concatenate([np.zeros(0, np.uint8), *parts]))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot for each key, -1 where no level has one."""
        keys = keys.astype(np.uint64)
        found = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = base + (_hash(keys[left], level) % np.uint64(size)).astype(np.int64)
            byte, bit = at >> 3, at & 7
            here = self.bits[byte]
            hit = (here >> (7 - bit)) & 1 == 1
            ahead = np.unpackbits((here[hit] & ~(0xFF >> bit[hit]).astype(np.uint8))[:, None], axis=1).sum(1)
            found[left[hit]] = self.before[byte[hit]] + ahead
            left, base = left[~hit], base + size
        return found
