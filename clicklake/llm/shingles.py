"""Word-shingle sets, their digests and MinHash signatures (helpers of the near-duplicate operator)."""

from __future__ import annotations

import hashlib

import numpy as np
from xxhash import xxh3_64_intdigest

SHINGLE_WORDS = 5
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RADIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``k``-word shingles.

    Words are runs without ``[\\x20\\x09-\\x0D]``, A-Z lower-cased; fewer than ``k`` words are one
    shingle, no words none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    width = min(k, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        out = out * _RADIX + h[j:len(h) - width + 1 + j]
    return np.unique(_mixed(out))


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class MinHash:
    """``size`` minima over seeded linear permutations of 32-bit values, 16 bits kept of each."""

    def __init__(self, size: int, seed: int):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 31, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
        self.b = rng.integers(0, 1 << 32, size, dtype=np.uint64).astype(np.uint32)

    def __call__(self, shingles: np.ndarray, block: int = 2048) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), block):
            np.minimum(least, (x[at:at + block, None] * self.a + self.b).min(0), out=least)
        # Mixed before the cut to 16 bits, as minima of long texts share their high bits.
        least = least ^ (least >> np.uint32(15))
        least = least * np.uint32(0x2C1B3C6D)
        return (least >> np.uint32(16)).astype(np.uint16)


