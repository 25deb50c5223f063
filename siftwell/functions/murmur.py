"""MurmurHash3 (x86, 32 bits) over bytes, for signatures with seeds 0 to n - 1."""

from __future__ import annotations

import numpy as np

# Multipliers, addend and shifts of the published algorithm.
C1, C2, ADD, F1, F2 = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return x << np.uint32(n) | x >> np.uint32(32 - n)


def _scramble(k: np.ndarray) -> np.ndarray:
    return _turn(k * np.uint32(C1), 15) * np.uint32(C2)


def murmur3_all(data: list[bytes], seeds: np.ndarray) -> np.ndarray:
    """Unsigned hashes, a row for each of ``data`` and a column for each seed."""
    sizes = np.array([len(d) for d in data])
    words = int(sizes.max()) // 4 + 1
    blocks = np.frombuffer(b"".join(d.ljust(4 * words, b"\0") for d in data), dtype="<u4").reshape(len(data), words)
    h = np.repeat(seeds.astype(np.uint32)[None], len(data), 0)
    for b in range(words):
        k = _scramble(blocks[:, b].astype(np.uint32))[:, None]
        whole, tail = sizes >= 4 * (b + 1), (sizes > 4 * b) & (sizes < 4 * (b + 1))
        h[whole] = _turn(h[whole] ^ k[whole], 13) * np.uint32(5) + np.uint32(ADD)
        h[tail] ^= k[tail]
    h ^= sizes[:, None].astype(np.uint32)
    h = (h ^ h >> np.uint32(16)) * np.uint32(F1)
    h = (h ^ h >> np.uint32(13)) * np.uint32(F2)
    return h ^ h >> np.uint32(16)


def murmur3(data: bytes, seed: int = 0) -> int:
    """Unsigned 32-bit hash."""
    return int(murmur3_all([data], np.array([seed & 0xFFFFFFFF]))[0, 0])


def signature(grams, num_hashes: int) -> list[int]:
    """Smallest hash of any shingle for each seed."""
    if not grams:
        raise ValueError("no shingles")
    data, best = [g.encode() for g in grams], np.full(num_hashes, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(data), 4096):
        best = np.minimum(best, murmur3_all(data[at : at + 4096], np.arange(num_hashes)).min(0))
    return best.astype(np.int64).tolist()
