"""Word shingles as 64-bit integers and universal hash minima, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from plumbline.llm.common import worker_state

class WordHashes(dict):
    """Hashes of the first words a worker meets, about 130 bytes each; others are hashed each time."""

    MOST = 150_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < self.MOST and len(word) <= 64:
            self[word] = value
        return value


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """One hash per window of ``width`` words, in order; the whole text if it has fewer.

    Word hashes are combined as a polynomial over the integers modulo 2^64 and mixed.
    """
    n = len(words)
    if n == 0:
        return np.empty(0, "u8")
    h = np.fromiter(map(worker_state("word hashes", WordHashes).__getitem__, words), "u8", n)
    k = min(width, n)
    out = h[: n - k + 1].copy()
    with np.errstate(over="ignore"):
        for i in range(1, k):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += h[i : n - k + 1 + i]
        out += np.uint64(k)
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def folded_words(text: str) -> list[bytes]:
    """Words between ASCII spaces, with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def universal_hashes(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``n`` hash functions modulo 2^64."""
    rng = np.random.Generator(np.random.PCG64(seed))
    a = rng.integers(0, 2**64, n, dtype="u8") | np.uint64(1)
    return a, rng.integers(0, 2**64, n, dtype="u8")


def minima(values: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of each hash over each run ``bounds[i]..bounds[i+1]``, none empty: runs by hashes."""
    out = np.empty((len(bounds) - 1, len(a)), "u8")
    starts = bounds[:-1]
    buffer = np.empty(len(values), "u8")
    with np.errstate(over="ignore"):
        for j in range(len(a)):
            np.multiply(values, a[j], out=buffer)
            np.add(buffer, b[j], out=buffer)
            out[:, j] = np.minimum.reduceat(buffer, starts)
    return out
