"""Words and word shingles of whole texts as sorted hash sets, computed on byte arrays."""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.default_rng(11).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """At least ``n`` powers of the base, modulo 2**64; kept for the longest word so far."""
    global _powers
    with np.errstate(over="ignore"):
        while len(_powers) < n:
            _powers = np.concatenate((_powers, _powers * (_powers[-1] * _BASE)))
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each word ``[^\\x20\\x09-\\x0D]+``, letters A-Z in lower case."""
    raw = np.frombuffer(data, np.uint8)
    kept = np.flatnonzero(~_SPACE[raw])
    if not len(kept):
        return np.zeros(0, np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], kept[1:] != kept[:-1] + 1)))
    sizes = np.diff(np.concatenate((starts, [len(kept)])))
    within = np.arange(len(kept)) - np.repeat(starts, sizes)
    with np.errstate(over="ignore"):
        terms = _BYTES[_LOWER[raw[kept]]] * _power(int(sizes.max()) + 1)[within]
        return _mix(np.add.reduceat(terms, starts) + sizes.astype(np.uint64))


def shingle_set(data: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; of the whole sequence if it is shorter."""
    hashes = word_hashes(data)
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    with np.errstate(over="ignore"):
        out = np.full(len(hashes) - size + 1, size, np.uint64)
        for k in range(size):
            out = _mix(out * _BASE + hashes[k:k + len(out)])
    return np.unique(out)
