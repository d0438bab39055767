"""Word shingles of whole texts as 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np
from xxhash import xxh3_64_intdigest

SIZE = 5
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_SHIFT = np.uint64(33)


def mixed(x: np.ndarray) -> np.ndarray:
    for factor in _MIX:
        x = (x ^ (x >> _SHIFT)) * factor
    return x ^ (x >> _SHIFT)


# odd multipliers, one for each place in a shingle; they are unrelated, so words that change places change the sum
_PLACES = mixed(np.arange(1, SIZE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words between ASCII white space, A-Z in lower case."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_set(text: str, size: int = SIZE) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of a shorter text, the whole sequence is the only one."""
    words = word_hashes(text)
    if not len(words):
        return words
    run = min(size, len(words))
    total = np.full(len(words) - run + 1, run, dtype=np.uint64)
    for i in range(run):
        total += words[i:len(words) - run + 1 + i] * _PLACES[i]
    total = np.sort(mixed(total))
    new = np.ones(len(total), dtype=bool)
    np.not_equal(total[1:], total[:-1], out=new[1:])
    return total[new]


def set_key(hashes: np.ndarray) -> int | None:
    """A signed 64-bit key of the whole set; None of the empty one."""
    if not len(hashes):
        return None
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "big", signed=True)
