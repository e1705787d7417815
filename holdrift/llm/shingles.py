"""Sets of word shingles as sorted arrays of 64-bit hashes, for use inside tasks."""

import hashlib

import numpy as np
import xxhash

_CACHED_WORDS = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hashes of words; a cache of bounded size."""

    def __missing__(self, word):
        if len(self) >= _CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def word_hashes(text, cache: WordHashes) -> np.ndarray:
    """Hashes of the words (runs other than space and 0x09-0x0D), A-Z lower-cased."""
    found = text.encode().lower().split() if text else []
    return np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))


def shingle_set(hashes: np.ndarray, length: int) -> np.ndarray:
    """The sorted distinct shingles of ``length`` words; fewer words are one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, length)
    found = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        found *= _ODD
        found += hashes[k:n - width + 1 + k]
        found ^= found >> np.uint64(30)
        found *= _MIX
        found ^= found >> np.uint64(31)
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])]


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash for each pair of hashes, in order."""
    found = np.full(len(first), 2, np.uint64)
    for part in (first, second):
        found *= _ODD
        found += part
        found ^= found >> np.uint64(30)
        found *= _MIX
        found ^= found >> np.uint64(31)
    return found


def digest(tokens: np.ndarray) -> bytes:
    """Sixteen bytes that stand for the whole set."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
