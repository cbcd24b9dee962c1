"""Words of a text as bytes, and 64-bit hashes of words and word runs."""

from __future__ import annotations

import numpy as np
import xxhash

_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
#: A-Z become a-z, whatever else is ASCII and neither digit nor letter becomes a blank.
_TO_WORDS = bytes(b if b in _WORD_BYTES else 32 for b in bytes(range(256)).lower())

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Entries a cache may hold before it starts afresh; a cache changes speed, never a result.
CACHE_ENTRIES = 500_000
#: Longer words are not remembered, so that entries bound bytes, too.
CACHE_BYTES = 64


def plain_words(text: bytes) -> list[bytes]:
    """Runs of digits, lower-cased ASCII letters and non-ASCII characters."""
    return text.translate(_TO_WORDS).split()


class WordHashes(dict):
    """XXH64 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the SplitMix64 finaliser)."""
    values = (values ^ (values >> np.uint64(30))) * _MIX1
    values = (values ^ (values >> np.uint64(27))) * _MIX2
    return values ^ (values >> np.uint64(31))


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words, given the words' hashes."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    value = np.full(count, width, np.uint64)
    for place in range(width):
        value = value * _FACTOR + words[place : place + count]
    return mixed(value)
