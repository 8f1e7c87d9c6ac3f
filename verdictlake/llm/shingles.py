"""Word hashes and shingle sets of whole texts, as numpy arrays inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from verdictlake.llm.common import worker_keeps

SHINGLE_WORDS = 5
KEPT_WORDS = 100_000

# Odd multipliers, one per place in a sequence, from a fixed generator.
_PLACES = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES_AGAIN = np.random.default_rng(13).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word."""
    return np.fromiter(map(worker_keeps("words", _Words).__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all its bits."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def sequence_hashes(hashes: np.ndarray, length: int, places: np.ndarray = _PLACES) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` consecutive words."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:count] * places[0]
    for k in range(1, length):
        total += hashes[k:count + k] * places[k]
    return mixed(total)


def second_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Another, independent hash of the same runs."""
    return sequence_hashes(mixed(hashes + np.uint64(1)), length, _PLACES_AGAIN)


def shingle_set(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles: runs of ``words`` words,
    A-Z lower-cased; a shorter text is one shingle, one without words none."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(found)
    runs = sequence_hashes(hashes, words) if len(found) >= words else sequence_hashes(hashes, len(found)) ^ np.uint64(len(found))
    return np.unique(runs)


def digest(values: np.ndarray) -> bytes:
    """128 bits that tell equal sets or sequences from different ones."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
