"""Words and word shingles of whole texts as hashes, in numpy."""

from __future__ import annotations

import numpy as np

WORDS_HELD = 1 << 17
_M = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of a text with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class Numbers(dict):
    """Numbers things as they are first asked for; `fresh` holds those not yet taken care of."""

    def __init__(self):
        self.fresh: list = []

    def __missing__(self, key):
        self.fresh.append(key)
        self[key] = number = len(self)
        return number

    def of(self, things: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, things), np.int64, len(things))


class WordHashes:
    """64-bit hashes of words; a word is hashed when first met, and the lookup emptied when it reaches a fixed size."""

    def __init__(self, held: int = WORDS_HELD):
        self.held = held
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.hashes = Numbers(), np.zeros(1024, dtype=np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        if len(self.numbers) > self.held:
            self._forget()
        at = self.numbers.of(words)
        if fresh := self.numbers.fresh:
            end = len(self.numbers)
            if end > len(self.hashes):
                self.hashes = np.concatenate((self.hashes, np.zeros(end, dtype=np.uint64)))
            self.hashes[end - len(fresh):end] = np.fromiter(map(xxhash.xxh3_64_intdigest, fresh), np.uint64, len(fresh))
            fresh.clear()
        return self.hashes[at]


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of the whole sequence if it is shorter; empty without words."""
    if not len(hashes):
        return hashes
    width = min(k, len(hashes))
    n = len(hashes) - width + 1
    mixed = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        mixed = (mixed + hashes[i:i + n]) * _M
        mixed ^= mixed >> np.uint64(29)
    mixed.sort()
    return mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))]
