"""Words of whole texts as the operators define them, split by translating bytes.

Two definitions: ``alnum`` lower-cases A-Z and takes runs of digits, letters and all
code points from U+0080 (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``); ``spaced`` lower-cases
A-Z and takes runs without white space (``[^\\x20\\x09-\\x0D]+``). Both only look at ASCII
bytes, so they work on UTF-8 directly.
"""

from __future__ import annotations

import numpy as np
import xxhash

_LOWER = {b: b + 32 for b in range(ord("A"), ord("Z") + 1)}
_SPACE = ord(" ")


def _table(is_word) -> bytes:
    return bytes(_LOWER.get(b, b) if is_word(b) else _SPACE for b in range(256))


_ALNUM = _table(lambda b: b >= 0x80 or chr(b).isalnum())
_SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


def alnum(text: bytes) -> list[bytes]:
    return text.translate(_ALNUM).split()


def spaced(text: bytes) -> list[bytes]:
    # split(b" ") would keep empty words; bytes.split() also splits at \x0b, which is a space here too
    return text.translate(_SPACED).split()


class Hashes(dict):
    """64-bit hashes of words, remembered for the common ones; of bounded size."""

    def __init__(self, memo: int = 500_000):
        super().__init__()
        self.memo = memo

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.memo:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def scrambled(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with every bit depending on all (splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words; of the whole sequence, if it is shorter."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    mixed = np.full(n, np.uint64(width))
    for i in range(width):
        mixed = scrambled(mixed * _STEP + hashes[i : i + n])
    return mixed
