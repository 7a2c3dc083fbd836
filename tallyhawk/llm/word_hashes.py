"""Hashes of words and of word sequences, for whole batches of texts at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: Odd multipliers of the polynomials over bytes and over words.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
MASK = (1 << 64) - 1

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: A random number for each byte.
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a base, and of its inverse, modulo 2 ** 64."""
    inverse = pow(base, -1, 1 << 64)
    rows = []
    for x in (base, inverse):
        row = np.full(size, x, np.uint64)
        row[0] = 1
        rows.append(np.multiply.accumulate(row))
    return rows[0], rows[1]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 16, 1 << (n - 1).bit_length()) if n else 1
    up, down = _powers(base, size)
    return up[:n], down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """The words of a batch of texts: their hashes, and where each text's words begin."""

    hashes: np.ndarray
    #: One more than there are texts; the last is the number of words.
    offsets: np.ndarray
    prefix: np.ndarray
    inverse: np.ndarray

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the word sequences [start, end): equal for equal sequences, wherever they stand."""
        raw = (self.prefix[ends] - self.prefix[starts]) * self.inverse[starts]
        return mixed(raw + (ends - starts).astype(np.uint64))


def hash_words(texts: list[bytes]) -> Words:
    """Words are what bytes.split() gives: parted by blank and 09-0D."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[data]
    before = np.append(True, space[:-1])
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)
    up, down = powers(BYTE_BASE, len(data))
    prefix = np.append(np.uint64(0), np.cumsum(_BYTES[data] * up, dtype=np.uint64))
    hashes = mixed((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    text_starts = np.cumsum([0, *(len(x) + 1 for x in texts)])
    offsets = np.searchsorted(starts, text_starts)
    word_up, word_down = powers(WORD_BASE, len(hashes) + 1)
    word_prefix = np.append(np.uint64(0), np.cumsum(hashes * word_up[:-1], dtype=np.uint64))
    return Words(hashes, offsets, word_prefix, word_down)
