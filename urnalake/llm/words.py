"""Words and their hashes, for tasks: whole arrays at a time."""

from __future__ import annotations

import numpy as np
import xxhash

BASE = np.uint64(0x9E3779B97F4A7C15)
OTHER_BASE = np.uint64(0xD1B54A32D192ED03)


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of bytes other than space and the five ASCII space controls, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (a bijection)."""
    out = values ^ (values >> np.uint64(31))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(32)
    return out


def _power(base: np.uint64, exponent: int) -> np.uint64:
    return np.uint64(pow(int(base), exponent, 1 << 64))


def extend(left: np.ndarray, right: np.ndarray, shift: int, base: np.uint64 = BASE) -> np.ndarray:
    """Hashes of windows made of a left part and, ``shift`` words on, a right part of that length.

    Windows of twice a length come from two windows of that length: ``extend(w, w, n)``.
    """
    count = max(0, min(len(left), len(right) - shift))
    return left[:count] * _power(base, shift) + right[shift : shift + count]


def window_hashes(hashes: np.ndarray, size: int, base: np.uint64 = BASE) -> np.ndarray:
    """One polynomial hash per window of ``size`` consecutive words, by doubling."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    done, length = None, 0
    block, block_size, rest = hashes, 1, size
    while rest:
        if rest & 1:
            if done is None:
                done, length = block, block_size
            else:
                count = min(len(done), len(block) - length)
                done = done[:count] * _power(base, block_size) + block[length : length + count]
                length += block_size
        rest >>= 1
        if rest:
            block, block_size = extend(block, block, block_size, base), block_size * 2
    return done[: len(hashes) - size + 1]


def sliding(values: np.ndarray, width: int, smaller) -> np.ndarray:
    """Running minimum or maximum (``np.minimum``/``np.maximum``) over ``width`` values."""
    reach = 1
    while reach * 2 <= width:
        values = smaller(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return smaller(values[: len(values) - rest], values[rest:]) if rest else values
