"""Rolling hashes of byte strings in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow(size: int) -> None:
    if len(_powers[0]) < size:
        size = max(size, 1 << 17)
        for place, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[place] = np.multiply.accumulate(steps)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefixes(data: bytes) -> np.ndarray:
    """Sums that give the hash of any substring, see ``spans``."""
    return sums_of(_BYTES[np.frombuffer(data, np.uint8)])


def sums_of(values: np.ndarray) -> np.ndarray:
    """As ``prefixes``, of any sequence of 64-bit numbers."""
    n = len(values)
    _grow(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers[0][:n], out=sums[1:])
    return sums


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal strings wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _powers[1][starts] + (ends - starts).astype(np.uint64))


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text whose words are joined by one space."""
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(data)]))


def raw_word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of any text: runs of anything but the ASCII blanks."""
    byte = np.frombuffer(data, np.uint8)
    word = ((byte != 32) & ((byte < 9) | (byte > 13))).view(np.int8)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], word, [0]))))
    return edge[::2], edge[1::2]


def word_sums(data: bytes) -> np.ndarray:
    """Sums over the words of a text: ``spans`` of them hashes runs of words."""
    return sums_of(spans(prefixes(data), *raw_word_bounds(data)))


def reversed_word_sums(data: bytes) -> np.ndarray:
    """``word_sums`` of the bytes reversed: another function of the same words."""
    return word_sums(data[::-1])


def minima(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values the place of its smallest, the leftmost of equals."""
    n = len(values) - width + 1
    best, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        reach += step
    return best[:n]
