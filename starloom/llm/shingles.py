"""Word shingles of whole texts as sorted 64-bit hashes, and minimum hashes over them; numpy over whole texts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


_BYTE = numbers(256, 11)
_STEP = int(numbers(1, 12)[0]) | 1
_BACK = pow(_STEP, -1, 1 << 64)
_POWERS = [np.ones(1, dtype=_U), np.ones(1, dtype=_U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_STEP, _BACK)):
            steps = np.full(max(n, 1 << 17), base, dtype=_U)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def word_hashes(text: str | None) -> np.ndarray:
    """A hash for each word of the text in order: A-Z lower-cased, split at ASCII white space."""
    low = _LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    edge = np.diff(_SPACE[low].astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, dtype=_U)
    power, back = _powers(len(low) + 1)
    sums = np.zeros(len(low) + 1, dtype=_U)
    np.cumsum(_BYTE[low] * power[:len(low)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(_U))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of ``width`` words; of all words together if there are fewer."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = min(width, len(words))
    place = numbers(width, 13) | _U(1)
    runs = np.full(len(words) - n + 1, n, dtype=_U)
    for i in range(n):
        runs = mix(runs + words[i:len(words) - n + 1 + i] * place[i])
    return np.unique(runs)


def set_digest(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set of hashes."""
    a, b = numbers(2, 14)
    return np.array([np.add.reduce(mix(hashes + a)), np.add.reduce(mix(hashes ^ b)) + _U(len(hashes))], dtype=_U).tobytes()


def minimum_hashes(sets: Sequence[np.ndarray], k: int, seed: int) -> np.ndarray:
    """``k`` minimum hashes for each of the non-empty sets, as an array of len(sets) x k."""
    out = np.empty((len(sets), k), dtype=_U)
    xor, times = numbers(k, seed), numbers(k, seed + 1) | _U(1)
    at = 0
    while at < len(sets):  # so many sets at a time that their hashes stay in the processor's cache
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 1 << 15):
            size += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        begins = np.cumsum([0] + [len(s) for s in sets[at:end - 1]])
        for i in range(k):
            out[at:end, i] = np.minimum.reduceat((flat ^ xor[i]) * times[i], begins)
        at = end
    return mix(out)
