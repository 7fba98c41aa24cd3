"""Vectorised 64-bit hashes of words and byte windows, the same in every process."""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b

import numpy as np

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers (multiply and shift rounds)."""
    x = x.astype(_U, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> _U(shift)
        x *= _U(factor)
    return x ^ (x >> _U(31))


#: Of each byte value a fixed random number; of the polynomial its odd base and the base's inverse modulo 2**64.
BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
BASE = 0xD6E8FEB86659FD93
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1), kept and grown by doubling."""
    held = _POWERS.get(base, np.ones(1, _U))
    while len(held) < n:
        held = np.concatenate([held, held * _U(pow(base, len(held), 1 << 64))])
    _POWERS[base] = held
    return held[:n]


@lru_cache(maxsize=1)
def _inverse() -> int:
    return pow(BASE, -1, 1 << 64)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums s of value * BASE**position; (s[b] - s[a]) * BASE**-a depends on the bytes a to b alone."""
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(BYTE_VALUES[data] * _powers(BASE, len(data)), out=out[1:])
    return out


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` bytes: equal windows have equal hashes; that different ones have different hashes isn't relied on."""
    if len(data) < size:
        return np.zeros(0, _U)
    sums = prefix_sums(data)
    return mix((sums[size:] - sums[:-size]) * _powers(_inverse(), len(data))[: len(data) - size + 1])


def by_value(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by value; the distinct values; and the bounds of each one's run in the order (one more than values)."""
    order = np.argsort(parts, kind="stable")
    ordered = parts[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))
    return order, ordered[starts], np.append(starts, len(ordered))


IS_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
STEP, ALL_BITS = _U(0x9FB21C651E98DF25), _U(0xFFFFFFFFFFFFFFFF)
#: Bytes of a word up to which it is hashed eight bytes at a time.
LONG = 64


def eights(data: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The eight bytes from every position on as one number; beyond the end are zeros."""
    return np.ndarray(len(data) + 1, kind, np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


def byte_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, long: int = LONG) -> np.ndarray:
    """64-bit hashes of byte ranges: a mixed chain over eight bytes at a time that begins with the length; BLAKE2b for ranges of more than ``long`` bytes."""
    hashes = mix(lengths.astype(_U) * STEP)
    eight = eights(data)
    left = np.flatnonzero(lengths <= long)
    for at in range(0, long, 8):
        left = left[lengths[left] > at]
        if not len(left):
            break
        part = eight[starts[left] + at]
        bits = (8 * np.maximum(0, 8 - (lengths[left] - at))).astype(_U)
        hashes[left] = mix(hashes[left] * STEP + (part & (ALL_BITS >> bits)))
    for i in np.flatnonzero(lengths > long).tolist():
        hashes[i] = int.from_bytes(blake2b(data[starts[i] : starts[i] + lengths[i]].tobytes(), digest_size=8).digest(), "little")
    return hashes


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of bytes that end with a space."""
    edge = np.diff(np.concatenate([[True], IS_SPACE[data]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return starts, byte_hashes(data, starts, ends - starts)


def text_words(raw: list[bytes]) -> tuple[np.ndarray, list[int]]:
    """Hashes of the words of all texts, and the bounds of each text's words (one more than texts)."""
    starts, words = word_hashes(np.frombuffer(b" ".join([*raw, b""]), np.uint8))
    return words, np.searchsorted(starts, np.cumsum([0, *(len(r) + 1 for r in raw)])).tolist()


def chain(words: np.ndarray, used: int) -> np.ndarray:
    """Hashes of all runs of ``used`` words."""
    n = len(words) - used + 1
    grams = np.full(n, used, _U)
    for i in range(used):
        grams = mix(grams * STEP + words[i : n + i])
    return grams
