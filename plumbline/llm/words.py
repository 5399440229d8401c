"""Words of many texts at once, as positions and 64-bit hashes in numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones((2, 1), np.uint64)
#: Powers kept for the process; more are made for one use.
_KEPT = 1 << 21

#: A-Z in lower case; every byte that is neither a digit, a letter nor part of a longer code point is 0.
WORD_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)


def _power_table(n: int) -> np.ndarray:
    """Powers of the base and of its inverse modulo 2^64, by doubling."""
    global _powers
    powers = _powers
    while powers.shape[1] < n:
        k = powers.shape[1]
        step = np.array([[pow(_BASE, k, 1 << 64)], [pow(_INVERSE, k, 1 << 64)]], np.uint64)
        powers = np.concatenate([powers, powers[:, : n - k] * step], axis=1)
        if powers.shape[1] <= _KEPT:
            _powers = powers
    return powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    start: np.ndarray  # byte position of each word in the slice
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each text: index of its first word; one more entry than texts

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def words_of(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD_BYTES) -> Words:
    """Words of texts that lie one after the other in ``data``; ``kind`` maps a byte to what is hashed, 0 between words.

    Equal words have equal hashes; different ones collide with a probability of about length / 2^64.
    """
    return words_and_prefixes(data, offsets, (), kind)[0]


def words_and_prefixes(
    data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...], kind: np.ndarray = WORD_BYTES
) -> tuple[Words, list[tuple[np.ndarray, np.ndarray]]]:
    """``words_of``, and for each of ``lengths`` in bytes the index of the words longer than it and the hashes of their beginnings."""
    low = kind[data]
    inside = low != 0
    n = len(low)
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | begins[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins[1:n]
    start, end = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    powers = _power_table(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(low.astype(np.uint64) * powers[0, :n], out=total[1:])

    def hashes(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (total[end] - total[start]) * powers[1, start]
        return mix(value + (end - start).astype(np.uint64))

    prefixes = []
    for k in lengths:
        long = np.flatnonzero(end - start > k)
        prefixes.append((long, hashes(start[long], start[long] + k)))
    return Words(start, end, hashes(start, end), np.searchsorted(start, offsets)), prefixes


def hash_word(word: bytes) -> int:
    """Hash of one word that is already in lower case, equal to that of ``words_of``."""
    data = np.frombuffer(word, np.uint8)
    found = words_of(data, np.array([0, len(data)]))
    return int(found.hash[0])


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row, within each text: hash, first word, text.

    A text of fewer words, but not none, has one window with all of them.
    """
    count = words.counts()
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(len(count)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(words.first[:-1], n)
    size = np.minimum(count, width)[text]
    value = np.zeros(len(at), np.uint64)
    for k in range(width):
        take = np.minimum(at + k, len(words.hash) - 1)
        value = np.where(k < size, value * np.uint64(0xD6E8FEB86659FD93) + words.hash[take], value) if len(at) else value
    return mix(value ^ size.astype(np.uint64)), at, text
