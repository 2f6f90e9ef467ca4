"""Ids of many words at once: an exact hash table in numpy arrays, of bounded size.

A word of up to `SHORT` bytes is its own key, its bytes and its length in three 64-bit numbers, so words are
read from a text, hashed and looked up as arrays, and equal keys are equal words. Longer words are kept in a
dictionary. The ids of all words lie in one array, a word has a place and a length in it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

SHORT = 23
_TAKEN = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


def keys_of(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Three numbers per word; those of words over SHORT bytes mean nothing."""
    words = np.ndarray(len(data) + SHORT - 6, "<u8", data + bytes(SHORT + 1), strides=(1,))
    keys = [words[starts + 8 * k] & _TAKEN[np.clip(sizes - 8 * k, 0, 8)] for k in range(3)]
    keys[2] = (keys[2] & _TAKEN[7]) | (sizes.astype(np.uint64) << np.uint64(56))
    return tuple(keys)


class WordTable:
    """`ids` looks words up and has `encode` called once for all that are new, which returns the ids of all of
    them, one after the other, and how many each has. About 60 MB with 21 bits."""

    def __init__(self, dtype: np.dtype, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], bits: int = 21):
        self.dtype, self.encode, self.bits = dtype, encode, bits
        self._clear()

    def _clear(self) -> None:
        n = 1 << self.bits
        self.keys = [np.zeros(n, np.uint64) for _ in range(3)]  # the third is never 0 for a word
        self.place, self.count = np.zeros(n, np.int32), np.zeros(n, np.uint8)
        self.long: dict[bytes, tuple[int, int]] = {}
        self.pool, self.used, self.words = np.zeros(n, self.dtype), 0, 0

    def _slots(self, keys: tuple[np.ndarray, ...]) -> np.ndarray:
        h = keys[0] * _FACTORS[0] + keys[1] * _FACTORS[1] + keys[2] * _FACTORS[2]
        h = (h ^ (h >> np.uint64(32))) * _FACTORS[2]
        return (h >> np.uint64(64 - self.bits)).astype(np.intp)

    def _find(self, keys: tuple[np.ndarray, ...]) -> np.ndarray:
        """Slot of every word, -1 for those that the table has not."""
        out = np.full(len(keys[0]), -1, np.intp)
        slots, open_ = self._slots(keys), np.arange(len(out))
        while len(open_):
            last = self.keys[2][slots]
            same = last == keys[2]
            same &= self.keys[0][slots] == keys[0]
            same &= self.keys[1][slots] == keys[1]
            out[open_[same]] = slots[same]
            on = np.flatnonzero(~same & (last != 0))
            open_, keys = open_[on], tuple(k[on] for k in keys)
            slots = (slots[on] + 1) & ((1 << self.bits) - 1)
        return out

    def _put(self, keys: tuple[np.ndarray, ...], place: np.ndarray, count: np.ndarray) -> None:
        """Words that are not in the table, each once."""
        slots, left = self._slots(keys), np.arange(len(place))
        while len(left):
            free = self.keys[2][slots[left]] == 0
            _, first = np.unique(slots[left[free]], return_index=True)
            now = left[free][first]
            for own, key in zip(self.keys, keys, strict=True):
                own[slots[now]] = key[now]
            self.place[slots[now]], self.count[slots[now]] = place[now], count[now]
            slots[left[~free]] = (slots[left[~free]] + 1) & ((1 << self.bits) - 1)
            left = np.setdiff1d(left, now, assume_unique=True)

    def _add(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Place and count of new words, which the table keeps as far as it has room."""
        found, count = self.encode([w.decode() for w in words])
        total = len(found)
        if self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(total, len(self.pool)), self.dtype)])
        self.pool[self.used : self.used + total] = found
        place = (np.cumsum(count) - count + self.used).astype(np.int32)
        self.used += total
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero(sizes <= SHORT)[: (3 << self.bits) // 4 - self.words]
        keys = keys_of(b"".join(words), np.cumsum(sizes) - sizes, np.minimum(sizes, SHORT))
        self._put(tuple(k[short] for k in keys), place[short], count[short])
        self.words += len(short)
        for k in np.flatnonzero(sizes > SHORT).tolist():
            self.long[words[k]] = int(place[k]), int(count[k])
        return place, count

    def ids(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each word has. A word of no bytes has none."""
        if self.words + len(self.long) > (5 << self.bits) // 8 or self.used > 8 << self.bits:
            self._clear()  # it only saves time
        place, count = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int32)
        short = np.flatnonzero((sizes <= SHORT) & (sizes > 0))
        slots = self._find(keys_of(data, starts[short], sizes[short]))
        hit = slots >= 0
        place[short[hit]], count[short[hit]] = self.place[slots[hit]], self.count[slots[hit]]
        rest = np.concatenate([short[~hit], np.flatnonzero(sizes > SHORT)])
        if len(rest):
            own = [data[a : a + n] for a, n in zip(starts[rest].tolist(), sizes[rest].tolist(), strict=True)]
            new = list(dict.fromkeys(w for w in own if w not in self.long))
            fresh = dict(zip(new, zip(*(x.tolist() for x in self._add(new)), strict=True), strict=True)) if new else {}
            place[rest], count[rest] = np.array([fresh.get(w) or self.long[w] for w in own], np.int32).T
        ends = np.cumsum(count, dtype=np.int64)
        at = np.repeat(place - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        return self.pool[at], ends
