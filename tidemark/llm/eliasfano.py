"""Elias-Fano sequences over numpy arrays, with look-ups of many values at once.

A sorted sequence of n numbers below u keeps the low bits of each number as
they are and the high parts as a bit vector in unary: about 2 + log2(u / n)
bits a number. Directories give the word of every ``EVERY``-th set and clear
bit. The arrays may be memory-mapped; look-ups touch a few words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_U = np.uint64
EVERY = 64   # one in so many set and clear bits has its word in the directories
STEPS = 2    # words walked on from there before a binary search
CHUNK = 1 << 15  # values looked up or built together: their arrays stay in a core's cache


_ONES, _HIGHS = _U(0x0101010101010101), _U(0x8080808080808080)
_PAIRS, _FOURS, _NIBBLES = _U(0x5555555555555555), _U(0x3333333333333333), _U(0x0F0F0F0F0F0F0F0F)
#: Place of the k-th set bit of a byte, at byte * 8 + k.
_IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[:8] for byte in range(256)],
                    dtype=np.uint8).ravel()


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th set bit of each word (k from 0, below the number of set bits)."""
    k = k.astype(np.uint64)
    sums = words - ((words >> _U(1)) & _PAIRS)
    sums = (sums & _FOURS) + ((sums >> _U(2)) & _FOURS)
    sums = ((sums + (sums >> _U(4))) & _NIBBLES) * _ONES  # byte i: set bits of bytes 0 to i
    place = np.bitwise_count((k * _ONES | _HIGHS) - sums & _HIGHS).astype(np.uint64) << _U(3)
    k -= (sums << _U(8)) >> place & _U(0xFF)
    byte = words >> place & _U(0xFF)
    return place.astype(np.int64) + _IN_BYTE[(byte << _U(3) | k).astype(np.int64)]


def _directory(before: np.ndarray, total: int) -> np.ndarray:
    """Word of every ``EVERY``-th bit of a kind, of which ``before`` lie before each word."""
    return (np.searchsorted(before, np.arange(0, max(total, 1), EVERY), side="right") - 1).astype(np.uint32)


def _once(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal neighbours once, and how often: ascending values are looked up once each."""
    new = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[new], np.diff(new, append=len(values))


@dataclass
class EliasFano:
    n: int
    low_bits: int
    low: np.ndarray      # packed low parts
    high: np.ndarray     # unary high parts, 64 bits a word
    before: np.ndarray   # set bits before each word
    ones: np.ndarray     # word of every EVERY-th set bit
    zeros: np.ndarray    # and clear bit

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        """``values``: ascending, below ``universe``."""
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        low_bits = max(0, int(np.floor(np.log2(max(universe, 1) / max(n, 1))))) if universe > n else 0
        low = np.zeros(n * low_bits // 64 + 2, dtype=np.uint64)
        high = np.zeros((n + (universe >> low_bits) + 2) // 64 + 1, dtype=np.uint64)
        for at in range(0, n, CHUNK):
            some = values[at:at + CHUNK]
            places = np.arange(at, at + len(some))
            if low_bits:
                part = some & _U((1 << low_bits) - 1)
                bit = places.astype(np.uint64) * _U(low_bits)
                word, off = (bit >> _U(6)).astype(np.int64), bit & _U(63)
                np.bitwise_or.at(low, word, part << off)
                over = off + _U(low_bits) > _U(64)
                np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U(64) - off[over]))
            top = (some >> _U(low_bits)).astype(np.int64) + places
            np.bitwise_or.at(high, top >> 6, _U(1) << (top & 63).astype(np.uint64))
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))])
        clear = np.arange(len(before)) * 64 - before
        return cls(n, low_bits, low, high, before, _directory(before, n), _directory(clear, int(clear[-1])))

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        bit = i * self.low_bits
        word = bit >> 6
        bit &= 63
        off = bit.view(np.uint64)
        out = self.low[word]
        out >>= off
        word += 1
        second = self.low[word]
        # a shift by 64 is undefined: shift by 63 - off and one more
        second <<= np.subtract(_U(63), off, out=off)
        second <<= _U(1)
        out |= second
        out &= _U((1 << self.low_bits) - 1)
        return out

    def _word(self, k: np.ndarray, clear: bool) -> tuple[np.ndarray, np.ndarray]:
        """Word of the k-th set (or clear) bit, and its place among the word's set (clear) bits."""
        at = (lambda w: w * 64 - self.before[w]) if clear else (lambda w: self.before[w])
        directory, entry = self.zeros if clear else self.ones, k // EVERY
        word = directory[entry].astype(np.int64)
        open_ = np.flatnonzero(at(word + 1) <= k)
        for _ in range(STEPS):
            if not len(open_):
                break
            word[open_] += 1
            open_ = open_[at(word[open_] + 1) <= k[open_]]
        # farther away, but not behind the directory's next word: halve
        after = entry[open_] + 1
        high = np.where(after < len(directory), directory[np.minimum(after, len(directory) - 1)] + 1, len(self.high))
        while len(open_):
            low = word[open_]
            wide = high - low > 1
            open_, high, low = open_[wide], high[wide], low[wide]
            middle = (low + high) >> 1
            after = at(middle) <= k[open_]
            word[open_] = np.where(after, middle, low)
            high = np.where(after, high, middle)
        return word, k - at(word)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The i-th values (0 <= i < n)."""
        i = np.asarray(i, dtype=np.int64)
        out = np.zeros(len(i), dtype=np.int64)
        for at in range(0, len(i), CHUNK):
            part = i[at:at + CHUNK]
            word, k = self._word(part, clear=False)
            top = word * 64 + _select_in_word(self.high[word], k) - part
            out[at:at + CHUNK] = top.astype(np.uint64) << _U(self.low_bits) | self._lows(part)
        return out

    def _starts(self, top: np.ndarray) -> np.ndarray:
        """Number of values whose high part is below ``top``."""
        out = np.zeros(len(top), dtype=np.int64)
        some = np.flatnonzero(top > 0)
        zero = top[some] - 1  # the clear bit that ends the run of high part top - 1
        word, k = self._word(zero, clear=True)
        out[some] = word * 64 + _select_in_word(~self.high[word], k) - zero
        return out

    def _runs(self, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First index of the values with high part ``top``, and the index after them."""
        first = self._starts(top)
        bit = first + top  # the run's set bits begin here
        rest = ~(self.high[bit >> 6] >> (bit & 63).astype(np.uint64))
        length = np.bitwise_count((rest & -rest) - _U(1)).astype(np.int64)
        end = first + length
        over = np.flatnonzero((bit & 63) + length >= 64)  # up to the word's end, and perhaps beyond
        end[over] = self._starts(top[over] + 1)
        return first, end

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the first value not below x, the end of the values with x's high part, x's low part."""
        top = x >> self.low_bits
        want = x.astype(np.uint64) & _U((1 << self.low_bits) - 1)
        tops, times = _once(top)
        first, stop = (np.repeat(a, times) for a in self._runs(tops))
        open_ = np.flatnonzero(first < stop)
        at, sought = first[open_], want[open_]
        left = stop[open_] - at  # the index is one of at to at + left
        while len(open_):  # halve the runs of equal high part
            wide = left > 1
            n_wide = np.count_nonzero(wide)
            if 2 * n_wide < len(open_):  # leave out those that are down to one
                one = ~wide
                first[open_[one]] = at[one] + (self._lows(at[one]) < sought[one])
                open_, at, sought, left = open_[wide], at[wide], sought[wide], left[wide]
            half = left >> 1
            left -= half
            half *= self._lows(at + half) < sought
            at += half
        return first, stop, want

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value not below x (0 <= x < universe)."""
        x = np.asarray(x, dtype=np.int64)
        out = np.zeros(len(x), dtype=np.int64)
        for at in range(0, len(x) if self.n else 0, CHUNK):
            out[at:at + CHUNK] = self._search(x[at:at + CHUNK])[0]
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each x, -1 where it is not in the sequence."""
        x = np.asarray(x, dtype=np.int64)
        out = np.full(len(x), -1)
        for at in range(0, len(x) if self.n else 0, CHUNK):
            part, times = _once(x[at:at + CHUNK])
            first, stop, want = self._search(part)
            inside = np.flatnonzero(first < stop)
            first[first >= stop] = -1
            first[inside[self._lows(first[inside]) != want[inside]]] = -1
            out[at:at + CHUNK] = np.repeat(first, times)
        return out

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.size": np.array([self.n, self.low_bits]), f"{name}.low": self.low,
                f"{name}.high": self.high, f"{name}.before": self.before,
                f"{name}.ones": self.ones, f"{name}.zeros": self.zeros}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, low_bits = (int(v) for v in arrays[f"{name}.size"])
        return cls(n, low_bits, *(arrays[f"{name}.{part}"] for part in ("low", "high", "before", "ones", "zeros")))
