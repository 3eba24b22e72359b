"""Monotone sequences in Elias-Fano form, queried many at a time; they live in one flat buffer, so they can be mapped."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def _select(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The place of the k-th (from 0) set bit of each word, by halving."""
    at, k = np.zeros(len(word), np.int64), k.astype(np.int64).copy()
    for half in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count((word >> at.astype(_U)) & _U((1 << half) - 1)).astype(np.int64)
        up = k >= low
        k -= np.where(up, low, 0)
        at += np.where(up, half, 0)
    return at


class EliasFano:
    """n ascending values under a universe: low bits packed, high parts in unary, with running counts per word."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.int64)
        n, top = len(v), int(v[-1]) + 1 if len(v) else 1
        width = max(0, (top // max(1, n)).bit_length() - 1)
        spots = (v >> width) + np.arange(n)
        high = np.zeros((int(spots[-1]) if n else 0) // 64 + 2, _U)
        np.bitwise_or.at(high, spots >> 6, _U(1) << (spots & 63).astype(_U))
        low = np.zeros(n * width // 64 + 2, _U)
        if width:
            at = np.arange(n) * width
            part = v.astype(_U) & _U((1 << width) - 1)
            np.bitwise_or.at(low, at >> 6, part << (at & 63).astype(_U))
            over = (at & 63) + width > 64
            np.bitwise_or.at(low, (at[over] >> 6) + 1, part[over] >> (64 - (at[over] & 63)).astype(_U))
        return cls(n, width, low, high)

    def pack(self) -> list[np.ndarray]:
        return [np.array([self.n, self.width, len(self.low), len(self.high)], _U), self.low, self.high]

    @classmethod
    def unpack(cls, words: np.ndarray, at: int) -> tuple[EliasFano, int]:
        n, width, a, b = (int(x) for x in words[at : at + 4])
        at += 4
        return cls(n, width, words[at : at + a], words[at + a : at + a + b]), at + a + b

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        at = i * self.width
        word, off = at >> 6, (at & 63).astype(_U)
        x = self.low[word] >> off
        over = off + _U(self.width) > _U(64)
        x = np.where(over, x | (self.low[word + 1] << ((_U(64) - off) & _U(63))), x)
        return (x & _U((1 << self.width) - 1)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        word = np.searchsorted(self.ones, i, "right") - 1
        spot = word * 64 + _select(self.high[word], i - self.ones[word])
        return ((spot - i) << self.width) + self._lows(i)

    def _before(self, h: np.ndarray) -> np.ndarray:
        """How many values have a high part under h: what stands before the h-th zero (from 1)."""
        last = int(self.zeros[-1])
        k = np.clip(h - 1, 0, last - 1)
        word = np.searchsorted(self.zeros, k, "right") - 1
        spot = word * 64 + _select(~self.high[word], k - self.zeros[word])
        return np.minimum(np.where(h <= 0, 0, np.where(h - 1 >= last, self.n, spot - k)), self.n)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The place of the first value that is at least x; n if there is none."""
        h, want = x >> self.width, x & ((1 << self.width) - 1)
        lo, hi = self._before(h), self._before(h + 1)
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            less = (lo < hi) & (self._lows(np.minimum(mid, max(0, self.n - 1))) < want)
            lo, hi = np.where(less, mid + 1, lo), np.where((lo < hi) & ~less, mid, hi)
        return lo
