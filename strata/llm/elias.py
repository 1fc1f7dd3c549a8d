"""Elias-Fano sequences over numpy arrays, for many queries at a time.

A sorted sequence of n values below u keeps the low l bits of each value
packed, and the high bits in unary: a one per value, a zero after each bucket
of equal high bits. Counts of ones per 64-bit word lead to the k-th one or
zero. The arrays are plain, so they may be memory-mapped.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_L8, _H8 = _U(0x0101010101010101), _U(0x8080808080808080)
#: Place of the k-th set bit of a byte, by byte and k.
_AT = np.zeros((256, 8), dtype=np.uint64)
for _b in range(256):
    _at = [k for k in range(8) if _b >> k & 1]
    _AT[_b, :len(_at)] = _at


def _bit_at(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) set bit of each word: counts of the bits up
    to each byte, side by side in one word, show the byte to look into."""
    k = k.astype(_U)
    c = words - ((words >> _U(1)) & _U(0x5555555555555555))
    c = (c & _U(0x3333333333333333)) + ((c >> _U(2)) & _U(0x3333333333333333))
    upto = ((c + (c >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _L8
    place = np.bitwise_count(((k * _L8 | _H8) - upto) & _H8).astype(_U) << _U(3)
    before = ((upto << _U(8)) >> place) & _U(0xFF)
    return (place + _AT[((words >> place) & _U(0xFF)).astype(np.intp), (k - before).astype(np.intp)]).astype(np.int64)


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` bits of each value, put end to end in 64-bit words."""
    out = np.zeros(len(values) * bits // 64 + 2, dtype=_U)
    if bits and len(values):
        v = values & _U((1 << bits) - 1)
        at = np.arange(len(v), dtype=np.int64) * bits
        word, off = at >> 6, (at & 63).astype(_U)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] |= np.bitwise_or.reduceat(v << off, first)
        out[word[first] + 1] |= np.bitwise_or.reduceat((v >> _U(1)) >> (_U(63) - off), first)
    return out


class EliasFano:
    """``arrays()`` gives what the constructor takes."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.low, self.high = n, bits, low, high
        self.ones = ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones.astype(np.int64)
        self.buckets = int(len(high) * 64 - n)

    @classmethod
    def build(cls, values: np.ndarray, below: int) -> "EliasFano":
        values = values.astype(_U)
        n = len(values)
        bits = max(0, (below // max(n, 1)).bit_length() - 1)
        top = (values >> _U(bits)).astype(np.int64)
        at = top + np.arange(n)
        size = (int(top[-1]) if n else 0) + n + 1
        flags = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
        flags[at] = 1
        high = np.packbits(flags, bitorder="little").view("<u8").astype(_U)
        ones = np.append(0, np.cumsum(flags.reshape(-1, 64).sum(axis=1)))[:-1]
        return cls(n, bits, pack(values, bits), high, ones.astype(np.uint32 if n < 1 << 32 else _U))

    def arrays(self) -> dict[str, np.ndarray]:
        return {"size": np.array([self.n, self.bits], dtype=np.int64), "low": self.low, "high": self.high,
                "ones": self.ones}

    @classmethod
    def load(cls, arrays: dict[str, np.ndarray], name: str) -> "EliasFano":
        n, bits = arrays[f"{name}.size"].tolist()
        return cls(n, bits, *(arrays[f"{name}.{k}"] for k in ("low", "high", "ones")))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), dtype=_U)
        at = i * self.bits
        word, off = at >> 6, (at & 63).astype(_U)
        both = (self.low[word] >> off) | ((self.low[word + 1] << _U(1)) << (_U(63) - off))
        return both & _U((1 << self.bits) - 1)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero of the high bits."""
        word = np.searchsorted(self.zeros, k, side="right") - 1
        return word * 64 + _bit_at(~self.high[word], k - self.zeros[word])

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at the places i."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        at = word * 64 + _bit_at(self.high[word], i - self.ones[word].astype(np.int64))
        return ((at - i).astype(_U) << _U(self.bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each x, the place of the first value of x's bucket that is at
        least x (its end if there is none), and whether the value is x."""
        x = x.astype(_U)
        bucket = np.minimum(x >> _U(self.bits), _U(self.buckets)).astype(np.int64)
        inside = bucket < self.buckets
        bucket = np.where(inside, bucket, 0)
        hi = self._zero(bucket) - bucket
        lo = np.zeros(len(x), dtype=np.int64)
        some = bucket > 0
        lo[some] = self._zero(bucket[some] - 1) - (bucket[some] - 1)
        end, want = hi.copy(), x & _U((1 << self.bits) - 1)
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self._low(mid) < want[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
            live = live[lo[live] < hi[live]]
        found = np.zeros(len(x), dtype=bool)
        ok = np.flatnonzero(inside & (lo < end))
        found[ok] = self._low(lo[ok]) == want[ok]
        return lo, found
