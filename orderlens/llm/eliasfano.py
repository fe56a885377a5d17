"""Elias-Fano coded monotone sequences with vectorised access and search."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_SELECT = np.array([[([i for i in range(8) if byte >> i & 1] + [8] * 8)[k] for k in range(8)] for byte in range(256)], np.int64)

# 64-bit words made of equal parts: 01, 0011, 00001111, 00000001 and 10000000.
_PAIRS, _QUARTERS, _BYTES, _ONES, _TOPS = (_U((1 << 64) // ((1 << n) - 1) * m) for n, m in ((2, 1), (4, 3), (8, 15), (8, 1), (8, 128)))


class EliasFano:
    """A non-decreasing sequence of n values below ``universe`` in about 2 + log2(universe / n) bits each.

    The low bits are packed; value i sets bit (value >> low) + i of the high bits.
    """

    def __init__(self, n: int, low: int, lows: np.ndarray, highs: np.ndarray):
        self.n, self.low, self.lows, self.highs = n, low, lows, highs
        self.directory: list[np.ndarray | None] = [None, None]  # of zeros and ones, one entry per 64-bit word

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        low = max(0, int(universe // n).bit_length() - 1) if n else 0
        values = values.astype(_U)
        at = np.arange(n, dtype=_U) * _U(low)
        lows = np.zeros(n * low // 64 + 2, _U)
        if low and n:
            part = values & _U((1 << low) - 1)
            word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lows[word[first]] |= np.bitwise_or.reduceat(part << shift, first)
            over = shift + _U(low) > _U(64)
            lows[word[over] + 1] |= part[over] >> (_U(64) - shift[over])  # one value at most reaches into a word
        high = (values >> _U(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros(((int(high[-1]) + 2 if n else 1) + 63) // 64 * 64, bool)
        bits[high] = True
        return cls(n, low, lows, np.packbits(bits, bitorder="little").view(_U))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low, len(self.lows), len(self.highs)], np.int64)
        return head.tobytes() + self.lows.tobytes() + self.highs.tobytes()

    @classmethod
    def from_buffer(cls, data) -> EliasFano:
        """From what ``to_bytes`` wrote, without a copy; ``data`` may be a memory map."""
        n, low, a, b = (int(x) for x in np.frombuffer(data, np.int64, 4))
        return cls(n, low, np.frombuffer(data, _U, a, 32), np.frombuffer(data, _U, b, 32 + 8 * a))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), _U)
        at = i.astype(_U) * _U(self.low)
        word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
        upper = np.where(shift > 0, self.lows[word + 1] << ((_U(64) - shift) & _U(63)), _U(0))
        return ((self.lows[word] >> shift) | upper) & _U((1 << self.low) - 1)

    def values(self) -> np.ndarray:
        """The whole sequence."""
        high = np.flatnonzero(np.unpackbits(self.highs.view(np.uint8), bitorder="little"))[: self.n] - np.arange(self.n)
        return (high.astype(_U) << _U(self.low)) | self._low(np.arange(self.n))

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Bit positions of the k-th ones or zeros of the high bits, the length of the bits for those beyond."""
        if self.directory[ones] is None:
            count = np.bitwise_count(self.highs)
            self.directory[ones] = np.concatenate([[0], np.cumsum(count if ones else 64 - count, dtype=np.int64)])
        directory = self.directory[ones]
        inside = k < directory[-1]
        k = np.where(inside, k, 0)
        word = np.searchsorted(directory, k, "right") - 1
        bits, left = self.highs[word], (k - directory[word]).astype(_U)
        if not ones:
            bits = ~bits
        # ones up to the end of each byte, side by side; then the bytes that end before the wanted one
        sums = bits - ((bits >> _U(1)) & _PAIRS)
        sums = (sums & _QUARTERS) + ((sums >> _U(2)) & _QUARTERS)
        sums = ((sums + (sums >> _U(4))) & _BYTES) * _ONES
        passed = np.bitwise_count(((left * _ONES | _TOPS) - sums) & _TOPS).astype(_U)
        shift = passed * _U(8)
        left -= (sums << _U(8) >> shift) & _U(255)
        found = word * 64 + shift.astype(np.int64) + _SELECT[((bits >> shift) & _U(255)).astype(np.int64), left.astype(np.int64)]
        return np.where(inside, found, len(self.highs) * 64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``, read one by one."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, _U)
        return ((self._select(i, True) - i).astype(_U) << _U(self.low)) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """For each x the place of the first value >= x, n if there is none."""
        x = x.astype(_U)
        if not self.n or not len(x):
            return np.full(len(x), self.n, np.int64)
        h = (x >> _U(self.low)).astype(np.int64)
        begin = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - np.maximum(h - 1, 0), 0)
        end = self._select(h, False) - h
        begin, end = np.minimum(begin, self.n), np.minimum(np.maximum(end, 0), self.n)
        want = x & _U((1 << self.low) - 1)
        while True:
            open_ = np.flatnonzero(begin < end)
            if not len(open_):
                return begin
            middle = (begin[open_] + end[open_]) // 2
            less = self._low(middle) < want[open_]
            begin[open_] = np.where(less, middle + 1, begin[open_])
            end[open_] = np.where(less, end[open_], middle)
