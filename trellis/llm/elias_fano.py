"""Elias-Fano coding of sorted numbers, on numpy arrays that may be memory-mapped.

A number is split: its low bits are stored as they are (rounded up to whole bytes), its high
part in unary: the bit at (high part + rank) is set.  About 2 bits and the low bytes per
number; any number, and the place where a number would be, is found without unpacking.
"""

from __future__ import annotations

import numpy as np

_BLOCK = 2                        # 64-bit words between stored counts


def _spare(low_bytes: int) -> int:
    """Rows after the low bytes, so that eight bytes can be read from the start of every number's."""
    return -(-8 // low_bytes) if low_bytes else 0


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of the code of sorted ``values``, all below ``universe``."""
    n = len(values)
    values = values.astype(np.uint64)
    low_bytes = -(-max(0, (universe // max(n, 1)).bit_length() - 1) // 8)
    low = np.zeros((n + _spare(low_bytes), low_bytes), np.uint8)
    low[:n] = np.ascontiguousarray(values).view(np.uint8).reshape(n, 8)[:, :low_bytes]
    shift = np.uint64(8 * low_bytes)
    high = (values >> shift) if low_bytes < 8 else np.zeros(n, np.uint64)
    buckets = (universe >> (8 * low_bytes)) + 1
    bits = np.zeros(-(-(n + buckets) // (64 * _BLOCK)) * 64 * _BLOCK, bool)
    bits[high.astype(np.int64) + np.arange(n)] = True
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    ones = np.bitwise_count(words).reshape(-1, _BLOCK).sum(axis=1, dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(ones)])
    return {"low": low, "words": words, "ones": total.astype(np.uint32 if total[-1] < 2**32 else np.int64),
            "buckets": np.array([buckets], np.int64)}


_EACH = np.uint64(0x0101010101010101)
_TOP = np.uint64(0x8080808080808080)
# place of the k-th set bit of a byte
_IN_BYTE = np.array([[[i for i in range(8) if b >> i & 1][k] if k < bin(b).count("1") else 0 for k in range(8)] for b in range(256)], np.int64)


def select_in_word(w: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit of each 64-bit word, which has more than k."""
    one, two, four = (np.uint64(x) for x in (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F))
    s = w - ((w >> np.uint64(1)) & one)
    s = (s & two) + ((s >> np.uint64(2)) & two)
    upto = ((s + (s >> np.uint64(4))) & four) * _EACH                  # byte i: set bits in bytes 0 to i
    k = k.astype(np.uint64)
    shift = np.bitwise_count((((k * _EACH) | _TOP) - upto) & _TOP).astype(np.uint64) * np.uint64(8)
    k = k - (((upto << np.uint64(8)) >> shift) & np.uint64(255))
    return shift.astype(np.int64) + _IN_BYTE[((w >> shift) & np.uint64(255)).astype(np.int64), k.astype(np.int64)]


def trailing_zeros(w: np.ndarray) -> np.ndarray:
    """Clear bits below the lowest set one; 64 if there is none."""
    return np.bitwise_count((w & (~w + np.uint64(1))) - np.uint64(1)).astype(np.int64)


class EliasFano:
    """Reads the arrays of ``encode``."""

    def __init__(self, arrays: dict[str, np.ndarray], prefix: str = ""):
        self.low, self.words, self.ones = (arrays[prefix + k] for k in ("low", "words", "ones"))
        self.buckets = int(arrays[prefix + "buckets"][0])
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * (64 * _BLOCK) - self.ones
        self.low_bytes = self.low.shape[1]
        self.n = len(self.low) - _spare(self.low_bytes)
        # eight bytes from where each number's low bytes start
        self.wide = np.ndarray((self.n,), "<u8", np.ascontiguousarray(self.low), 0, (self.low_bytes,)) if self.low_bytes and self.n else None

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th set (or clear) bit, counted from 0."""
        upto = self.ones if ones else self.zeros
        block = np.searchsorted(upto, k.astype(upto.dtype), side="right") - 1
        rest = k - upto[block]
        w = self.words[block * _BLOCK]
        if not ones:
            w = ~w
        place = block * (64 * _BLOCK)
        count = np.bitwise_count(w).astype(np.int64)
        later = np.flatnonzero(rest >= count)
        if len(later):
            rest[later] -= count[later]
            place[later] += 64
            next_words = self.words[block[later] * _BLOCK + 1]
            w[later] = next_words if ones else ~next_words
        return place + select_in_word(w, rest)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if self.wide is None:
            return np.zeros(len(i), np.uint64)
        return self.wide[i] & np.uint64((1 << (8 * self.low_bytes)) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places ``i``."""
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(8 * self.low_bytes)) | self._low(i)

    def ranges(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at places ``i`` and ``i + 1``; the second is read from the next set bit."""
        at = self._select(i, True)
        step = trailing_zeros(self.words[at >> 6] >> (at & 63).astype(np.uint64) >> np.uint64(1))
        after = at + 1 + step
        far = np.flatnonzero(step == 64)
        after[far] = self._select(i[far] + 1, True)
        shift = np.uint64(8 * self.low_bytes)
        return (((at - i).astype(np.uint64) << shift) | self._low(i)).astype(np.int64), \
            (((after - i - 1).astype(np.uint64) << shift) | self._low(i + 1)).astype(np.int64)

    def _bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and end of the numbers with each high part."""
        first = np.zeros(len(high), np.int64)             # bit after the clear bit that ends the high part before
        later = np.flatnonzero(high > 0)
        first[later] = self._select(high[later] - 1, False) + 1
        start = first - high
        run = trailing_zeros(~(self.words[first >> 6] >> (first & 63).astype(np.uint64)))
        end = start + run
        far = np.flatnonzero((first & 63) + run >= 64)    # the run of set bits goes on in the next word
        end[far] = self._select(high[far], False) - high[far]
        return start, end

    def find(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray, which: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Successor search: where each of the sorted distinct ``x`` is, else -1.

        ``x[k]`` is looked for in the places ``lo`` to ``hi`` (exclusive) of range ``which[k]``, whose
        numbers lie from ``least`` to ``most``; ranges ascend.  Numbers of one range and high part are
        looked for together: in short stretches by one sorted search over their low bytes, in stretches
        much longer than what is looked for by halving."""
        bits = 8 * self.low_bytes
        cut = (lambda v: (v >> np.uint64(bits)).astype(np.int64)) if bits < 64 else (lambda v: np.zeros(len(v), np.int64))
        place = np.full(len(x), -1, np.int64)
        at = np.flatnonzero(lo[which] < hi[which])
        high = cut(x[at])
        inside = high < self.buckets
        at, high = at[inside], high[inside]
        if not len(at):
            return place
        of = which[at]
        new = np.ones(len(at), bool)
        new[1:] = (of[1:] != of[:-1]) | (high[1:] != high[:-1])
        first = np.flatnonzero(new)
        asked = np.diff(first, append=len(at))            # numbers of each group
        group = np.repeat(np.arange(len(first)), asked)
        of, high = of[first], high[first]
        a, b = lo[of], hi[of]
        across = np.flatnonzero(cut(least[of]) != cut(most[of]))   # ranges of several high parts
        if len(across):
            start, end = self._bucket(high[across])
            a[across], b[across] = np.maximum(start, a[across]), np.maximum(np.minimum(end, b[across]), a[across])
        size = np.maximum(b - a, 0)
        want = x[at] & np.uint64((1 << bits) - 1)
        short = size <= 32 * asked + 32
        if bits + int(len(first)).bit_length() > 64:
            short[:] = False
        few = np.flatnonzero(short)
        if len(few):
            sizes = size[few]
            ends = np.cumsum(sizes)
            places = np.repeat(a[few] - ends + sizes, sizes) + np.arange(ends[-1])
            have = (np.repeat(few, sizes).astype(np.uint64) << np.uint64(bits)) | self._low(places) if bits < 64 else self._low(places)
            mine = np.flatnonzero(short[group])
            asks = (group[mine].astype(np.uint64) << np.uint64(bits)) | want[mine] if bits < 64 else want[mine]
            found = np.searchsorted(have, asks)
            hit = np.flatnonzero(found < len(have))
            hit = hit[have[found[hit]] == asks[hit]]
            place[at[mine[hit]]] = places[found[hit]]
        rest = np.flatnonzero(~short[group] & (size[group] > 0))
        if len(rest):
            place[at[rest]] = self._halve(want[rest], a[group[rest]], b[group[rest]])
        return place

    def _halve(self, want: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where among the places ``a`` to ``b`` (exclusive, not empty) the low bytes are ``want``, else -1."""
        n = b - a
        for _ in range(int(n.max() - 1).bit_length()):
            half = n >> 1
            a = np.where(self._low(a + np.maximum(half - 1, 0)) < want, a + half, a)
            n = n - half
        return np.where(self._low(a) == want, a, -1)
