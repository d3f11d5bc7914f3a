"""Elias-Fano coding of ascending numbers with select."""

from __future__ import annotations

import struct

import numpy as np

#: Every so many set bits of the upper part have their place stored.
SAMPLE = 256
_HEAD = "<QQBxxxxxxx"


def encode(values: np.ndarray) -> bytes:
    """Bytes for ascending, non-negative numbers; about 2 + log2(largest / n) bits each."""
    values = np.asarray(values, np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    high = (values >> np.uint64(low)).astype(np.int64)
    places = high + np.arange(n)
    upper = np.zeros((int(places[-1]) + 64) // 64 * 64 if n else 0, np.uint8)
    upper[places] = 1
    lower = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    lower = np.packbits(lower.astype(np.uint8).ravel(), bitorder="little").tobytes()
    samples = places[::SAMPLE].astype("<u4").tobytes()
    bits = np.packbits(upper, bitorder="little").tobytes()
    sizes = struct.pack("<QQ", len(lower), len(bits))
    return struct.pack(_HEAD, n, top, low) + sizes + samples + lower + bits


class EliasFano:
    """Reads what ``encode`` wrote, in place."""

    def __init__(self, data: memoryview | bytes, at: int = 0):
        self.n, self.top, self.low = struct.unpack_from(_HEAD, data, at)
        at += struct.calcsize(_HEAD)
        n_lower, n_bits = struct.unpack_from("<QQ", data, at)
        at += 16
        n_samples = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(data, "<u4", n_samples, at)
        at += 4 * n_samples
        self.lower = np.frombuffer(data, np.uint8, n_lower, at)
        at += n_lower
        self.bits = np.frombuffer(data, np.uint8, n_bits, at)
        self.end = at + n_bits

    def _low(self, i: int) -> int:
        a, b = i * self.low, (i + 1) * self.low
        word = int.from_bytes(self.lower[a // 8 : -(-b // 8)].tobytes(), "little")
        return word >> (a % 8) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """The i-th number: a sample, then a count of bits from there on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        left, place = i % SAMPLE, int(self.samples[i // SAMPLE])
        byte = place // 8
        value = int(self.bits[byte]) >> (place % 8) << (place % 8)
        while (ones := value.bit_count()) <= left:
            left -= ones
            byte += 1
            value = int(self.bits[byte])
        for _ in range(left):
            value &= value - 1
        place = byte * 8 + (value & -value).bit_length() - 1
        return (place - i) << self.low | self._low(i)

    def all(self) -> np.ndarray:
        """All numbers at once."""
        places = np.flatnonzero(np.unpackbits(self.bits, bitorder="little"))
        high = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high
        bits = np.unpackbits(self.lower, count=self.n * self.low, bitorder="little")
        weight = np.uint64(1) << np.arange(self.low, dtype=np.uint64)
        return high | (bits.reshape(self.n, self.low).astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64)
