"""Elias-Fano codes of ascending integers: about 2 + log2(universe / n) bits each, with a select structure.

A value is split into `low` bits, packed as they are, and the rest, in unary in a bit vector: the i-th one of the vector
at position p stands for the high part p - i. Selecting the i-th one therefore gives the i-th value. Every SAMPLE-th
one's position is kept, in as few bits as the vector's length needs, so a select scans one short stretch of bits and
no table of 64-bit offsets exists.

Defined cases: an empty sequence takes the header alone; equal values in a row are allowed; a falling one is an error.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
#: Values that are spread out into bits at once.
BLOCK = 1 << 16
HEADER = struct.Struct("<QQQB3x")  # values, universe, bits of the high vector, low bits


def _pack(values: np.ndarray, bits: int) -> bytes:
    if not bits or not len(values):
        return b""
    shifts = np.arange(bits, dtype=np.uint64)
    parts = (values[a : a + BLOCK].astype(np.uint64)[:, None] >> shifts for a in range(0, len(values), BLOCK))  # a block fills whole bytes
    return b"".join(np.packbits((x & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes() for x in parts)


def _unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if not bits:
        return np.zeros(n, np.uint64)
    out, shifts = np.empty(n, np.uint64), np.arange(bits, dtype=np.uint64)
    for a in range(0, n, BLOCK):
        m = min(BLOCK, n - a)
        flat = np.unpackbits(np.frombuffer(data, np.uint8, (m * bits + 7) // 8, a * bits // 8), bitorder="little", count=m * bits).reshape(m, bits)
        out[a : a + m] = (flat.astype(np.uint64) << shifts).sum(1, dtype=np.uint64)
    return out


def _one(data: bytes, bits: int, i: int) -> int:
    """The i-th packed integer, from the few bytes that hold it."""
    if not bits:
        return 0
    a, b = i * bits // 8, (i * bits + bits + 7) // 8
    return (int.from_bytes(data[a:b], "little") >> (i * bits % 8)) & ((1 << bits) - 1)


class EliasFano:
    def __init__(self, n: int, universe: int, high_bits: int, low: int, lows: bytes, high: bytes, samples: bytes):
        self.n, self.universe, self.high_bits, self.low = n, universe, high_bits, low
        self.lows, self.high, self.samples = lows, high, samples
        self.sample_bits = max(1, high_bits.bit_length())

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, 0, 0, b"", b"", b"")
        if values[0] < 0 or (np.diff(values) < 0).any():
            raise ValueError("Elias-Fano codes need ascending values from 0 on")
        universe = int(values[-1])
        low = max(0, (max(1, universe) // n).bit_length() - 1)
        ones = (values >> low) + np.arange(n)
        bits = int(ones[-1]) + 1
        high = np.zeros(bits, np.uint8)
        high[ones] = 1
        out = cls(n, universe, bits, low, _pack(values & ((1 << low) - 1), low), np.packbits(high, bitorder="little").tobytes(), b"")
        out.samples = _pack(ones[::SAMPLE], out.sample_bits)
        return out

    def to_bytes(self) -> bytes:
        return HEADER.pack(self.n, self.universe, self.high_bits, self.low) + self.lows + self.high + self.samples

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, universe, bits, low = HEADER.unpack_from(data)
        a = HEADER.size
        b = a + (n * low + 7) // 8
        c = b + (bits + 7) // 8
        return cls(n, universe, bits, low, data[a:b], data[b:c], data[c:])

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = _one(self.samples, self.sample_bits, i // SAMPLE)
        left = i % SAMPLE
        byte = at // 8
        word = self.high[byte] >> (at % 8) << (at % 8)
        while (c := word.bit_count()) <= left:
            left -= c
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        return ((place - i) << self.low) | _one(self.lows, self.low, i)

    def block(self, i: int, j: int) -> np.ndarray:
        """The values from the i-th up to the j-th, which is not included: select for a stretch, from the bits between two samples."""
        if not 0 <= i <= j <= self.n:
            raise IndexError((i, j))
        if i == j:
            return np.empty(0, np.int64)
        at = _one(self.samples, self.sample_bits, i // SAMPLE)
        last = (j - 1) // SAMPLE + 1
        end = _one(self.samples, self.sample_bits, last) if last * SAMPLE < self.n else self.high_bits
        byte = at // 8
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8, -(-end // 8) - byte, byte), bitorder="little", count=end - byte * 8)
        bits[: at - byte * 8] = 0
        ones = np.flatnonzero(bits)[i % SAMPLE : i % SAMPLE + j - i] + byte * 8
        return ((ones - np.arange(i, j)) << self.low) | self._lows(i, j)

    def _lows(self, i: int, j: int) -> np.ndarray:
        if not self.low:
            return np.zeros(j - i, np.int64)
        a = i * self.low // 8
        flat = np.unpackbits(np.frombuffer(self.lows, np.uint8, -(-j * self.low // 8) - a, a), bitorder="little")
        flat = flat[i * self.low - a * 8 : j * self.low - a * 8].reshape(j - i, self.low)
        return (flat.astype(np.int64) << np.arange(self.low)).sum(1)

    def decode(self) -> np.ndarray:
        """All values."""
        if not self.n:
            return np.empty(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little", count=self.high_bits))
        return ((ones - np.arange(self.n)) << self.low) | _unpack(self.lows, self.low, self.n).astype(np.int64)
