"""Monotone sequences in Elias-Fano form, and n-gram tries made of them."""

import struct

import numpy as np


class Reader:
    def __init__(self, buffer):
        self.buffer, self.at = buffer, 0

    def number(self, kind="<Q"):
        value, = struct.unpack_from(kind, self.buffer, self.at)
        self.at += struct.calcsize(kind)
        return value

    def array(self, kind):
        n = self.number()
        out = np.frombuffer(self.buffer, dtype=kind, count=n, offset=self.at)
        self.at += out.nbytes
        return out


def framed(array):
    return struct.pack("<Q", len(array)) + np.ascontiguousarray(array).tobytes()


class EliasFano:
    """n non-decreasing numbers below a bound: the low bits of each side by side, the high parts in unary.

    Takes about 2 + log2(bound / n) bits a number. ``first[h]`` is the number of values whose high part
    is below h; it is rebuilt from the unary bits when a sequence is opened.
    """

    @staticmethod
    def pack(values):
        values = values.astype(np.uint64)
        n, bound = len(values), int(values[-1]) + 1 if len(values) else 1
        width = max(0, (bound // max(n, 1)).bit_length() - 1)
        low = values & np.uint64((1 << width) - 1)
        if width:
            shifts = np.arange(width, dtype=np.uint64)
            parts = [np.packbits((low[i:i + 65536, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
                     for i in range(0, n, 65536)]  # 65536 numbers fill whole bytes
            low = np.concatenate([*parts, np.zeros(16, np.uint8)]) if n else np.zeros(16, np.uint8)
            low = low[:len(low) // 8 * 8]
        else:
            low = np.zeros(0, np.uint8)
        high = (values >> np.uint64(width)).astype(np.int64)
        bits = np.zeros(n + (int(high[-1]) if n else 0) + 1, dtype=bool)
        bits[high + np.arange(n)] = True
        return struct.pack("<QQ", n, width) + framed(low) + framed(np.packbits(bits, bitorder="little"))

    def __init__(self, reader):
        self.n, self.width = reader.number(), reader.number()
        self.low = reader.array(np.uint8).view("<u8")
        bits = np.unpackbits(reader.array(np.uint8), bitorder="little")
        ones = np.flatnonzero(bits)[:self.n]
        high = ones - np.arange(self.n)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(high, minlength=1))]) if self.n else np.zeros(1, np.int64)
        self.mask = np.uint64((1 << self.width) - 1)

    def lows(self, i):
        if not self.width:
            return np.zeros(len(i), dtype=np.uint64)
        bit = i * self.width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        up = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (self.low[word] >> shift | up) & self.mask

    def at(self, i):
        """Values at places i."""
        high = np.searchsorted(self.first, i, side="right") - 1
        return high.astype(np.uint64) << np.uint64(self.width) | self.lows(i)

    def successor(self, x):
        """Place of the first value that is at least x; n if there is none."""
        high = (x >> np.uint64(self.width)).astype(np.int64)
        low, top = x & self.mask, len(self.first) - 1
        beyond = high >= top
        a = self.first[np.minimum(high, top)].copy()
        b = self.first[np.minimum(high + 1, top)].copy()
        open_ = np.flatnonzero((a < b) & ~beyond)
        while len(open_):
            middle = (a[open_] + b[open_]) >> 1
            less = self.lows(middle) < low[open_]
            a[open_[less]] = middle[less] + 1
            b[open_[~less]] = middle[~less]
            open_ = open_[a[open_] < b[open_]]
        return np.where(beyond, self.n, a)


def quantise(values):
    """Least value, step and a code of 8 bits for each value."""
    low, high = (float(values.min()), float(values.max())) if len(values) else (0.0, 0.0)
    step = (high - low) / 255 or 1.0
    return struct.pack("<dd", low, step) + framed(np.rint((values - low) / step).astype(np.uint8))


class Codes:
    def __init__(self, reader):
        self.low, self.step = reader.number("<d"), reader.number("<d")
        self.codes = reader.array(np.uint8)

    def at(self, i):
        return self.low + self.step * self.codes[i]


class Level:
    """Children of the nodes above: a pointer per node to its first child, and the children's names.

    Names ascend within a node. They are stored on top of the last name of the node before, which makes
    one monotone sequence of all; a search adds that to the name it looks for.
    """

    @staticmethod
    def pack(parents, names, n_parents, columns):
        starts = np.searchsorted(parents, np.arange(n_parents + 1))
        size = np.diff(starts)
        last = np.where(size > 0, names[np.maximum(starts[1:] - 1, 0)] if len(names) else 0, 0)
        base = np.concatenate([[0], np.cumsum(last)[:-1]]) if n_parents else np.zeros(0, np.int64)
        return (EliasFano.pack(starts) + EliasFano.pack(names + np.repeat(base, size))
                + b"".join(quantise(c) for c in columns))

    def __init__(self, reader, columns):
        self.starts, self.names = EliasFano(reader), EliasFano(reader)
        self.columns = [Codes(reader) for _ in range(columns)]

    def find(self, parents, names):
        """Child of each parent with that name; -1 if there is none, or no parent (-1)."""
        out = np.full(len(parents), -1, dtype=np.int64)
        known = np.flatnonzero(parents >= 0)
        start, end = self.starts.at(parents[known]).astype(np.int64), self.starts.at(parents[known] + 1).astype(np.int64)
        known, start, end = known[start < end], start[start < end], end[start < end]
        base = np.where(start > 0, self.names.at(np.maximum(start - 1, 0)).astype(np.int64), 0)
        x = (base + names[known]).astype(np.uint64)
        place = np.maximum(self.names.successor(x), start)
        inside = place < end
        known, place, x = known[inside], place[inside], x[inside]
        equal = self.names.at(place) == x
        out[known[equal]] = place[equal]
        return out
