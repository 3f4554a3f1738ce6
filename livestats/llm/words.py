"""Words of a batch of texts as 64-bit hashes, computed on the UTF-8 bytes of an Arrow array."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLACES = 64
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
#: The first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_table(fold: bool) -> np.ndarray:
    """A random number for each byte at each place of a word; white space counts nothing."""
    table = mix(np.arange(1, 256 * _PLACES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    table = table.reshape(256, _PLACES)
    if fold:
        table[65:91] = table[97:123]
    table[_SPACE] = 0
    return table.ravel()


_TABLES = {fold: _byte_table(fold) for fold in (False, True)}


@dataclass
class Words:
    """Words of all texts in a row: ``data[starts[i]:ends[i]]``; ``counts`` has their number in each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray

    def hashes(self, fold: bool = True) -> np.ndarray:
        """A hash of each word; with ``fold`` A-Z count as a-z."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        first, last = int(self.starts[0]), int(self.ends[-1])
        place = np.arange(first, last, dtype=np.int64)
        place -= np.repeat(self.starts, np.diff(self.starts, append=last))
        value = _TABLES[fold][self.data[first:last].astype(np.int32) * _PLACES + (place & (_PLACES - 1))]
        if int((self.ends - self.starts).max()) > _PLACES:
            value = value * ((place >> 6) * 2 + 1).astype(np.uint64)
        return mix(np.add.reduceat(value, self.starts - first) + (self.ends - self.starts).astype(np.uint64))

    def keys(self) -> np.ndarray:
        """A hash of each word, of eight bytes at a time; A-Z count as a-z."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        data = np.zeros(len(self.data) + 8, np.uint8)
        data[:-8] = self.data
        data += ((data - np.uint8(65)) < 26).view(np.uint8) << 5
        eight = np.ndarray(len(self.data) + 1, "<u8", data, strides=(1,))  # the eight bytes from each place on
        n = self.ends - self.starts
        out = mix(eight[self.starts] & _FIRST[np.minimum(n, 8)])
        long = np.flatnonzero(n > 8)
        if len(long):  # eights after the first, each mixed with its number
            more = (n[long] - 1) >> 3
            begin = np.cumsum(more) - more
            number = np.arange(int(more.sum())) - np.repeat(begin, more) + 1
            left = np.repeat(n[long], more) - 8 * number
            value = eight[np.repeat(self.starts[long], more) + 8 * number] & _FIRST[np.minimum(left, 8)]
            out[long] += np.add.reduceat(mix(mix(value + _FACTORS[0]) ^ number.astype(np.uint64) * _FACTORS[1]), begin)
        return mix(out + n.astype(np.uint64) * _FACTORS[0])


def words(texts: pa.Array) -> Words:
    """Maximal runs of bytes other than space, tab, line feed, vertical tab, form feed, return."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[lo:hi] if raw is not None and hi > lo else np.empty(0, np.uint8)
    ends_of = offsets[1:] - lo
    starts_of = offsets[:-1] - lo
    letter = ((data - np.uint8(9)) > 4) & (data != 32)
    edge = np.zeros(len(data) + 1, bool)
    edge[starts_of] = True
    edge[-1] = True
    start = letter.copy()
    start[1:] &= ~letter[:-1] | edge[1:-1]
    end = letter
    end[:-1] &= ~letter[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    counts = np.searchsorted(starts, ends_of) - np.searchsorted(starts, starts_of)
    return Words(data, starts, ends, counts)
