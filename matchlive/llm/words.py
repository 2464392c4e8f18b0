"""Words of whole texts as numpy arrays: where they begin and end, and a 64-bit hash of each."""

import ctypes
from collections.abc import Iterator
from contextlib import suppress
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of text handled at once, unless one text alone is longer.
CHUNK_BYTES = 1 << 20
#: Bytes of words hashed at once.
HASH_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64)."""
    x = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random number for each byte at each of 64 places of a word.
BYTE_AT = mix(np.arange(64 * 256, dtype=np.uint64))


class Words(NamedTuple):
    """Words of a run of documents; ``first`` has one entry more than there are documents."""

    bytes: np.ndarray
    offsets: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def hashes(self) -> np.ndarray:
        """Equal words have equal hashes; others differ but for chance of 2**-64."""
        out = np.empty(len(self.start), np.uint64)
        length = self.end - self.start
        total = np.concatenate(([0], np.cumsum(length)))
        for low, high in self._groups(length, total):
            size, begin = length[low:high], total[low:high] - total[low]
            place = np.arange(total[high] - total[low]) - np.repeat(begin, size)
            data = self.bytes[place + np.repeat(self.start[low:high], size)]
            term = BYTE_AT[((place & 63) << 8) | data]
            if size.max() > 64:
                term = term * np.power(np.uint64(0x9E3779B97F4A7C15), (place >> 6).astype(np.uint64))
            out[low:high] = np.add.reduceat(term, begin)
        return mix(out + length.astype(np.uint64))

    def _groups(self, length: np.ndarray, total: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words of about HASH_BYTES together."""
        low = 0
        while low < len(length):
            high = max(low + 1, int(np.searchsorted(total, total[low] + HASH_BYTES, "right")) - 1)
            yield low, high
            low = high

    def spaced(self, keep: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The words kept, each followed by one space, and where each document begins in that."""
        start, size = self.start[keep], (self.end - self.start)[keep]
        total = np.concatenate(([0], np.cumsum(size + 1)))
        out = np.full(total[-1], 0x20, np.uint8)
        for low, high in self._groups(size, total):
            length = size[low:high]
            begin = np.cumsum(length) - length
            place = np.arange(length.sum()) - np.repeat(begin, length)
            out[place + np.repeat(total[low:high], length)] = self.bytes[place + np.repeat(start[low:high], length)]
        before = np.concatenate(([0], np.cumsum(keep)))
        return out.tobytes(), total[before[self.first]]

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    flat = np.frombuffer(data, np.uint8, high - low, low) if high > low else np.zeros(0, np.uint8)
    return flat, offsets - low


def split(flat: np.ndarray, offsets: np.ndarray) -> Words:
    space = SPACES[flat]
    starts, ends = ~space, ~space
    starts[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    begun = offsets[:-1][np.diff(offsets) > 0]
    starts[begun] = ~space[begun]
    over = offsets[1:][np.diff(offsets) > 0] - 1
    ends[over] = ~space[over]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(flat, offsets, np.searchsorted(start, offsets), start, end)


def release() -> None:
    """Gives memory that is free again back to the system; a worker that waits for its next task keeps none."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) over runs of documents of about ``most`` bytes."""
    low = 0
    flat, offsets = string_buffers(texts)
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        at = offsets[low : high + 1]
        yield low, high, split(flat[at[0] : at[-1]], at - at[0])
        low = high
    release()


def windows(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of every ``size`` consecutive words, documents not regarded."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    odd = np.uint64(int(mix(np.array([seed + 77], np.uint64))[0]) | 1)
    values = mix(hashes + np.uint64(seed))
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for place in range(size) if size <= 4 else ():
        out = out * odd + values[place : place + len(out)]
    if size > 4:
        out = _rolled(values, size, odd)
    return mix(out)


def _rolled(values: np.ndarray, size: int, odd: np.uint64) -> np.ndarray:
    """sum(values[i + j] * odd**j for j < size), from running sums in blocks of fixed length."""
    block = 1 << 16
    inverse = np.uint64(pow(int(odd), -1, 1 << 64))
    power, back = _powers(odd, block + size), _powers(inverse, block)
    out = np.empty(len(values) - size + 1, np.uint64)
    for low in range(0, len(out), block):
        part = values[low : low + block + size - 1]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * power[: len(part)])))
        count = len(part) - size + 1
        out[low : low + count] = (sums[size:] - sums[:count]) * back[:count]
    return out


def _powers(base: np.uint64, count: int) -> np.ndarray:
    factors = np.full(count, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)
