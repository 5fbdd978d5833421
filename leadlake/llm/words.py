"""Vectorised word handling over one Arrow batch of texts.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 this equals the same rule on code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def flat_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, n + 1 offsets) of a string or binary array; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # several chunks too large for one array never occur under the batch bound
        texts = pa.concat_arrays(texts.chunks)
    arr = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64, count=len(arr) + 1 + arr.offset)[arr.offset :]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def portions(texts: pa.Array, n_bytes: int = 1 << 20) -> Iterator[pa.Array]:
    """Slices of a batch of about ``n_bytes`` each, so that arrays derived from one stay small."""
    _, offsets = flat_bytes(texts)
    cuts = np.unique(np.append(np.searchsorted(offsets[:-1], np.arange(0, offsets[-1] + 1, n_bytes)), len(texts)))
    for a, b in zip(np.append(0, cuts[cuts > 0])[:-1], cuts[cuts > 0], strict=True):
        yield texts.slice(int(a), int(b - a))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that don't cross an offset."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    before[edges] = False
    after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def gather(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of the given slices, one after the other."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return raw[np.arange(out[-1]) + np.repeat(starts - out[:-1], lengths)]


def codes_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Dictionary codes of the given slices, and the dictionary of distinct byte strings."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    data = gather(raw, starts, lengths)
    values = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


class Words:
    """Words of every text of a batch: byte positions, owning text and per-text ranges."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, lower: bool = False):
        self.raw, self.offsets = flat_bytes(texts)
        if lower:
            upper = (self.raw >= 65) & (self.raw <= 90)
            self.raw = self.raw + upper.astype(np.uint8) * 32
        self.n = len(self.offsets) - 1
        self.starts, self.ends = runs(~SEPARATOR[self.raw], self.offsets)
        self.first = np.searchsorted(self.starts, self.offsets)  # word range of text i: first[i]..first[i + 1]
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(self.n), self.counts)

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        return codes_of(self.raw, self.starts, self.ends)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same in every batch."""
        lengths = self.ends - self.starts
        return spin(Rolling(BYTE_VALUES[self.raw]).at(self.starts, lengths) ^ lengths.astype(np.uint64))


def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each range first[i]..first[i + 1]."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def spread(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """True at each of n positions that one of the ranges of ``width`` from the ascending starts covers."""
    out = np.zeros(n, bool)
    cut = np.flatnonzero(np.diff(starts) > width) + 1  # ranges before and after don't touch
    for a, b in zip(starts[np.append(0, cut)].tolist() if len(starts) else [], (starts[np.append(cut - 1, -1)] + width).tolist() if len(starts) else [], strict=True):
        out[a:b] = True
    return out


BASE = 0x9E3779B97F4A7C15
BYTE_VALUES = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64, kept for later batches."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            row = np.full(max(n, 1 << 20), base, np.uint64)
            row[0] = 1
            _powers[k] = np.multiply.accumulate(row)
    return [p[:n] for p in _powers]


def spin(h: np.ndarray) -> np.ndarray:
    """Mixes the bits of 64-bit values; one to one."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


class Rolling:
    """Polynomial hashes modulo 2**64 of every window of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        power, self.inverse = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values * power[:n], out=self.sums[1:])

    def at(self, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return spin((self.sums[starts + length] - self.sums[starts]) * self.inverse[starts])

    def everywhere(self, length: int) -> np.ndarray:
        """The hash of every window of one length."""
        n = len(self.sums) - length
        with np.errstate(over="ignore"):
            return spin((self.sums[length:] - self.sums[:n]) * self.inverse[:n])
