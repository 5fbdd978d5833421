"""Suffix order and common prefixes of a text on disk, by external induced sorting.

The order of all suffixes follows from the order of those at local minima (a suffix smaller than the one before it and
not larger than the one after it). These are named by their stretch of text up to the next one; where names repeat, the
string of names is sorted the same way first (by doubling once it fits memory). Then two scans induce the rest: a suffix taken from a priority queue, in
order, places the suffix one symbol before it. Queue rows are (symbol, position, common prefix with the row placed before
it under the same symbol); the common prefix is one more than the least between the two suffixes that placed them.

Everything that grows with the text is a file in a scratch folder beyond ``memory_rows`` rows: text, minima, names, flags,
queue bins, orders and the per-name state of a scan. All of them are read and written by chunks of ``memory_rows`` rows or
looked up through mapped pages, so what a task holds in memory depends on ``memory_rows`` alone.
"""

from __future__ import annotations

import tempfile
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np

Emit = Callable[[np.ndarray, np.ndarray], None]
FAR = np.iinfo(np.int32).max
NEVER = np.iinfo(np.int64).max
#: Positions are 32-bit; a longer text is refused.
MOST_SYMBOLS = (1 << 31) - 2
#: Queue bins of several keys are at most this share of a text, so that its keys seldom place each other, but not smaller than that.
BIN_SHARE, LEAST_BIN = 256, 1 << 14
COMMON_BLOCK = 1 << 20


class Run:
    """Rows of 32-bit integers, appended to and then read as an array: a mapped file if they are over ``memory_rows``."""

    def __init__(self, folder: str, width: int, memory_rows: int):
        self.folder, self.width, self.memory_rows = folder, width, memory_rows
        self.n, self.n_held, self.held, self.file = 0, 0, [], None

    def append(self, *columns: np.ndarray) -> None:
        self.held.append(np.stack(columns, axis=1).astype(np.int32))
        self.n += len(self.held[-1])
        self.n_held += len(self.held[-1])
        if self.n_held > self.memory_rows:
            self.flush()

    def flush(self) -> None:
        self.file = self.file or tempfile.TemporaryFile(dir=self.folder)
        for rows in self.held:
            rows.tofile(self.file)
        self.file.flush()
        self.held, self.n_held = [], 0

    def read(self) -> np.ndarray:
        """All rows; the file goes with the array."""
        if self.file is None:
            return np.concatenate(self.held) if self.held else np.zeros((0, self.width), np.int32)
        self.flush()
        return np.asarray(np.memmap(self.file, np.int32, "r", shape=(self.n, self.width)))


def zeros(n: int, dtype: type, folder: str, memory_rows: int) -> np.ndarray:
    """An array of zeros: a mapped file if it has over ``memory_rows`` items."""
    return np.zeros(n, dtype) if n <= memory_rows else np.memmap(tempfile.TemporaryFile(dir=folder), dtype, "w+", shape=n)


def slices(n: int, step: int) -> Iterator[slice]:
    return (slice(i, min(i + step, n)) for i in range(0, n, step))


def ordered(key: np.ndarray, below: int) -> np.ndarray:
    """Stable order of keys; short ones are sorted by radix."""
    return np.argsort(key.astype(np.uint16) if below <= 1 << 16 else key, kind="stable")


def cut_bins(text: np.ndarray, sigma: int, folder: str, memory_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First keys of the queue bins of a scan up and of one down. A bin is one frequent key or neighbours that have at most
    ``memory_rows`` rows together."""
    most = max(1, min(memory_rows, max(LEAST_BIN, len(text) // BIN_SHARE)))
    counts = zeros(sigma, np.int32, folder, memory_rows)
    for part in slices(len(text), memory_rows):
        symbols, times = np.unique(text[part], return_counts=True)
        counts[symbols] += times.astype(np.int32)

    def firsts(of: np.ndarray) -> np.ndarray:
        out, total, after_large = [], 0, True
        for part in slices(sigma, max(memory_rows, 1 << 10)):
            n = np.array(of[part], np.int64)
            large = n > most
            level = (total + np.cumsum(np.where(large, 0, n))) // most
            before = np.append(total // most, level[:-1])
            out.append(part.start + np.flatnonzero(large | np.append(after_large, large[:-1]) | (level != before)))
            total, after_large = total + int(n[~large].sum()), bool(large[-1])
        return np.concatenate(out)

    return firsts(counts), firsts(counts[::-1])


class Queue:
    """A priority queue by bins of neighbouring keys: rows (key, position, common prefix) leave a bin in order of arrival.
    Beyond ``memory_rows`` rows all bins go to files, and a file's rows come back before younger ones."""

    def __init__(self, first: np.ndarray, folder: str, memory_rows: int):
        self.first, self.memory_rows = first, memory_rows
        self.stem = Path(folder) / uuid.uuid4().hex
        self.bins: dict[int, list[np.ndarray]] = defaultdict(list)
        self.read: dict[int, int] = {}  # bins with a file: rows that have left it
        self.held = 0

    def path(self, b: int) -> Path:
        return self.stem.with_name(f"{self.stem.name}-{b}")

    def push(self, rows: np.ndarray) -> None:
        """Rows sorted by key."""
        if not len(rows):
            return
        of = np.searchsorted(self.first, rows[:, 0], "right") - 1
        cuts = np.flatnonzero(np.diff(of)) + 1
        for b, part in zip(of[np.append(0, cuts)].tolist(), np.split(rows, cuts), strict=True):
            self.bins[b].append(part)
        self.held += len(rows)
        if self.held > self.memory_rows:
            for b, parts in self.bins.items():
                with self.path(b).open("ab") as file:
                    np.concatenate(parts).tofile(file)
                self.read.setdefault(b, 0)
            self.bins.clear()
            self.held = 0

    def take(self, b: int) -> np.ndarray:
        """The next rows of a bin, up to ``memory_rows`` of them from its file; none if it is empty."""
        if b in self.read:
            rows = np.fromfile(self.path(b), np.int32, 3 * max(self.memory_rows, 1), offset=12 * self.read[b]).reshape(-1, 3)
            self.read[b] += len(rows)
            if len(rows):
                return rows
            self.path(b).unlink()
            del self.read[b]
        parts = self.bins.pop(b, [])
        self.held -= sum(map(len, parts))
        return np.concatenate(parts) if parts else np.zeros((0, 3), np.int32)

    def take_all(self, b: int) -> np.ndarray:
        parts = [np.zeros((0, 3), np.int32)]
        while len(rows := self.take(b)):
            parts.append(rows)
        return np.concatenate(parts)

    def in_order(self, sigma: int) -> Iterator[np.ndarray]:
        """All rows by key, then arrival; a bin of one key needs no sort and is never held whole."""
        for b, low in enumerate(self.first):
            if self.single(b, sigma):
                while len(rows := self.take(b)):
                    yield rows
            else:
                rows = self.take_all(b)
                yield rows[ordered(rows[:, 0] - low, self.end(b, sigma) - low)]

    def end(self, b: int, sigma: int) -> int:
        return int(self.first[b + 1]) if b + 1 < len(self.first) else sigma

    def single(self, b: int, sigma: int) -> bool:
        return self.end(b, sigma) - self.first[b] == 1


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefixes of pairs of different suffixes, compared in growing blocks; the text ends in a symbol of its own."""
    n, active, width, last = np.zeros(len(a), np.int64), np.arange(len(a)), 8, len(text) - 1
    a, b = a.astype(np.int64), b.astype(np.int64)
    while len(active):
        width = max(1, min(width, COMMON_BLOCK // len(active)))
        step = n[active, None] + np.arange(width)
        differ = text[np.minimum(a[active, None] + step, last)] != text[np.minimum(b[active, None] + step, last)]
        some = differ.any(axis=1)
        n[active] += np.where(some, differ.argmax(axis=1), width)
        active = active[~some]
        width = min(2 * width, 256)
    return n


class Least:
    """The least of any inclusive range of an array."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        size = high - low + 1
        level = np.frexp(size.astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int32)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][low[at]], self.levels[k][high[at] - (1 << int(k)) + 1])
        return out


class Prefixes:
    """Per symbol the least common prefix scanned since a suffix was last placed under it."""

    def __init__(self, sigma: int, folder: str, memory_rows: int):
        self.batch = zeros(sigma, np.int32, folder, memory_rows)  # the last batch that placed one, from 1; 0 is none
        self.rest = zeros(sigma, np.int32, folder, memory_rows)
        self.stack: list[tuple[int, int]] = []  # batches whose least no later batch goes below
        self.now = 1

    def place(self, lcp: np.ndarray, at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """For rows of the scanned batch that place suffixes (sorted by key): the common prefixes of those."""
        least = Least(lcp)
        value = np.empty(len(at), np.int32)
        first = np.ones(len(at), bool)
        first[1:] = key[1:] != key[:-1]
        inner = np.flatnonzero(~first)
        value[inner] = least.of(at[inner - 1] + 1, at[inner])
        head = np.flatnonzero(first)
        k = key[head]
        since = np.full(len(head), FAR, np.int32)
        if self.stack:
            batches, minima = (np.array(x) for x in zip(*self.stack, strict=True))
            i = np.searchsorted(batches, self.batch[k], "right")
            since[i < len(batches)] = minima[i[i < len(batches)]]
        value[head] = np.minimum(np.minimum(self.rest[k], since), np.minimum.accumulate(lcp)[at[head]])
        value[head[self.batch[k] == 0]] = -1
        last = np.append(first[1:], True) if len(at) else first
        tail = np.minimum.accumulate(lcp[::-1])[::-1]
        self.rest[key[last]] = np.append(tail, np.int32(FAR))[at[last] + 1]
        self.batch[key[last]] = self.now
        return value + 1

    def scanned(self, lcp: np.ndarray) -> None:
        low = int(lcp.min())
        while self.stack and self.stack[-1][1] >= low:
            self.stack.pop()
        self.stack.append((self.now, low))
        self.now += 1


class Backwards:
    """Rows in reverse, each common prefix moved to the other row of its pair; read by slices."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, part: slice) -> np.ndarray:
        stop = len(self.rows) - part.start
        start = max(0, len(self.rows) - part.stop)
        after = self.rows[start + 1 : stop + 1, 1]
        lcp = np.append(after, np.zeros(stop - start - len(after), np.int32))
        return np.stack([self.rows[start:stop, 0], lcp], axis=1)[::-1]


class Scan:
    """One scan over all suffixes: up, it emits those it places, down, all; as positions and common prefixes.

    ``seeds`` are the suffixes placed by the scan before, in the order of this one. Under one symbol the placed suffixes
    come before the seeds. A bin of one key is scanned by chunks in order of arrival: what it places under its own key
    joins the end of its rows, and its seeds, last, place nothing there. In a bin of several keys a row is scanned
    together with those after it as long as none of them would come after a suffix that the rows before it place.
    """

    def __init__(self, text: np.ndarray, sigma: int, first: np.ndarray, down: bool, folder: str, memory_rows: int, carry: bool, emit: Emit):
        self.text, self.sigma, self.down, self.carry, self.emit, self.memory_rows = text, sigma, down, carry, emit, memory_rows
        self.queue = Queue(first, folder, memory_rows)
        self.prefixes = Prefixes(sigma if carry else 1, folder, memory_rows)
        self.last_code, self.last_at = -2, 0

    def key_of(self, at: np.ndarray) -> np.ndarray:
        symbol = self.text[at].astype(np.int64)
        return self.sigma - 1 - symbol if self.down else symbol

    def columns(self, key: np.ndarray, at: np.ndarray, lcp: np.ndarray, seed: int) -> list[np.ndarray]:
        """Rows as code (twice the key, plus 1 for a seed), position, common prefix and code of the suffix it places."""
        key = key.astype(np.int64)
        before = self.key_of(np.maximum(at - 1, 0))
        places = (at > 0) & ((before > key) | ((before == key) & (seed == 0)))
        return [2 * key + seed, at, lcp, np.where(places, 2 * before, NEVER)]

    def batch(self, code: np.ndarray, pos: np.ndarray, lcp: np.ndarray, next_code: np.ndarray) -> np.ndarray:
        """Emits rows of the final order and returns those that they place, sorted by key."""
        if self.carry:
            previous, previous_at = np.append(self.last_code, code[:-1]), np.append(self.last_at, pos[:-1])
            same = previous >> 1 == code >> 1
            lcp = np.where(same, lcp, 0).astype(np.int32)
            seam = np.flatnonzero(same & (previous < code))
            lcp[seam] = common(self.text, previous_at[seam], pos[seam])
        self.last_code, self.last_at = code[-1], pos[-1]
        own = slice(None) if self.down else code & 1 == 0
        self.emit(pos[own], lcp[own])
        source = np.flatnonzero(next_code < NEVER)
        source = source[ordered(next_code[source] >> 1, self.sigma)]
        key = next_code[source] >> 1
        value = self.prefixes.place(lcp, source, key) if self.carry and len(source) else np.zeros(len(source), np.int32)
        if self.carry:
            self.prefixes.scanned(lcp)
        return np.stack([key, pos[source] - 1, value], axis=1).astype(np.int32)

    def bin_of_several(self, low: int, high: int, parts: list[list[np.ndarray]]) -> None:
        pending = [np.concatenate(c) for c in zip(*parts, strict=True)]
        order = ordered(pending[0] - 2 * low, 2 * (high - low))
        pending = [c[order] for c in pending]
        look, at = 1 << 12, 0
        while at < len(pending[0]):
            code, _, _, next_code = (c[at : at + look] for c in pending)
            m = 1 + int((code[1:] <= np.minimum.accumulate(next_code)[:-1]).sum())
            look = max(1 << 12, 2 * m)
            placed = self.batch(*(c[at : at + m] for c in pending))
            at += m
            here = placed[:, 0] < high
            if here.any():
                new = self.columns(*placed[here].T, 0)
                left = [c[at:] for c in pending]
                where = np.searchsorted(left[0], new[0], "right")
                pending, at = [np.insert(c, where, x) for c, x in zip(left, new, strict=True)], 0
            self.queue.push(placed[~here])

    def run(self, seeds: np.ndarray | Backwards) -> None:
        chunk, key, used, done, size = np.zeros((0, 2), np.int32), np.zeros(0, np.int64), 0, 0, max(self.memory_rows, 1)

        def seeds_below(high: int) -> Iterator[list[np.ndarray]]:
            nonlocal chunk, key, used, done
            while used < len(chunk) or done < len(seeds):
                if used == len(chunk):
                    chunk, used = np.array(seeds[done : done + size]), 0
                    done += len(chunk)
                    key = self.key_of(chunk[:, 0])
                n = int(np.searchsorted(key[used:], high))
                if n:
                    part = slice(used, used + n)
                    used += n
                    yield self.columns(key[part], chunk[part, 0], chunk[part, 1], 1)
                if used < len(chunk):
                    return

        for b, low in enumerate(self.queue.first.tolist()):
            high = self.queue.end(b, self.sigma)
            if high - low > 1:
                rows = self.queue.take_all(b)
                parts = [self.columns(*rows.T, 0), *seeds_below(high)]
                self.bin_of_several(low, high, parts)
                continue
            while len(rows := self.queue.take(b)):
                self.queue.push(self.batch(*self.columns(*rows.T, 0)))
            for part in seeds_below(high):
                self.queue.push(self.batch(*part))


def minima(text: np.ndarray, folder: str, memory_rows: int) -> np.ndarray:
    """Positions of suffixes smaller than the one before and than the one after, the last position included."""
    n, rising, edge, step = len(text), True, True, max(memory_rows, 2)  # the last suffix, the least of all, counts as smaller than what follows
    falling = Run(folder, 1, memory_rows)
    for stop in range(n - 1, 0, -step):
        start = max(0, stop - step)
        sign = np.sign(np.diff(text[start : stop + 1].astype(np.int64)))  # of start..stop - 1 to the next
        at = np.where(sign != 0, np.arange(len(sign)), len(sign))
        at = np.minimum.accumulate(at[::-1])[::-1]
        up = np.append(sign, 1 if rising else -1)[at] > 0
        types = np.append(up, edge)
        falling.append((start + 1 + np.flatnonzero(types[1:] & ~types[:-1]))[::-1])
        rising = edge = bool(up[0])
    found, down = Run(folder, 1, memory_rows), falling.read()
    for part in slices(len(down), step):
        found.append(down[len(down) - part.stop : len(down) - part.start, 0][::-1])
    return found.read()[:, 0]


def doubled(names: np.ndarray) -> np.ndarray:
    """What ``suffix_order`` returns, for a string that fits memory: ranks of prefixes of doubling length."""
    rank, width = names.astype(np.int64), 1
    while True:
        ahead = np.zeros_like(rank)
        ahead[:-width] = rank[width:] + 1
        code = rank * (len(rank) + 2) + ahead
        order = np.argsort(code, kind="stable")
        new = np.append(0, np.cumsum(np.diff(code[order]) != 0))
        rank[order] = new
        if new[-1] == len(rank) - 1:
            break
        width *= 2
    down = order[:0:-1]
    lcp = np.zeros(len(down), np.int64)
    lcp[1:] = common(names, down[:-1], down[1:])
    return np.stack([down, lcp], axis=1)


def by_first_symbol(text: np.ndarray, sigma: int, first: np.ndarray, least: np.ndarray, folder: str, memory_rows: int) -> np.ndarray:
    """Positions by their symbol, each with a common prefix of 0."""
    queue, out = Queue(first, folder, memory_rows), Run(folder, 2, memory_rows)
    for part in slices(len(least), max(memory_rows, 1)):
        at = least[part]
        key = text[at]
        order = ordered(key, sigma)
        queue.push(np.stack([key[order], at[order], np.zeros_like(at)], axis=1).astype(np.int32))
    for rows in queue.in_order(sigma):
        out.append(rows[:, 1], rows[:, 2])
    return out.read()


def suffix_order(text: np.ndarray, sigma: int, folder: str, emit: Emit, memory_rows: int = 1 << 18) -> None:
    """Emits position and common prefix with the one before of all suffixes but the last, from the largest to the smallest.

    The last symbol must be 0 and the only 0. A text of over ``MOST_SYMBOLS`` raises ValueError.
    """
    text = np.asarray(text)
    if len(text) > MOST_SYMBOLS:
        raise ValueError(f"{len(text)} symbols are too many for 32-bit positions")
    step = max(memory_rows, 1)
    up, down = cut_bins(text, sigma, folder, memory_rows)

    def scan(first: np.ndarray, downwards: bool, carry: bool, seeds: np.ndarray | Backwards, emit: Emit) -> None:
        Scan(text, sigma, first, downwards, folder, memory_rows, carry, emit).run(seeds)

    least = minima(text, folder, memory_rows)
    n = len(least)
    # The order of the stretches between minima, from two scans started with the minima by their first symbol.
    falling, every = Run(folder, 2, memory_rows), Run(folder, 1, memory_rows)
    scan(up, False, False, by_first_symbol(text, sigma, up, least, folder, memory_rows), falling.append)
    chosen = zeros(len(text), bool, folder, memory_rows)
    for part in slices(n, step):
        chosen[least[part]] = True
    scan(down, True, False, Backwards(falling.read()), lambda at, _: every.append(at[chosen[at]]))
    rows = every.read()[:, 0]
    ranked = Run(folder, 1, memory_rows)
    ranked.append(least[-1:])
    for part in slices(len(rows), step):
        ranked.append(rows[len(rows) - part.stop : len(rows) - part.start][::-1])
    ranked = ranked.read()[:, 0]
    del rows, every, falling, chosen
    # Equal neighbours get one name.
    names, name, last, last_size = zeros(n, np.int32, folder, memory_rows), -1, 0, -1
    for part in slices(n, step):
        at = ranked[part].astype(np.int64)
        index = np.searchsorted(least, ranked[part])
        size = least[np.minimum(index + 1, n - 1)] - at
        before, before_size = np.append(last, at[:-1]), np.append(last_size, size[:-1])
        equal = np.zeros(len(at), bool)
        active = np.flatnonzero((size == before_size) & (size > 0))
        for k in range(int(size.max(initial=0)) + 1):
            active = active[text[at[active] + k] == text[before[active] + k]]
            over = size[active] == k
            equal[active[over]] = True
            active = active[~over]
            if not len(active):
                break
        given = name + np.cumsum(~equal)
        names[index] = given
        name, last, last_size = int(given[-1]), at[-1], size[-1]
    seeds, deeper = Run(folder, 2, memory_rows), None
    if name + 1 < n and n <= memory_rows:
        deeper = doubled(names)
    elif name + 1 < n:
        deeper = Run(folder, 2, memory_rows)
        suffix_order(names, name + 1, folder, deeper.append, memory_rows)
        deeper = deeper.read()
    # Row i of the deeper order, downwards, carries the common prefix with the row above it.
    last_index = n - 1
    seeds.append(least[-1:], np.zeros(1, np.int32))
    for part in slices(n - 1, step):
        if deeper is None:
            index, held = np.searchsorted(least, ranked[1 + part.start : 1 + part.stop]), 0
        else:
            index = deeper[n - 1 - part.stop : n - 1 - part.start, 0][::-1].astype(np.int64)
            held = np.append(deeper[n - part.stop : n - part.start, 1], [0] * (part.start == 0))[::-1].astype(np.int64)
        above = np.append(last_index, index[:-1])
        prefix = least[index + held] - least[index] + common(text, least[above + held], least[index + held])
        seeds.append(least[index], prefix)
        last_index = index[-1]
    falling = Run(folder, 2, memory_rows)
    scan(up, False, True, seeds.read(), falling.append)
    scan(down, True, True, Backwards(falling.read()), emit)
