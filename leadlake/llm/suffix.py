"""Substring dedup over bytes with suffix arrays built by external induced sorting.

A suffix array of one shard finds no match in another, so text is first routed: the anchor of a string is the least
hashed gram of about two thirds of its length in it. Equal strings have equal anchors and go to one shard. Anchors that occur once go
nowhere; equal pieces (what the strings of an anchor cover) are counted, not sent again. Each shard concatenates its
pieces, sorts the suffixes by external induction (``induction``), and a string is repeated where the common prefix with a
neighbour reaches its length.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from leadlake.llm.induction import Run, suffix_order, zeros
from leadlake.llm.repeats import BATCH_BYTES, DENSE, KINDS, OPEN, Occurrences, contexts, cut
from leadlake.llm.words import BYTE_VALUES, Rolling, flat_bytes, gather, per_text, runs, spin, spread

SECOND = spin(BYTE_VALUES)
#: Rows that a run, a queue and a chunk of a shard's sort hold in memory; a usual shard has several times as many.
MEMORY_ROWS = 1 << 18
BARRIER = 1  # between pieces; a byte b is the symbol b + 2, and 0 ends the shard


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from running minima inside blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


class LeastGram:
    """The anchor of a string of ``window`` bytes is the least hashed gram in it: equal strings have equal anchors."""

    def __init__(self, window: int = 400, memory_rows: int = MEMORY_ROWS):
        self.window = window
        self.gram = window * 13 // 20  # longer ones send less text that shares a gram but no string, shorter ones make longer pieces
        self.offsets = window - self.gram + 1  # of the anchor in a string
        self.memory_rows = memory_rows

    def occurrences(self, texts: pa.Array) -> Occurrences:
        raw, offsets = flat_bytes(texts)
        rolling = Rolling(BYTE_VALUES[raw]), Rolling(SECOND[raw])
        n = len(raw)
        if n < self.window:
            none = np.zeros(0, np.int64)
            return Occurrences(none.view(np.uint64), none.view(np.uint64), none, none, rolling, self.window)
        grams = rolling[0].everywhere(self.gram)
        place = np.uint64((1 << int(n).bit_length()) - 1)
        least = window_minimum(grams & ~place | np.arange(len(grams), dtype=np.uint64), self.window - self.gram + 1)
        anchor = (least & place).astype(np.int64)  # of the string that starts here, the leftmost of equals
        ends = np.repeat(offsets[1:], np.diff(offsets))
        inside = np.arange(len(anchor)) + self.window <= ends[: len(anchor)]
        anchor[~inside] = -1
        change = np.flatnonzero(np.diff(anchor)) + 1
        low, high = np.append(0, change), np.append(change - 1, len(anchor) - 1)
        valid = anchor[low] >= 0
        low, high = low[valid], high[valid]
        # Two texts' runs can only touch where a text ends, and there no string starts.
        at = anchor[low]
        return Occurrences(grams[at], contexts(rolling[1], low, high, at, self.window), low, high, rolling, self.window)

    def pieces(self, texts: pa.Array, found: Occurrences, chosen: np.ndarray) -> pa.Array:
        """The bytes that the strings of the chosen occurrences cover."""
        raw, _ = flat_bytes(texts)
        starts, sizes = found.low[chosen], found.high[chosen] - found.low[chosen] + self.window
        offsets = np.append(0, np.cumsum(sizes)).astype(np.int64)
        data = gather(raw, starts, sizes)
        return pa.Array.from_buffers(pa.large_binary(), len(chosen), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())

    def repeated(self, text: np.ndarray, folder: str) -> np.ndarray:
        """At which positions of a shard a string starts that also starts elsewhere in it."""
        flags, above = zeros(len(text), bool, folder, self.memory_rows), [0]

        def mark(at: np.ndarray, lcp: np.ndarray) -> None:
            if len(at):
                long = lcp >= self.window
                flags[at[long]] = True
                flags[np.append(above[0], at[:-1])[long]] = True
                above[0] = at[-1]

        suffix_order(text, 258, folder, mark, self.memory_rows)
        return flags

    def sorter(self, scratch: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Sorts one shard, a partition; its files lie in the shared folder, or where that is no mounted one, in Spark's own local folders."""
        names = ["_batch", "x", "y", "kind", "bits"]

        def marks(batch: np.ndarray, x: np.ndarray, y: np.ndarray, kind: int, bits: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(batch), pa.array(x), pa.array(y), pa.array(np.full(len(x), kind, np.int32)), pa.array(bits)], names=names)

        def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with tempfile.TemporaryDirectory(dir=scratch_folder(scratch)) as folder:
                text, heads, length = Run(folder, 1, self.memory_rows), [], 0
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    x, y, tag = (batch.column(k).to_numpy() for k in range(3))
                    raw, offsets = flat_bytes(batch.column(3))
                    symbols = np.insert(raw.astype(np.int32) + 2, offsets[1:], BARRIER)
                    text.append(symbols)
                    place = length + offsets[:-1] + np.arange(len(offsets) - 1)
                    heads.append(np.stack([tag, x, y, place, np.diff(offsets)]))
                    length += len(symbols)
                text.append(np.zeros(1, np.int32))
                if heads:
                    tag, x, y, place, size = np.concatenate(heads, axis=1)
                    again = self.repeated(text.read()[:, 0], folder)
                    for first in range(0, self.offsets, 64):  # a row for every 64 strings of a piece, one bit each
                        bits = np.zeros(len(tag), np.uint64)
                        for k in range(first, min(first + 64, self.offsets)):
                            starts = k <= size - self.window
                            bits[starts] |= again[place[starts] + k].astype(np.uint64) << np.uint64(k - first)
                        asked = (tag % 2 == 0) & (bits > 0)
                        yield marks(tag[asked] >> 1, x[asked], y[asked], OPEN + KINDS * (first // 64), bits[asked].view(np.int64))

        return sort

    def finish(self, texts: pa.Array, repeated: np.ndarray) -> list[pa.Array]:
        raw, offsets = flat_bytes(texts)
        removed = spread(repeated, self.window, len(raw))
        n_removed = per_text(removed, offsets)
        starts, _ = runs(removed, offsets)
        n_spans = np.bincount(np.searchsorted(offsets, starts, "right") - 1, minlength=len(offsets) - 1)
        kept_offsets = np.zeros(len(offsets), np.int64)
        np.cumsum(np.diff(offsets) - n_removed, out=kept_offsets[1:])
        kept = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(kept_offsets), pa.py_buffer(raw[~removed])]).cast(pa.binary())
        return [pa.array(np.diff(offsets), pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), kept]


def scratch_folder(shared: str) -> str:
    """A folder for a task's own files; a task that is run again starts with new ones."""
    scheme, _, path = shared.rpartition(":")
    if scheme not in ("", "file"):
        path = os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")[0]
    path = "/" + path.lstrip("/")
    os.makedirs(path, exist_ok=True)
    return path


FIELDS = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())]


def dedup_bytes(docs: DataFrame, text_col: str = "text", window: int = 400, batch_bytes: int = BATCH_BYTES, keep_text: bool = True, memory_rows: int = MEMORY_ROWS, dense: int = DENSE) -> DataFrame:
    """``docs`` (without the text unless ``keep_text``) plus n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary), replacing columns of those names.

    Every UTF-8 byte covered by a string of ``window`` bytes that also starts anywhere else, the same text included, is
    removed; strings never cross texts and are judged on the input. A null text is empty; shorter texts lose nothing;
    repeated rows remove each other's strings and stay as rows; extra columns pass through; an empty table gives an empty
    table. ``kept`` may cut inside a character and is therefore binary. A shard keeps up to ``memory_rows`` queue rows in
    memory; an anchor with more than ``dense`` different pieces is compared string by string, by 128-bit hashes.
    """
    return cut(docs, text_col, LeastGram(window, memory_rows), FIELDS, batch_bytes, keep_text, dense)
