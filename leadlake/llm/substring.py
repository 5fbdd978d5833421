"""Substring dedup over words with difference-cover anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from leadlake.llm.repeats import BATCH_BYTES, Occurrences, contexts, cut
from leadlake.llm.words import Rolling, Words, gather, per_text, spin, spread

#: Period -> residues whose differences give every residue of the period (perfect difference sets).
DIFFERENCE_COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}


class DifferenceCover:
    """Grams at the word positions of a text whose residue is in the cover.

    For any two windows some shift below the period puts both on cover positions; a gram of window - period + 1 words
    from there lies inside both. So equal windows share a gram at equal offsets, and only |cover| / period of all
    positions are hashed.
    """

    def __init__(self, window: int = 35):
        self.window = window
        fitting = [p for p in DIFFERENCE_COVERS if 2 * (window - p + 1) >= window - 5 and p <= window]
        self.period = max(fitting, default=1)
        self.cover = np.zeros(self.period, bool)
        self.cover[list(DIFFERENCE_COVERS.get(self.period, (0,)))] = True
        self.gram = window - self.period + 1

    def occurrences(self, texts: pa.Array) -> Occurrences:
        w = Words(texts)
        values = w.hashes()
        rolling = Rolling(values), Rolling(spin(values))
        at = np.arange(len(w.starts))
        first, stop = w.first[:-1][w.text], w.first[1:][w.text]
        at = at[self.cover[(at - first) % self.period] & (at + self.gram <= stop) & (stop - first >= self.window)]
        low = np.maximum(at - (self.period - 1), first[at])
        high = np.minimum(at, stop[at] - self.window)
        return Occurrences(rolling[0].at(at, self.gram), contexts(rolling[1], low, high, at, self.window), low, high, rolling, self.window)

    pieces = None  # windows are compared by their hashes

    def finish(self, texts: pa.Array, repeated: np.ndarray) -> list[pa.Array]:
        w = Words(texts)
        removed = spread(repeated, self.window, len(w.starts))
        left = np.flatnonzero(~removed)
        n_removed = per_text(removed, w.first)
        # The kept words, each after one blank but for the first of its text.
        counts = w.counts - n_removed
        firsts = np.cumsum(counts)[counts > 0] - counts[counts > 0]
        lengths = w.ends[left] - w.starts[left] + 1
        raw = np.append(w.raw, np.uint8(0x20))
        joined = gather(raw, w.starts[left], lengths)
        ends = np.cumsum(lengths)
        joined[ends - 1] = 0x20
        sizes = np.zeros(w.n, np.int64)
        np.add.at(sizes, w.text[left], lengths)
        keep = np.ones(len(joined), bool)
        last = np.append(firsts[1:], len(left)) - 1 if len(firsts) else firsts
        keep[ends[last] - 1] = False  # no blank after a text's last word
        offsets = np.zeros(w.n + 1, np.int64)
        np.cumsum(sizes - (counts > 0), out=offsets[1:])
        kept = pa.Array.from_buffers(pa.large_string(), w.n, [None, pa.py_buffer(offsets), pa.py_buffer(joined[keep])]).cast(pa.string())
        return [pa.array(w.counts, pa.int64()), pa.array(n_removed, pa.int64()), kept]


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]


def dedup_substrings(docs: DataFrame, text_col: str = "text", window: int = 35, batch_bytes: int = BATCH_BYTES, keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text unless ``keep_text``) plus n_words, n_removed and kept_text (the kept words joined by one blank), replacing columns of those names.

    Every word covered by a window of ``window`` consecutive words whose sequence also starts anywhere else, the same
    text included, is removed; windows are judged on the input. Texts shorter than a window lose nothing; a null text has
    no words and an empty kept_text. Repeated rows remove each other's windows and stay as rows; extra columns pass
    through (columns that start with _ and clash with nothing of the input are used inside only); an empty table gives an
    empty table. Words are compared by 64- and 128-bit hashes.
    """
    return cut(docs, text_col, DifferenceCover(window), FIELDS, batch_bytes, keep_text)
