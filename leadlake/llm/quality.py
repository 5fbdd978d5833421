"""Quality rules: base counts and zstandard compression bands over whole documents and fixed chunks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.session import bound_arrow_batches
from leadlake.llm.words import Words, codes_of, flat_bytes, per_text, portions, runs

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class Bands:
    """Limits of compressed/raw size by length. ``whole``: (bytes below, least, most) in ascending order; a ratio under
    the least is repetitive, over the most incompressible. Chunks are ``chunk`` bytes long, a rest of at least half that
    counts too; a text whose share of chunks outside ``chunk_band`` is over ``chunk_share`` is rejected.

    The most lies under the least that noise measures at the upper end of its length (base64 words and lines, printable
    ASCII, random CJK: 0.82 at 511 bytes, 0.76 at 1000, 0.73 at 2047, 0.72 at 4096, then down to 0.71) and over prose
    (sf0.1, four languages: at most 0.75, 0.70, 0.60, 0.53, then 0.48). It is no lower, because CJK prose is dense: characters
    drawn one by one by Zipf's law, an upper bound, measure up to 0.69 from 4096 bytes. Below that they overlap noise, so
    short CJK text may be rejected; hex digits (0.51 to 0.59) are not. The least lies under prose in scripts of three bytes
    a letter (sf0.1 in Georgian, Devanagari, Thai: 0.30 below 1024 bytes, 0.27, 0.25, then 0.21) and over lines filled from
    a template (0.17 at 2000 bytes, 0.16 from 4096)."""

    #: (script, length class) -> least ratio, where ``fit_bands`` had enough good texts; it counts if it is over ``whole``'s.
    fitted: tuple[tuple[int, int, float], ...] = ()
    whole: tuple[tuple[float, float, float], ...] = ((512, 0.25, 0.80), (1024, 0.24, 0.75), (2048, 0.22, 0.72), (4096, 0.20, 0.71), (float("inf"), 0.17, 0.69))
    chunk: int = 4096
    chunk_band: tuple[float, float] = (0.18, 0.70)
    chunk_share: float = 0.2
    level: int = 3

    def limits(self, script: np.ndarray, n_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) ratio of texts of the given scripts and lengths."""
        below = np.array([b for b, _, _ in self.whole])
        band = np.searchsorted(below, n_bytes, "right")
        least, most = (np.array([w[k] for w in self.whole])[band] for k in (1, 2))
        table = np.zeros((4, len(LENGTHS) + 1))
        for s, c, limit in self.fitted:
            table[s, c] = limit
        return np.maximum(least, table[script, np.searchsorted(LENGTHS, n_bytes, "right")]), most


#: Length classes of fitted limits, in bytes: up to 4096 two or three to a doubling.
LENGTHS = (256, 320, 384, 448, 512, 640, 768, 896, 1024, 1280, 1536, 1792, 2048, 2560, 3072, 3584, 4096, 5120, 6144, 8192, 12_288, 16_384, 32_768, 65_536, 131_072)
#: Limits are fitted in classes that hold at least so many texts labelled good, as this quantile of their ratios less a margin.
FIT_LEAST, FIT_SHARE, FIT_MARGIN = 50, 0.005, 0.004


def script_of(raw: np.ndarray) -> int:
    """1, 2 or 3: about how many bytes a character has, by which scripts of unlike density are told apart."""
    n = int(((raw & 0xC0) != 0x80).sum())
    per = len(raw) / max(n, 1)
    return 1 if per < 1.4 else 2 if per < 2.3 else 3


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = f"struct<{', '.join(f'{c}: bigint' for c in COUNTS)}, ratio: double, n_chunks: bigint, n_bad_chunks: bigint, script: int, in_band: boolean>"


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The five base counts of each text of a batch, exact and without a loop over words."""
    w = Words(texts)
    raw, offsets = w.raw, w.offsets
    inside = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=inside[1:])  # code points begun
    word_chars = np.zeros(w.n, np.int64)
    np.add.at(word_chars, w.text, inside[w.ends] - inside[w.starts])
    # Lines: split at \n, those with a word, minus the distinct ones of the same text.
    starts, ends = runs(raw != 0x0A, offsets)
    with_word = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[with_word], ends[with_word]
    line_text = np.searchsorted(offsets, starts, "right") - 1
    codes, _ = codes_of(raw, starts, ends)
    both = line_text * (int(codes.max(initial=0)) + 1) + codes
    n_dup = np.bincount(line_text, minlength=w.n) - np.bincount(line_text[np.unique(both, return_index=True)[1]], minlength=w.n)
    # 3-word windows found twice or more in their text.
    codes, _ = w.codes()
    at = np.flatnonzero(w.text[:-2] == w.text[2:]) if len(codes) > 2 else np.zeros(0, np.int64)
    ids = codes.astype(np.int64)
    pair = np.unique(ids[at] * (ids.max(initial=0) + 1) + ids[at + 1], return_inverse=True)[1].astype(np.int64)
    triple = np.unique(pair * (ids.max(initial=0) + 1) + ids[at + 2], return_inverse=True)[1].astype(np.int64)
    _, inverse, times = np.unique(triple * max(w.n, 1) + w.text[at], return_inverse=True, return_counts=True)
    again = at[times[inverse] > 1]
    repeated = np.zeros(len(codes), bool)
    for k in range(3):
        repeated[again + k] = True
    return {"n_words": w.counts, "word_chars": word_chars, "n_symbols": per_text(SYMBOLS[raw], offsets), "n_dup_lines": n_dup, "n_repeat_words": per_text(repeated, w.first)}


def compression(raw: bytes, compressor, bands: Bands, chunk_least: float) -> tuple[float | None, int, int]:
    """(whole ratio, chunks, chunks outside the band); an empty text has no ratio."""
    if not raw:
        return None, 0, 0
    whole = len(compressor.compress(raw)) / len(raw)
    if len(raw) <= bands.chunk:
        return whole, 0, 0
    low, high = chunk_least, bands.chunk_band[1]
    parts = [raw[i : i + bands.chunk] for i in range(0, len(raw), bands.chunk)]
    if len(parts[-1]) * 2 < bands.chunk:
        parts.pop()
    ratios = [len(compressor.compress(p)) / len(p) for p in parts]
    return whole, len(ratios), sum(not low <= r <= high for r in ratios)


def measure_column(text: Column, bands: Bands, in_place: bool = False) -> Column:
    """The measures of a text as a struct; ``in_place`` keeps Catalyst from measuring before a join or twice."""

    @F.arrow_udf(SCHEMA)
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            parts = [base_counts(part) for part in portions(batch)] or [base_counts(batch)]
            counts = {c: np.concatenate([p[c] for p in parts]) for c in COUNTS}
            raw, offsets = flat_bytes(batch)
            spans = list(zip(offsets[:-1], offsets[1:], strict=True))
            script = np.array([script_of(raw[a:b]) for a, b in spans], np.int64)
            # A chunk is judged as a text of its length, if limits were fitted for that, with room for what varies inside a text.
            chunk_least = np.maximum(bands.chunk_band[0], 0.9 * bands.limits(script, np.full(len(script), bands.chunk - 1))[0] if bands.fitted else 0.0)
            found = [compression(raw[a:b].tobytes(), compressor, bands, float(low)) for (a, b), low in zip(spans, chunk_least + np.zeros(len(spans)), strict=True)]
            ratio = np.array([np.nan if x[0] is None else x[0] for x in found], float)
            least, most = bands.limits(script, np.diff(offsets))
            rest = [pa.array([x[0] for x in found], pa.float64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64()), pa.array(script, pa.int32()), pa.array((ratio >= least) & (ratio <= most))]
            yield pa.StructArray.from_arrays([*(pa.array(counts[c], pa.int64()) for c in COUNTS), *rest], [*COUNTS, "ratio", "n_chunks", "n_bad_chunks", "script", "in_band"])

    return (measure.asNondeterministic() if in_place else measure)(text)


def base_failed(q: Column) -> Column:
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def fit_bands(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", bands: Bands = Bands(), most: int | None = None) -> Bands:
    """``bands`` with the least ratio of each script and length class taken from all texts labelled good: the ``FIT_SHARE`` quantile of those
    that pass the base rule, less ``FIT_MARGIN``, where at least ``FIT_LEAST`` are known; elsewhere the general limits stay.

    Texts are measured where they lie, and only the measures meet the labels, so no text is shuffled. Quantiles come from the counts of
    the ratios, rounded to four digits. An id labelled more than once counts once, one given more than once as often; null ids and
    labels don't count; without labels the bands stay as they are. ``most`` restricts the fit to the good labels with the least hashed ids."""
    bound_arrow_batches(docs.sparkSession)
    good = labels.select(labels[f"`{id_col}`"].alias("_id"), labels[f"`{label_col}`"].alias("_label")).filter("_id is not null and _label = 1").select("_id")
    good = (good if most is None else good.orderBy(F.xxhash64("_id"), "_id").limit(most)).distinct()
    texts = docs.select(docs[f"`{id_col}`"].alias("_id"), docs[f"`{text_col}`"].cast("string").alias("_text")).filter("_id is not null")
    measured = texts.select("_id", F.octet_length("_text").alias("n"), measure_column(F.col("_text"), bands, True).alias("q")).filter(~base_failed(F.col("q")))
    kind = F.lit(0)
    for edge in LENGTHS:
        kind = kind + (F.col("n") >= edge).cast("int")
    narrow = measured.select("_id", F.col("q.script").alias("script"), kind.alias("kind"), F.round("q.ratio", 4).alias("ratio"))
    counts = narrow.join(good, "_id", "left_semi").groupBy("script", "kind", "ratio").agg(F.count("*").alias("n"))
    cells = counts.groupBy("script", "kind").agg(F.sum("n").alias("n"), F.percentile("ratio", FIT_SHARE, F.col("n")).alias("low")).collect()  # a row per script and class
    return replace(bands, fitted=tuple(sorted((r.script, r.kind, r.low - FIT_MARGIN) for r in cells if r.n >= FIT_LEAST)))


def quality(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """``docs`` plus the base counts, ratio, n_chunks, n_bad_chunks, base_failed and kept, replacing columns of those names.

    base_failed: under 50 words, or over half of the words in a repeated 3-word window. kept: not base_failed, the whole
    ratio within the limits of its script and length and at most ``chunk_share`` of the chunks outside the chunk band. A null or empty
    text has no words and fails; a text of any length is judged whole, its chunks one after the other. Rows are judged on their own: ties and repeated rows get equal verdicts, extra columns
    pass through, an empty table gives an empty table. One map without a shuffle.
    """
    bound_arrow_batches(docs.sparkSession)
    new = (*COUNTS, "ratio", "n_chunks", "n_bad_chunks", "base_failed", "kept")
    rest = [docs[f"`{c}`"] for c in docs.columns if c not in new]
    measured = docs.select(*rest, measure_column(docs[f"`{text_col}`"].cast("string"), bands).alias("_leadlake_q"))
    q = F.col("_leadlake_q")
    failed = base_failed(q)
    good = q["in_band"] & (q["n_bad_chunks"] <= bands.chunk_share * q["n_chunks"])
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    return measured.select(*kept, *(q[c].alias(c) for c in new[:-2]), failed.alias("base_failed"), (~failed & good).alias("kept"))
