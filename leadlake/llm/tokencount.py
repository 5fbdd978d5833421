"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.session import bound_arrow_batches

#: Pieces handed to the library in one call hold about this many bytes of UTF-8.
CALL_BYTES = 1 << 18
#: Texts longer than this many characters are cut at safe boundaries.
SEGMENT_CHARS = 1 << 12
#: One single blank between two word characters. The library puts the word-start mark in front of every piece it is
#: given, so the piece after the cut starts as it does inside the text once the blank is left out.
SAFE_BLANK = re.compile(r"(?<=\w) (?=\w)", re.ASCII)

_processors: dict = {}


def load_processor(model_file: str):
    """The sentencepiece processor, once per worker process, and whether texts may be cut at blanks.

    Cutting is exact if the model keeps texts as they are (identity rule, blanks kept, mark put in front) and no piece
    has the word-start mark after another character: then no merge reaches across a cut.
    """
    if model_file not in _processors:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=model_file)
        mark = "▁"
        bare = all(mark not in p.id_to_piece(i).lstrip(mark) for i in range(p.get_piece_size()))
        probe = p.encode("a", out_type=str), p.encode("a  b", out_type=str), p.encode("ﬁ", out_type=int)
        keeps = probe[0][0].startswith(mark) and "".join(probe[1]).count(mark) == 3 and probe[2] != p.encode("fi")
        _processors[model_file] = p, bare and keeps
    return _processors[model_file]


def pieces(text: str, size: int = SEGMENT_CHARS) -> list[str]:
    """Parts of a text whose token counts add up to the text's; without a boundary a part is longer."""
    out, at = [], 0
    while len(text) - at > size:
        m = SAFE_BLANK.search(text, at + size)
        if m is None:
            break
        out.append(text[at : m.start()])
        at = m.end()
    out.append(text[at:])
    return out


def count_batch(texts: list[str | None], model_file: str) -> np.ndarray:
    processor, cut = load_processor(model_file)
    counts = np.zeros(len(texts), np.int64)
    call: list[str] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        lengths = [len(x) for x in processor.encode(call, num_threads=1)]
        np.add.at(counts, owner, lengths)
        call.clear()
        owner.clear()

    for i, text in enumerate(texts):
        for part in pieces(text or "") if cut else [text or ""]:
            call.append(part)
            owner.append(i)
            held += len(part) if part.isascii() else len(part.encode())
            if held >= CALL_BYTES:
                flush()
                held = 0
    if call:
        flush()
    return counts


def count_column(text: Column, model_file: str) -> Column:
    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(count_batch(batch.to_pylist(), model_file), pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, model_file: str, text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` plus n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit), replacing columns of those names.

    Whole texts are counted; a null text counts as empty (0 bytes, 0 tokens). Ties, repeated rows and extra columns
    pass through, an empty table gives an empty table. One map without a shuffle; only lengths come back from Python.
    """
    bound_arrow_batches(docs.sparkSession)
    new = ("n_bytes", "n_tokens", "over_limit")
    text = docs[f"`{text_col}`"].cast("string")
    rest = [docs[f"`{c}`"] for c in docs.columns if c not in new]
    counted = docs.select(*rest, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), count_column(text, model_file).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
