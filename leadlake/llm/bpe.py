"""Byte-level BPE encoding and decoding with tiktoken and a local rank file."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.session import bound_arrow_batches

#: Texts longer than this many characters are encoded piece by piece.
SEGMENT_CHARS = 1 << 16
#: Before a blank that follows a word character no match of the pattern can continue, and none looks back.
SAFE_CUT = re.compile(r"(?<=\w)(?=[ \n])")

_encodings: dict = {}


def load_encoding(rank_file: str, pattern: str):
    """The tiktoken encoding of a rank file, once per worker process; it has no special tokens."""
    key = (rank_file, pattern)
    if key not in _encodings:
        import tiktoken

        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def segments(text: str, size: int = SEGMENT_CHARS) -> Iterator[str]:
    """Cuts a text at safe boundaries into pieces of about ``size`` characters; without a boundary a piece is longer."""
    at = 0
    while len(text) - at > size:
        m = SAFE_CUT.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def encode_text(encoding, text: str, size: int = SEGMENT_CHARS) -> np.ndarray:
    """Token ids (uint32) of a whole text, every special string as ordinary text."""
    parts = [encoding.encode_to_numpy(s, disallowed_special=()) for s in segments(text, size)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode_column(text: Column, rank_file: str, pattern: str) -> Column:
    """struct<n_tokens long, token_ids binary>; ids are packed little-endian unsigned 32-bit integers."""

    @F.arrow_udf("struct<n_tokens: bigint, token_ids: binary>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding = load_encoding(rank_file, pattern)
        for batch in batches:
            ids = [encode_text(encoding, t or "").astype("<u4", copy=False) for t in batch.to_pylist()]
            counts = pa.array([len(x) for x in ids], pa.int64())
            yield pa.StructArray.from_arrays([counts, pa.array([x.tobytes() for x in ids], pa.binary())], ["n_tokens", "token_ids"])

    return encode(text)


def decode_column(token_ids: Column, rank_file: str, pattern: str) -> Column:
    """The raw bytes (binary) that packed ids stand for; null ids give empty bytes."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding = load_encoding(rank_file, pattern)
        for batch in batches:
            yield pa.array([encoding.decode_bytes(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.to_pylist()], pa.binary())

    return decode(token_ids)


def encode(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_tokens and token_ids (packed), replacing columns of those names.

    Whole texts are encoded; null and empty texts give 0 tokens and empty ids. Repeated rows, ties and extra columns
    pass through; an empty table gives an empty table. Each text is independent, so the job is one map without a shuffle. A long text
    is encoded piece by piece; one without a safe boundary (a single very long word) is one call of the tokenizer.
    """
    bound_arrow_batches(docs.sparkSession, 4 << 20)
    rest = [docs[f"`{c}`"] for c in docs.columns if c not in ("n_tokens", "token_ids")]
    coded = docs.select(*rest, encode_column(docs[f"`{text_col}`"].cast("string"), rank_file, pattern).alias("_leadlake_bpe"))
    kept = [f"`{c}`" for c in docs.columns if c not in ("n_tokens", "token_ids")]
    return coded.select(*kept, F.col("_leadlake_bpe.n_tokens").alias("n_tokens"), F.col("_leadlake_bpe.token_ids").alias("token_ids"))


def decode(coded: DataFrame, rank_file: str, pattern: str, ids_col: str = "token_ids") -> DataFrame:
    """``coded`` plus ``decoded`` (binary), the exact bytes of the encoded text, replacing a column of that name. Null ids give empty
    bytes; repeated rows and extra columns pass through; an empty table gives an empty table; one map without a shuffle."""
    bound_arrow_batches(coded.sparkSession, 4 << 20)
    return coded.withColumn("decoded", decode_column(F.col(f"`{ids_col}`"), rank_file, pattern))


def unpack_ids(token_ids: bytes) -> list[int]:
    return np.frombuffer(token_ids or b"", "<u4").tolist()
