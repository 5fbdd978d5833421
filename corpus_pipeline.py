"""A corpus pipeline of five stages; each reads what the one before wrote and returns documents for the next.

All stages take any table with doc_id, text, source and n_chars: nulls count as the operators' docstrings say (a null text is
empty, a null source is one of its own, null ids are equal), repeated rows are rows of their own, an empty table gives an
empty table, and columns of the table that have the name of something an operator adds keep their own values.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm import bpe, mixing, quality, session, simhash, substring

#: Arrow batches of the stages: several Python workers of an executor hold some at once, beside a heap that earlier stages have filled.
BATCH_BYTES = 2 << 20
NEEDED = ("doc_id", "text", "source", "n_chars")


def apart(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` over ``docs``, with the columns that no stage reads under names that no operator uses; the columns of ``docs`` come back."""
    session.bound_arrow_batches(docs.sparkSession, BATCH_BYTES)
    others = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in NEEDED}
    out = step(docs.withColumnsRenamed(others))
    return out.select(*(F.col(others.get(c, f"`{c}`")).alias(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and compression bands keep; the bands' lower limits come from all documents that
    are labelled good. Empty and null texts have no words and go."""
    session.bound_arrow_batches(spark, BATCH_BYTES)
    bands = quality.fit_bands(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return apart(docs, lambda d: quality.quality(d, bands=bands).filter("kept"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies. Of rows with one id and one fingerprint one stays; a
    group without ids keeps one row; documents without words are one group."""
    return apart(docs, lambda d: simhash.keep_one(simhash.add_fingerprints(d)))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur elsewhere; a text that loses nothing stays as it is (null too), n_chars follows the text."""

    def cut(d: DataFrame) -> DataFrame:
        shorter = substring.dedup_substrings(d)
        lost = F.col("n_removed") > 0
        changed = shorter.withColumn("text", F.when(lost, F.col("kept_text")).otherwise(F.col("text")))
        return changed.withColumn("n_chars", F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars")))

    return apart(docs, cut)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target asks for; a source without words has none to give."""
    return apart(docs, lambda d: mixing.emit(mixing.mix(d), d.columns))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids (packed little-endian unsigned 32-bit integers) and decoded_sha256 of the ids decoded again; a null text has no tokens."""
    session.bound_arrow_batches(spark, BATCH_BYTES)
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(docs.select("doc_id", "text"), ranks, pattern).drop("text")
    return bpe.decode(coded, ranks, pattern).select("doc_id", "n_tokens", "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("simhash_dedup", simhash_dedup), ("substring_dedup", substring_dedup), ("mix_sources", mix_sources), ("byte_bpe", byte_bpe)]

#: Compression ratios and XXH64 fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again, then what it was made from is deleted."""
    docs, began = spark.read.parquet(f"{sf_dir}/documents.parquet"), session.mark(spark)
    for name, stage in STAGES:
        docs = session.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        session.release(spark, since=began, keep_last=1)
    return docs
