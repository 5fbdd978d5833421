"""The operators' queries over whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm import bpe, crf, forest, importance, mixing, quality, repair, session, simhash, substring, suffix, tokencount, urlfilter, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern).drop("text")
    back = bpe.decode(coded, ranks, pattern)
    return back.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs, bands=quality.fit_bands(docs, table(spark, sf_dir, "labels"))).drop("text")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.filter_urls(pages, urlfilter.production_rules(spark)).drop("url")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.dedup_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.add_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    found = simhash.near_duplicates(session.materialise(marked, "fingerprints"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op11_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return crf.classify(docs, crf.train(docs, table(spark, sf_dir, "labels"))).drop("text")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark")).drop("n_words")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.summaries(repair.repair(repair.damage(told), told))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_quality_rules, op3_warc, op4_mixing, op5_embedding_dedup, op6_url_filter, op7_token_counts, op8_substring_dedup, op9_byte_dedup, op10_simhash,
        op11_line_quality, op12_resample, op13_conversation_repair,
    )
}
ORACLES: dict[str, str] = {"op3_warc": warc.SQL, "op4_mixing": mixing.SQL, "op6_url_filter": urlfilter.SQL, "op12_resample": importance.SQL, "op13_conversation_repair": repair.SQL}
