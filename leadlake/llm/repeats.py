"""Repeated windows of long sequences, found with a few rows per text and cut out exactly.

A scheme turns a batch of texts into occurrences: an anchor gram, the range of window starts it answers for, and its
context (everything those windows cover). Equal windows always lie in occurrences of one gram at the same offset, so

1. grams that occur once in the corpus settle their windows: not repeated;
2. an occurrence whose whole context occurs again settles all its windows: repeated;
3. the rest, near the ends of matches, compare their windows one by one with those of the other contexts of the gram, or,
   if the scheme has ``pieces``, send what those windows cover to shards that sort its suffixes. A gram with more than
   ``DENSE`` different contexts is split further, down to single windows, so no gram grows a shard without bound.

Texts are dealt once into batches of bounded bytes by a hash of the row and, for rows that a task has several times, of
their number. Every batch sends each distinct value once, so a gram, context or window that half of the corpus shares is
still at most one row per batch, and these are counted by partial sums.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.llm.session import bound_arrow_batches, fresh_path, in_buckets, materialise
from leadlake.llm.words import Rolling

BATCH_BYTES = 512 << 10
BUCKET_BYTES, MOST_BUCKETS = 16 << 20, 50_000  # a task's texts; beyond so many buckets, more
SHARD_BYTES, MOST_SHARDS = 4 << 20, 20_000  # a shard gets the pieces of so much text; beyond so many shards, of more, and uses its disk
DENSE = 1 << 11  # different contexts of a gram, at most about as many bytes of pieces as a shard has
BY_WINDOW, OPEN, PARTNER, SETTLED = range(4)
KINDS = 4  # OPEN + KINDS * k marks strings 64 * k to 64 * k + 63 of a piece
MIX = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class Occurrences:
    """Of one batch: gram and context hashes, inclusive ranges of window starts, and the rolling hashes."""

    gram: np.ndarray
    context: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rolling: tuple[Rolling, Rolling]
    length: int

    def some(self, chosen: np.ndarray) -> Occurrences:
        return Occurrences(self.gram[chosen], self.context[chosen], self.low[chosen], self.high[chosen], self.rolling, self.length)

    def both(self) -> np.ndarray:
        return pair(self.gram, self.context)

    def flags(self, chosen: np.ndarray) -> np.ndarray:
        """For each position whether a window of a chosen occurrence starts there."""
        n = int(self.high.max(initial=-1)) + 2
        depth = np.bincount(self.low[chosen], minlength=n) - np.bincount(self.high[chosen] + 1, minlength=n)
        return np.cumsum(depth) > 0

    def starts(self, chosen: np.ndarray) -> np.ndarray:
        """Window starts of the chosen occurrences, each position once."""
        return np.flatnonzero(self.flags(chosen))

    def windows(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.rolling[0].at(starts, self.length), self.rolling[1].at(starts, self.length)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return a * MIX ^ (b << np.uint64(31) | b >> np.uint64(33))


def contexts(rolling: Rolling, low: np.ndarray, high: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of what the windows low..high cover, with the gram's place in it."""
    size = high - low + length
    return pair(rolling.at(low, size), (size * 65536 + (at - low)).astype(np.uint64))


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(values), bool)
    of = np.sort(of)
    at = np.minimum(np.searchsorted(of, values), len(of) - 1)
    return of[at] == values


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64, copy=False).view(np.uint64)


def rows(names: list[str], values: list[np.ndarray], batch: int) -> pa.Table:
    """Each distinct row of a batch once; tag is twice the batch, plus 1 for a row that occurs again in the batch."""
    _, first, times = np.unique(pair(values[0], values[-1]) if len(values) > 1 else values[0], return_index=True, return_counts=True)
    tag = batch * 2 + (times > 1)
    return pa.table([*(pa.array(v[first].view(np.int64)) for v in values), pa.array(tag, pa.int64())], names=[*names, "tag"])


def packed_column(text: Column, row_hash: Column) -> Column:
    """struct<packed, copy>: a text's UTF-8 bytes compressed, for one move of half the size (null stays null), and how many
    rows of the same hash the task has had before: equal rows get numbers of their own, in whatever order they come."""

    @F.arrow_udf("struct<packed: binary, copy: int>")
    def pack(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import zstandard

        compressor, times = zstandard.ZstdCompressor(level=3), Counter()
        for text, hashes in batches:
            packed = [None if x is None else compressor.compress(x) for x in text.cast(pa.binary()).to_pylist()]
            copy = []
            for h in hashes.to_pylist():
                copy.append(times[h])
                times[h] += 1
            yield pa.StructArray.from_arrays([pa.array(packed, pa.binary()), pa.array(copy, pa.int32())], ["packed", "copy"])

    return pack(text, row_hash)


def unpacked(table: pa.Table) -> pa.Array:
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    return pa.array([None if x is None else expand(x) for x in table.column("_packed").to_pylist()], pa.large_binary())


def often(found: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, in several batches or again in one; summed up before the shuffle."""
    times = F.sum(F.col("tag").bitwiseAND(F.lit(1)) + 1).alias("times")
    return found.groupBy(*keys).agg(times).filter("times > 1").select(*keys)


def cut(docs: DataFrame, text_col: str, scheme, out_fields: list[T.StructField], batch_bytes: int = BATCH_BYTES, keep_text: bool = True, dense: int = DENSE) -> DataFrame:
    """``docs`` with the scheme's output columns; the work of the module's docstring.

    The texts are dealt into batches and written once, compressed, in buckets of batches; the passes read them there and only hashes and pieces move. Counts are
    aggregates, summed before the shuffle and joined back, so AQE can split what one gram or window brings; what several
    steps read is written to the shared folder once.
    """
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    new = [f.name for f in out_fields]
    kept = [c for c in docs.columns if c not in new and c != text_col]
    text = docs[f"`{text_col}`"].cast("string")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_batches = max(1, math.ceil(total / batch_bytes))
    row = F.struct(*(docs[f"`{c}`"] for c in kept), F.lit(0).alias("_"))
    hashed = docs.select(row.alias("_row"), text.alias("_text"), F.xxhash64(row, text).alias("_hash"))
    packed = hashed.select("_row", "_hash", packed_column(F.col("_text"), F.col("_hash")).alias("_p"))
    # Equal rows of a table without ids must not all meet in one batch.
    batch = F.when(F.col("_p.copy") == 0, F.xxhash64("_hash", F.spark_partition_id())).otherwise(F.xxhash64("_hash", F.spark_partition_id(), "_p.copy"))
    held = packed.select("_row", F.col("_p.packed").alias("_packed"), F.pmod(batch, F.lit(n_batches)).alias("_batch"))

    def grams(key: tuple, table: pa.Table) -> pa.Table:
        return rows(["gram"], [scheme.occurrences(unpacked(table)).gram], key[0].as_py())

    def placed_all(key: tuple, table: pa.Table) -> pa.Table:
        found = scheme.occurrences(unpacked(table))
        return rows(["gram", "context"], [found.gram, found.context], key[0].as_py())

    def matched(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return rows(["gram", "context"], [np.zeros(0, np.uint64)] * 2, 0)
        found = scheme.occurrences(unpacked(left))
        found = found.some(member(found.gram, column(right, "gram")))
        return rows(["gram", "context"], [found.gram, found.context], key[0].as_py())

    def single(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            none = rows(["x", "y"], [np.zeros(0, np.uint64)] * 2, 0)
            return none.append_column("piece", pa.array([], pa.binary()))
        texts, batch = unpacked(left), key[0].as_py()
        found = scheme.occurrences(texts)
        both, asked, kind = found.both(), pair(column(right, "gram"), column(right, "context")), right.column("kind").to_numpy()
        compared = rows(["x", "y"], list(found.windows(found.starts(member(both, asked[kind == BY_WINDOW])))), batch)
        compared = compared.append_column("piece", pa.nulls(compared.num_rows, pa.binary()))
        sent = []
        for role in (OPEN, PARTNER):
            chosen = np.flatnonzero(member(both, asked[kind == role]))
            chosen = chosen[np.unique(both[chosen], return_index=True)[1]]  # a partner may occur again here
            if len(chosen):
                values = [pa.array(v[chosen].view(np.int64)) for v in (found.gram, found.context)]
                tag = pa.array(np.full(len(chosen), batch * 2 + (role == PARTNER)))
                sent.append(pa.table([*values, tag, scheme.pieces(texts, found, chosen)], names=["x", "y", "tag", "piece"]))
        return pa.concat_tables([compared, *sent])

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        texts = unpacked(left)
        repeated = np.zeros(0, np.int64)
        if right.num_rows:
            found = scheme.occurrences(texts)
            marks, kind, both = pair(column(right, "x"), column(right, "y")), right.column("kind").to_numpy(), found.both()
            settled = member(both, marks[kind == SETTLED])
            flags = found.flags(settled)
            if (kind == BY_WINDOW).any():
                rest = np.flatnonzero(found.flags(~settled) & ~flags)
                flags[rest[member(pair(*found.windows(rest)), marks[kind == BY_WINDOW])]] = True
            if (kind % KINDS == OPEN).any():
                open_marks = kind % KINDS == OPEN
                part = np.flatnonzero(~settled & member(both, marks[open_marks]))
                part = part[np.argsort(both[part])]
                known, block, bits = marks[open_marks], kind[open_marks] // KINDS, column(right, "bits")[open_marks]
                first, last = (np.searchsorted(both[part], known, side) for side in ("left", "right"))  # equal ones only if a partner, whose marks are none
                n = last - first
                at, mark = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), np.repeat(np.arange(len(known)), n)
                row, offset = np.nonzero(np.unpackbits(bits[mark].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                flags[found.low[part[at[row]]] + 64 * block[mark[row]] + offset] = True
            repeated = np.flatnonzero(flags)
        columns = scheme.finish(texts, repeated)
        if keep_text:
            columns.append(texts.cast(pa.large_string()).cast(pa.string()))
        return pa.table([left.column("_row"), *columns], names=["_row", *new, *[text_col] * keep_text])

    # Dealt once: where equal rows go depends on the task they are read in, which a later job may draw otherwise.
    buckets = min(MOST_BUCKETS, max(spark.sparkContext.defaultParallelism, math.ceil(total / BUCKET_BYTES)))
    held = in_buckets(held, "_batch", buckets, "repeats-texts")
    by_batch = held.groupBy("_batch")
    batch_of, no_bits = F.shiftright("tag", 1).alias("_batch"), F.lit(0).cast("long").alias("bits")
    if scheme.pieces is None:  # many occurrences: grams alone go first
        seen = by_batch.applyInArrow(grams, "gram long, tag long")
        twice = seen.join(materialise(often(seen, "gram"), "repeats-grams"), "gram", "left_semi").select("gram", batch_of)
        placed = by_batch.cogroup(twice.groupBy("_batch")).applyInArrow(matched, "gram long, context long, tag long")
    else:
        seen = materialise(by_batch.applyInArrow(placed_all, "gram long, context long, tag long"), "repeats-seen")
        placed = seen.join(materialise(often(seen, "gram"), "repeats-grams"), "gram", "left_semi")
    placed = materialise(placed, "repeats-placed")
    # A context that occurs again is settled; one of its rows is still a partner for the other contexts of its gram.
    contexts = placed.groupBy("gram", "context").agg(F.sum(F.col("tag").bitwiseAND(F.lit(1)) + 1).alias("times"), F.min("tag").alias("tag"))
    by_gram = contexts.groupBy(F.col("gram").alias("of_gram")).agg(F.count("*").alias("n"), F.count_if(F.col("times") == 1).alias("n_open"))
    judged = materialise(contexts.join(by_gram, F.col("gram") == F.col("of_gram")).select("gram", "context", "tag", "times", "n", "n_open"), "repeats-contexts")
    settled = placed.join(judged.filter("times > 1").select("gram", "context"), ["gram", "context"], "left_semi")
    settled = settled.select(batch_of, F.col("gram").alias("x"), F.col("context").alias("y"), F.lit(SETTLED).alias("kind"), no_bits)
    kind = F.when(F.lit(scheme.pieces is None) | (F.col("n") > dense), BY_WINDOW).when(F.col("times") == 1, OPEN).otherwise(PARTNER)
    compare = judged.filter("n_open > 0").select("gram", "context", batch_of, kind.alias("kind"))
    tried = materialise(by_batch.cogroup(compare.groupBy("_batch")).applyInArrow(single, "x long, y long, tag long, piece binary"), "repeats-compared")
    windows = tried.filter("piece is null").select("x", "y", "tag")
    found = windows.join(materialise(often(windows, "x", "y"), "repeats-windows"), ["x", "y"], "left_semi")
    found = found.select(batch_of, "x", "y", F.lit(BY_WINDOW).alias("kind"), no_bits)
    if scheme.pieces is not None:
        shards = max(spark.sparkContext.defaultParallelism, min(MOST_SHARDS, math.ceil(total / SHARD_BYTES)))
        sort = scheme.sorter(fresh_path(spark, "suffixes"))
        pieces = tried.filter("piece is not null").repartition(shards, "x")
        found = found.union(pieces.mapInArrow(sort, "_batch long, x long, y long, kind int, bits long"))
    marks = settled.union(found)
    schema = T.StructType([T.StructField("_row", held.schema["_row"].dataType), *out_fields, *[T.StructField(text_col, T.StringType())] * keep_text])
    done = by_batch.cogroup(marks.groupBy("_batch")).applyInArrow(finish, schema)
    order = [c for c in docs.columns if c not in new and (keep_text or c != text_col)]
    return done.select(*(F.col(f"`{c}`") if c == text_col else F.col(f"_row.`{c}`") for c in order), *new)
