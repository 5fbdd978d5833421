"""Written forms of a table that answer a search or a page without a full scan."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlake.operators.keyed import in_ranges

#: Folders of a posting table, and the rarest grams of a query that are looked up; the rest is left to the check of the texts.
FOLDERS, LOOKED_UP = 64, 4
#: Pairs of gram and row that a task holds before it writes their lists.
HELD = 2_000_000


def trigrams(text: bytes | None) -> np.ndarray:
    """Runs of three characters of a UTF-8 text, each as one number."""
    points = np.frombuffer((text or b"").decode("utf-8", "replace").encode("utf-32-le"), "<u4").astype(np.int64)
    return points[:-2] << 42 | points[1:-1] << 21 | points[2:]


def posting_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n, ids) of batches of an id and texts: the ids of up to ``HELD`` pairs at a time, by gram."""
    for batch in batches:
        ids, found, pairs = batch.column(0), [], 0
        texts = list(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True))
        for i, parts in enumerate(texts):
            grams = np.sort(np.concatenate([trigrams(p) for p in parts]))
            grams = grams[np.append(True, grams[1:] != grams[:-1])[: len(grams)]]  # twice as fast as np.unique
            found.append((grams, i))
            pairs += len(grams)
            if pairs and (pairs >= HELD or i == len(texts) - 1):
                grams, rows = np.concatenate([g for g, _ in found]), np.repeat([k for _, k in found], [len(g) for g, _ in found])
                order = np.argsort(grams, kind="stable")
                grams, starts = np.unique(grams[order], return_index=True)
                ends = np.append(starts, pairs).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), ids.take(pa.array(rows[order])))
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(np.diff(ends)), lists], names=["gram", "n", "ids"])
                found, pairs = [], 0


def kind_of(df: DataFrame, id_col: str) -> str:
    return f"gram long, n int, ids array<{df.schema[id_col].dataType.simpleString()}>"


def write_index(df: DataFrame, id_col: str, cols: Sequence[str], path: str) -> None:
    """A posting table (gram, n, ids) of the lower-cased columns and the grams' frequencies under ``path``. A task lists the ids of its rows by gram, so
    a gram has one row per batch of rows, not per row. Lists lie in ``FOLDERS`` folders by gram, sorted, so a lookup reads one
    folder's row groups; a frequent gram's lists are spread over many files. (FLT-01, FLT-03)"""
    texts = df.select(F.col(id_col).alias("id"), *(F.lower(F.col(c).cast("string")).cast("binary").alias(f"c{i}") for i, c in enumerate(cols)))
    postings = texts.mapInArrow(posting_lists, kind_of(df, id_col)).withColumn("folder", F.pmod(F.xxhash64("gram"), F.lit(FOLDERS)))
    postings.hint("rebalance", "folder").sortWithinPartitions("folder", "gram").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/postings")
    written = postings_of(df, id_col, path)
    written.groupBy("gram").agg(F.sum("n").alias("n")).sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/frequencies")


def postings_of(df: DataFrame, id_col: str, path: str) -> DataFrame:
    return df.sparkSession.read.schema(f"{kind_of(df, id_col)}, folder long").parquet(f"{path}/postings")


def indexed_search(df: DataFrame, id_col: str, cols: Sequence[str], path: str, query: str) -> DataFrame:
    """Rows of ``df`` with the query, in any case, in one of the columns: those that the index names, checked. (FLT-01, FLT-03)

    The query's rarest grams are looked up and their postings intersected; all rows that hold the query hold all its
    grams, so none is missed. A query under three characters has no gram and scans.
    """
    spark, low = df.sparkSession, query.lower()
    holds = F.lit(False)
    for c in cols:
        holds = holds | F.coalesce(F.contains(F.lower(F.col(c).cast("string")), F.lit(low)), F.lit(False))
    grams = set(trigrams(low.encode("utf-8", "replace")).tolist())
    if not grams:
        return df.filter(holds)
    counts = {r.gram: r.n for r in spark.read.parquet(f"{path}/frequencies").filter(F.col("gram").isin(*grams)).collect()}  # grams of one query
    if len(counts) < len(grams):
        return df.filter(F.lit(False))
    rare = sorted(counts, key=lambda g: (counts[g], g))[:LOOKED_UP]
    folders = [r[0] for r in spark.range(1).select(F.explode(F.array(*map(F.lit, rare))).alias("g")).select(F.pmod(F.xxhash64("g"), F.lit(FOLDERS))).collect()]
    found = postings_of(df, id_col, path).filter(F.col("folder").isin(*folders) & F.col("gram").isin(*rare)).select("gram", F.explode("ids").alias("id"))
    ids = found.groupBy("id").agg(F.size(F.collect_set("gram")).alias("_n")).filter(F.col("_n") == len(rare)).select(F.col("id").alias("_found"))
    return df.join(ids, F.col(id_col) == F.col("_found"), "left_semi").filter(holds)


def write_sorted(df: DataFrame, order: Sequence[Column], path: str) -> None:
    """``df`` in the order of ``order`` under ``path``, a folder per range, each row with its place in the range, and the ranges' sizes. (SRT-02)"""
    dealt = in_ranges(df, order, "sorted").withColumnRenamed("_part", "range").withColumnRenamed("_in", "place")
    dealt.repartition("range").sortWithinPartitions("range", "place").write.mode("overwrite").partitionBy("range").parquet(f"{path}/rows")
    sizes = dealt.groupBy("range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("range")) - F.col("n")  # one row per range
    sizes.select("range", "n", before.alias("before")).coalesce(1).write.mode("overwrite").parquet(f"{path}/sizes")


def sorted_page(spark: SparkSession, path: str, number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of what ``write_sorted`` wrote: only the ranges that hold it are read, and no row before it is
    sorted or skipped. (SRT-02)"""
    first, last = (number - 1) * size, number * size - 1
    sizes = spark.read.parquet(f"{path}/sizes").filter((F.col("before") <= last) & (F.col("before") + F.col("n") > first)).orderBy("range").collect()
    rows, inside = spark.read.parquet(f"{path}/rows"), F.lit(False)
    for r in sizes:
        inside = inside | ((F.col("range") == r.range) & F.col("place").between(first - r.before, last - r.before))
    return rows.filter(inside).orderBy("range", "place").drop("range", "place")
