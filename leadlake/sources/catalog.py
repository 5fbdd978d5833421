"""A catalog as a partitioned Parquet table on shared storage: upserts that rewrite only the partitions they touch, and counts
that are kept up to date from what each upsert changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadlake.operators.keyed import keep_best


@dataclass
class Catalog:
    """A table under ``path`` with one row per ``key`` and one folder per value of ``partition``.

    One writer at a time. An upsert is staged under ``_upserts/<batch>`` (readers skip such names), then its folders are
    swapped in one by one. What has been staged whole is finished by the next call after a crash; what has not is done
    again; a batch that is done is not applied twice.
    """

    spark: SparkSession
    path: str
    schema: StructType
    key: str = "record_id"
    partition: str = "country"

    def _fs(self):
        jvm = self.spark._jvm
        return jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _exists(self, *parts: str) -> bool:
        return self._fs().exists(self._at(*parts))

    def _folders(self, *parts: str) -> list[str]:
        """Names of the partitions, or of the batches, under a folder."""
        if not self._exists(*parts):
            return []
        return sorted(s.getPath().getName() for s in self._fs().listStatus(self._at(*parts)) if s.isDirectory())

    def read(self) -> DataFrame:
        """All rows; filters on the partition column skip folders. An absent table is an empty one. (SRC-10)"""
        if not any(not n.startswith("_") for n in self._folders()):
            return self.spark.createDataFrame([], self.schema)
        rest = StructType([f for f in self.schema if f.name != self.partition])
        read = self.spark.read.schema(rest.add(self.schema[self.partition])).parquet(self.path)
        return read.select(*self.schema.names)

    def _staged(self, batch: str, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/_upserts/{batch}/{part}")

    def changes(self, batch: str) -> DataFrame:
        """key, action (inserted or updated), old and new row of a batch. (SNK-05)"""
        return self._staged(batch, "changes")

    def upsert(self, incoming: DataFrame, batch: str, priority: Column, keep_old: Sequence[str] = ()) -> DataFrame:
        """Writes the best row per key of ``incoming`` over or beside the rows there; returns the batch's ``changes``. (SNK-04)

        Nulls overwrite, but for the columns ``keep_old``, where a null leaves the old value. A row whose partition value
        changes moves. Rows without a key are left out. The key column alone is scanned to find the partitions that hold
        incoming keys; only these and the ones that rows go to are read and written, dealt anew so that a large partition gets many files.
        """
        self.finish()
        if self._exists("_upserts", batch, "_DONE"):
            return self.changes(batch)
        names, folder = self.schema.names, f"{self.path}/_upserts/{batch}"
        best = keep_best(incoming.filter(F.col(self.key).isNotNull()), [self.key], [priority]).select(*names)
        best.write.mode("overwrite").parquet(f"{folder}/incoming")
        best = self._staged(batch, "incoming")
        now = self.read()
        held = now.join(best.select(self.key), self.key, "left_semi").select(self.partition).distinct()
        touched = [r[0] for r in held.union(best.select(self.partition)).distinct().collect()]  # one per partition
        inside = F.col(self.partition).isin([v for v in touched if v is not None])
        old = now.filter(inside | F.col(self.partition).isNull() if None in touched else inside)
        before = old.select(self.key, F.struct(*names).alias("old"))
        both = best.select(self.key, F.struct(*names).alias("_in")).join(before, self.key, "left")
        value = lambda c: F.coalesce(F.col(f"_in.{c}"), F.col(f"old.{c}")) if c in keep_old else F.col(f"_in.{c}")
        changed = both.select(self.key, F.when(F.col("old").isNull(), "inserted").otherwise("updated").alias("action"), "old", F.struct(*(value(c).alias(c) for c in names)).alias("new"))
        changed.write.mode("overwrite").parquet(f"{folder}/changes")
        changed = self.changes(batch)
        kept = old.join(changed.select(self.key), self.key, "left_anti")
        rows = kept.union(changed.select("new.*"))
        rows.hint("rebalance", self.partition).write.mode("overwrite").partitionBy(self.partition).parquet(f"{folder}/rows")
        there = set(self._folders("_upserts", batch, "rows"))
        named = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        gone = sorted({named.getPartitionPathString(self.partition, None if v is None else str(v)) for v in touched} - there)
        self.spark.createDataFrame([(n,) for n in gone], "folder string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/emptied")
        self._fs().create(self._at("_upserts", batch, "_STAGED"), True).close()
        self.finish()
        return self.changes(batch)

    def finish(self) -> None:
        """Swaps in the folders of batches that are staged whole; each step may be repeated."""
        for batch in self._folders("_upserts"):
            if not self._exists("_upserts", batch, "_STAGED") or self._exists("_upserts", batch, "_DONE"):
                continue
            fs = self._fs()
            for r in self._staged(batch, "emptied").collect():
                fs.delete(self._at(r.folder), True)
            for name in self._folders("_upserts", batch, "rows"):
                fs.delete(self._at(name), True)
                if not fs.rename(self._at("_upserts", batch, "rows", name), self._at(name)):
                    raise OSError(f"{name} of batch {batch} could not be swapped in")
            fs.create(self._at("_upserts", batch, "_DONE"), True).close()

    def count_changes(self, batch: str, name: str, by: Sequence[str], conditions: Mapping[str, Column]) -> None:
        """Stores what a batch adds to the counts of ``name``, once whatever is repeated. (AGG-01, AGG-03, AGG-04)"""
        count_deltas(self.changes(batch), by, conditions).write.mode("overwrite").parquet(f"{self.path}/_counts/{name}/batch={batch}")

    def counts(self, name: str) -> DataFrame:
        """The counts of all batches together; it reads a row per group and batch, not the catalog."""
        stored = self.spark.read.option("basePath", f"{self.path}/_counts/{name}").parquet(f"{self.path}/_counts/{name}").drop("batch")
        numbers = [c for c, kind in stored.dtypes if c == "total" or c.startswith("n_")]
        by = [c for c in stored.columns if c not in numbers]
        return stored.groupBy(*by).agg(*(F.sum(c).alias(c) for c in numbers)).filter("total <> 0")


def count_deltas(changes: DataFrame, by: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """(by, total, n_<condition>): rows that came less rows that went, by the values of ``by``; ``conditions`` are over the catalog's columns."""
    sides = [changes.filter(F.col(side).isNotNull()).select(f"{side}.*", F.lit(sign).cast("long").alias("_sign")) for side, sign in (("old", -1), ("new", 1))]
    signed = sides[0].union(sides[1])
    numbers = [F.sum("_sign").alias("total"), *(F.sum(F.when(c, F.col("_sign")).otherwise(F.lit(0))).cast("long").alias(f"n_{k}") for k, c in conditions.items())]
    out = signed.groupBy(*by).agg(*numbers)
    moved = F.col("total") != 0
    for k in conditions:
        moved = moved | (F.col(f"n_{k}") != 0)
    return out.filter(moved)
