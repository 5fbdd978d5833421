"""Session helpers of the operators: scratch tables in buckets, and Arrow batch bounds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from leadlake.scratch import fresh_path, mark, materialise, release, remember, shared_dir

__all__ = ["bound_arrow_batches", "fresh_path", "in_buckets", "mark", "materialise", "release", "shared_dir"]

ARROW_BATCH_BYTES = 4 << 20


def in_buckets(df: DataFrame, key: str, n: int, what: str) -> DataFrame:
    """``df`` written once, dealt by ``key`` into ``n`` buckets, and read back: grouping or joining it by the key needs no further
    exchange, and a value that can't be computed the same way twice (a task's number) is settled."""
    spark = df.sparkSession
    path, name = fresh_path(spark, what), f"leadlake_{uuid.uuid4().hex}"
    df.repartition(n, key).write.format("parquet").option("path", path).bucketBy(n, key).saveAsTable(name)
    remember(spark, "table", name)
    return spark.table(name)


def bound_arrow_batches(spark: SparkSession, n_bytes: int = ARROW_BATCH_BYTES) -> None:
    """Cap the session's Arrow batches by bytes, so that a run of long texts can't fill a Python worker.

    The setting is read when a plan runs, so it is only ever lowered: no operator built later widens what an earlier one,
    still to run, relies on.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    if now is None or not now.isdigit() or int(now) > n_bytes or int(now) <= 0:
        spark.conf.set(name, str(n_bytes))
