"""Tables written once to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_made: dict[str, list[tuple[str, str]]] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset and all runs on one machine, a temporary folder of this application."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="leadlake-")
    return _local[app]


def remember(spark: SparkSession, kind: str, name: str) -> None:
    """A path or table that ``release`` is to delete."""
    _made.setdefault(spark.sparkContext.applicationId, []).append((kind, name))


def fresh_path(spark: SparkSession, what: str) -> str:
    """A new folder under the shared one, remembered until ``release``."""
    path = f"{shared_dir(spark).rstrip('/')}/leadlake/{what}-{uuid.uuid4().hex}"
    remember(spark, "path", path)
    return path


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors.

    The read-back has exact size statistics, so Catalyst broadcasts it only when it is small, and joins
    against it have a plain exchange on both sides, which AQE can split when a key is skewed.
    """
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark(spark: SparkSession) -> int:
    """How much scratch there is, for ``release`` of what comes after."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0, keep_last: int = 0) -> None:
    """Delete this application's scratch made after ``since``, but for the last ``keep_last``; call it when every result over it is written."""
    made = _made.get(spark.sparkContext.applicationId, [])
    gone = made[since : len(made) - keep_last]
    made[since : len(made) - keep_last] = []
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    for kind, name in gone:
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            target = hadoop(name)
            target.getFileSystem(conf).delete(target, True)
