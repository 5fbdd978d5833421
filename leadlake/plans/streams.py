"""Streaming queries: each table is read as a stream of files to its end, and the result read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.functions import url as U
from leadlake.plans.queries import CANON_SQL, LIMIT_SQL
from leadlake.plans.registry import ORACLES, QUERIES
from leadlake.scratch import fresh_path
from leadlake.streaming import jobs as J


def streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.readStream.schema(spark.read.parquet(f"{sf_dir}/{name}.parquet").schema).parquet(f"{sf_dir}/{name}.parquet*")


def whole_run(stream: DataFrame) -> DataFrame:
    """What the stream appends until it has read every file."""
    spark = stream.sparkSession
    path = fresh_path(spark, "streamed")
    J.process_once(stream, path, fresh_path(spark, "stream-checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


def stream(sql: str):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: whole_run(f(lambda name: streamed(spark, sf_dir, name)))
        ORACLES[f.__name__] = sql
        return f

    return register


@stream("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(t):
    """(STM-03)"""
    return J.first_seen(t("events").select("user_id", "event_type"), ["user_id", "event_type"])


@stream(CANON_SQL + "SELECT page_id, canonical_url, host FROM c")
def stream_ingest(t):
    """(STM-02, STM-04)"""
    return t("pages").select("page_id", U.canonical(F.col("url")).alias("canonical_url")).withColumn("host", U.host(F.col("canonical_url")))


def stream_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three files, one after the other, each a micro-batch; what the watermark has passed is judged. (STM-01)"""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    path, seconds = fresh_path(spark, "arriving"), F.unix_timestamp("ts")
    first, last = events.agg(F.min(seconds), F.max(seconds)).first()
    for i in range(3):
        low, high = (first + (last - first) * k // 3 for k in (i, i + 1))
        part = events.filter(seconds.between(low, high if i == 2 else high - 1)) if first is not None else events
        part.coalesce(1).write.mode("append").parquet(path)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return whole_run(J.rate_limit_stream(arriving, "user_id", "ts", "event_id", 86400, 3, "1 hour")).drop("ts")


QUERIES["stream_rate_limit"] = stream_rate_limit
ORACLES["stream_rate_limit"] = f"SELECT event_id, user_id, accepted FROM ({LIMIT_SQL}) JOIN (SELECT event_id, ts FROM events) USING (event_id) WHERE ts::TIMESTAMP <= (SELECT max(ts)::TIMESTAMP - INTERVAL 1 HOUR FROM events)"


@stream("""SELECT start, key, count(*)::BIGINT AS n FROM (SELECT date_trunc('hour', ts)::TIMESTAMP AS start, event_type AS key FROM events) GROUP BY start, key HAVING start + INTERVAL 1 HOUR <= (SELECT max(ts)::TIMESTAMP - INTERVAL 2 HOUR FROM events)""")
def stream_windows(t):
    """Windows that the watermark has closed."""
    return J.windowed_counts(t("events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", F.col("event_type")).select(F.col("window.start").alias("start"), "key", "n")
