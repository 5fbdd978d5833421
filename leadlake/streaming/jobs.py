"""Incremental forms of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def first_seen(events: DataFrame, keys: Sequence[str], ts: str | None = None, delay: str = "1 hour") -> DataFrame:
    """First row of each key across a stream; with a time column the state is dropped after ``delay``. (STM-03)"""
    return events.dropDuplicates(list(keys)) if ts is None else events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def finished(query: StreamingQuery, seconds: float) -> None:
    """Waits for a query that ends by itself; one that doesn't in time is stopped, and that is an error."""
    if not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"the stream did not end within {seconds} s")


def process_once(stream: DataFrame, path: str, checkpoint: str, seconds: float = 3600) -> None:
    """Appends what a stream makes of every input file to Parquet under ``path``, each file once, also across restarts: the
    checkpoint remembers the files and the sink's own log the batches that are whole. (STM-02, STM-04)"""
    finished(stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), seconds)


def process_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, seconds: float = 3600) -> None:
    """The same with a function for each batch, which may see a batch again after a failure. (STM-02)"""
    finished(stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), seconds)


def admitted(times: Sequence[float], kept: list[float], span: float, most: int) -> list[bool]:
    """Of ordered times those admitted: fewer than ``most`` admitted ones are younger than ``span``. ``kept`` carries over."""
    out = []
    for t in times:
        kept[:] = [k for k in kept if t - k < span]
        out.append(len(kept) < most)
        if out[-1]:
            kept.append(t)
    return out


def rate_limit(events: DataFrame, user: str, ts: str, tie: str, seconds: float = 60, most: int = 10) -> DataFrame:
    """``events`` plus accepted: a sliding window per user in which rejected events don't count. (STM-01, batch form)

    Rows are dealt by user and sorted; a task goes through them batch by batch and holds one user's admitted times, at
    most ``most``.
    """
    kinds = ", ".join(f"`{n}` {t}" for n, t in events.dtypes)
    dealt = events.repartition(user).sortWithinPartitions(user, ts, tie)

    def limit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, started = None, [], False
        for batch in batches:
            users = batch.column(batch.schema.get_field_index(user)).to_pylist()
            times = batch.column(batch.schema.get_field_index(ts)).cast(pa.int64()).to_pylist()
            ok = []
            for u, t in zip(users, times, strict=True):
                if not started or u != now:
                    now, kept, started = u, [], True
                ok += admitted([t / 1e6], kept, seconds, most)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ok, pa.bool_())], names=[*batch.schema.names, "accepted"])

    return dealt.mapInArrow(limit, f"{kinds}, accepted boolean")


def rate_limit_stream(events: DataFrame, user: str, ts: str, tie: str, seconds: float = 60, most: int = 10, delay: str = "1 hour", buckets: int = 2048) -> DataFrame:
    """(user, ts, tie, accepted) of a stream's events as soon as the watermark (``delay`` behind the latest event) has passed them:
    the same as of the batch form however the events are cut into micro-batches, in any order within ``delay``; later ones and
    those without a time are dropped. Needs the RocksDB state store, which it asks for. (STM-01)

    Users are dealt over ``buckets``, fixed for a checkpoint as shuffle partitions are, and a call handles all users of one: a call for each
    user costs milliseconds. A bucket's state is the events that wait and the admitted times that can still matter, and is removed
    once nothing can; a bucket's waiting events fit a task. Users travel as text.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    kind = events.schema[user].dataType.simpleString()
    timed = events.filter(F.col(ts).isNotNull()).select(F.col(user).cast("string").alias("_user"), F.col(ts).cast("timestamp").alias(ts), F.col(tie).cast("long").alias(tie))
    timed = timed.withWatermark(ts, delay).withColumns({"_us": F.unix_micros(ts), "_bucket": F.pmod(F.xxhash64("_user"), F.lit(buckets))})

    def limit(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed, held = state.getCurrentWatermarkMs(), state.get if state.exists else ([], [], [], [], [])
        waiting, kept = {}, {}
        for u, at, t in zip(*held[:3], strict=True):
            waiting.setdefault(u, []).append((at, t))
        for u, at in zip(*held[3:], strict=True):
            kept.setdefault(u, []).append(at)
        for pdf in () if state.hasTimedOut else parts:
            for u, at, t in zip(pdf["_user"].tolist(), pdf["_us"].tolist(), pdf[tie].tolist(), strict=True):
                waiting.setdefault(u, []).append((at, t))
        out, rest, still = [], [], []
        for u in waiting.keys() | kept.keys():
            mine, ats = sorted(waiting.get(u, ())), kept.get(u, [])
            ready = [e for e in mine if e[0] // 1000 <= passed]
            ok = admitted([at / 1e6 for at, _ in ready], ats, seconds, most)
            out += ((u, at, t, k) for (at, t), k in zip(ready, ok, strict=True))
            rest += ((u, at, t) for at, t in mine[len(ready) :])
            still += ((u, at) for at in ats if passed / 1e3 - at < seconds)
        if rest or still:
            state.update((*([r[i] for r in rest] for i in range(3)), *([r[i] for r in still] for i in range(2))))
            due = min(at for _, at, _ in rest) // 1000 - 1 if rest else int((max(at for _, at in still) + seconds) * 1000)  # over when the watermark is later
            state.setTimeoutTimestamp(max(due, passed, 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["_user", "_us", tie, "accepted"])

    held = "users array<string>, us array<long>, ties array<long>, keepers array<string>, kept array<double>"
    judged = timed.groupBy("_bucket").applyInPandasWithState(limit, f"_user string, _us long, `{tie}` long, accepted boolean", held, "append", GroupStateTimeout.EventTimeTimeout)
    return judged.select(F.col("_user").cast(kind).alias(user), F.timestamp_micros("_us").alias(ts), tie, "accepted")


def windowed_counts(events: DataFrame, ts: str, key: Column, window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Counts per time window and key; windows close when the watermark passes."""
    return events.withWatermark(ts, delay).groupBy(F.window(ts, window), key.alias("key")).agg(F.count("*").alias("n"))
