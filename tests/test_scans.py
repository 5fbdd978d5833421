"""Scans, stored catalogs, streams with timers and name search on skewed and awkward tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from leadlake.operators import catalog as C
from leadlake.operators import keyed as K
from leadlake.sources.catalog import Catalog
from leadlake.streaming import jobs as J


@pytest.fixture
def many_ranges(spark):
    """Adaptive execution would put small ranges together."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_replay_of_a_hot_user(spark, many_ranges):
    rng = random.Random(3)
    actions = ["submit", "approve", "reject", "request_changes", "noise", None]
    rows = [(None if u == 5 else u, i, rng.choice(actions)) for i, u in enumerate([9] * 4000 + rng.choices(range(8), k=4000))]
    events = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "user long, at long, act string").repartition(6)
    got = {r[0]: tuple(r)[1:] for r in C.replay(events, "user", ["at"], F.col("act")).collect()}
    for user in {u for u, _, _ in rows}:
        state, applied, illegal = "draft", 0, 0
        for _, _, act in sorted((r for r in rows if r[0] == user), key=lambda r: r[1]):
            to = C.TRANSITIONS.get((state, act))
            state, applied, illegal = (to, applied + 1, illegal) if to else (state, applied, illegal + 1)
        assert got.pop(user) == (state, applied, illegal)
    assert not got
    assert C.replay(events.limit(0), "user", ["at"], F.col("act")).count() == 0


def test_conflicts_of_a_hot_key(spark, many_ranges):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), i, rng.randint(0, 500), rng.choice(["x", "y", None])) for i in range(4000)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "k string, line long, rank long, v string").repartition(5)
    assert K.in_ranges(df.filter("k = 'hot'"), [F.col("k"), F.col("line")], "probe").select("_part").distinct().count() > 4  # one key, many tasks
    expected, best = set(), {}
    for k, line, rank, v in sorted(rows, key=lambda r: r[1]):
        if k in best and best[k][1] != v:
            expected.add((k, line, v, best[k][1]))
        if k not in best or rank < best[k][0]:
            best[k] = (rank, v)
    found = K.conflicts(df, ["k"], [F.col("rank")], F.col("line"), ["v"])
    assert {(r.k, r.line, r.v, r.best_v) for r in found.collect()} == expected
    assert K.conflicts(df.limit(0), ["k"], [F.col("rank")], F.col("line"), ["v"]).count() == 0


def files_of(path):
    return {p.relative_to(path).as_posix() for p in path.rglob("*.parquet") if "_upserts" not in p.parts and "_counts" not in p.parts}


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path, kind = tmp_path / "catalog", "record_id long, name string, country string, url string"
    first = spark.createDataFrame([(i, f"n{i}", ["US", "CA", "MX", None, "a/b=c"][i % 5], f"u{i}") for i in range(100)], kind)
    held = Catalog(spark, str(path), first.schema)
    assert held.read().count() == 0
    assert held.upsert(first, "0", F.lit(0)).groupBy("action").count().collect()[0]["count"] == 100
    state = {r.record_id: tuple(r) for r in first.collect()}
    before = files_of(path)
    rows = [(0, "new", "US", None), (200, "in", "US", "x"), (200, "worse", "MX", "y"), (3, "moved", "US", None), (None, "no key", "MX", "z")]
    incoming = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], kind + ", src int")
    changes = held.upsert(incoming, "1", F.col("src"), ["url"])
    assert {r.record_id: r.action for r in changes.collect()} == {0: "updated", 200: "inserted", 3: "updated"}
    state |= {0: (0, "new", "US", "u0"), 200: (200, "in", "US", "x"), 3: (3, "moved", "US", "u3")}
    assert {r.record_id: tuple(r) for r in held.read().collect()} == state
    after = files_of(path)
    touched = ("country=US", "country=__HIVE")
    assert {f for f in before if not f.startswith(touched)} == {f for f in after if not f.startswith(touched)}
    assert not {f for f in before if f.startswith(touched)} & after
    # The same batch again changes nothing, not even a file.
    held.upsert(incoming, "1", F.col("src"), ["url"])
    assert files_of(path) == after
    # The last row of a partition leaves: its folder goes.
    gone = spark.createDataFrame([(i, "x", "US", "v", 0) for i in range(100) if i % 5 == 4], kind + ", src int")
    held.upsert(gone, "2", F.col("src"))
    assert not any(f.startswith("country=a") for f in files_of(path)) and held.read().count() == 101


def test_upsert_is_finished_after_a_crash(spark, tmp_path, monkeypatch):
    kind = "record_id long, name string, country string"
    path = tmp_path / "catalog"
    first = spark.createDataFrame([(i, "a", ["US", "CA", "MX"][i % 3]) for i in range(30)], kind)
    held = Catalog(spark, str(path), first.schema)
    held.upsert(first, "0", F.lit(0))
    second = spark.createDataFrame([(i, "b", ["CA", "US"][i % 2]) for i in range(20)], kind)
    finish, calls = Catalog.finish, itertools.count()

    def crash_on_the_second_call(self):
        if next(calls):
            raise OSError("gone")
        finish(self)

    monkeypatch.setattr(Catalog, "finish", crash_on_the_second_call)
    with pytest.raises(OSError):
        held.upsert(second, "1", F.lit(0))  # staged, nothing swapped
    assert {r.name for r in held.read().collect()} == {"a"}
    monkeypatch.setattr(Catalog, "finish", finish)
    (path / "country=CA").rename(tmp_path / "lost")  # as if the swap had stopped after deleting
    held.upsert(second, "1", F.lit(0))
    expected = {r.record_id: tuple(r) for r in first.collect()} | {r.record_id: tuple(r) for r in second.collect()}
    assert {r.record_id: tuple(r) for r in held.read().collect()} == expected


def test_counts_follow_changes(spark, tmp_path):
    rng = random.Random(6)
    kind = "record_id long, name string, country string, verdict string"
    draw = lambda ids: [(i, rng.choice(["a", None]), rng.choice(["US", "CA", None]), rng.choice(["yes", "no", None])) for i in ids]
    held = Catalog(spark, str(tmp_path / "c"), spark.createDataFrame([], kind).schema)
    for batch, ids in enumerate((range(60), range(30, 90), range(0, 90, 7))):
        held.upsert(spark.createDataFrame(draw(ids), kind), str(batch), F.lit(0))
        for _ in range(2):  # repeated after a failure
            held.count_changes(str(batch), "by", ["country", "verdict"], {"nameless": F.col("name").isNull()})
    fresh = held.read().groupBy("country", "verdict").agg(F.count("*").alias("total"), F.count_if(F.col("name").isNull()).alias("n_nameless"))
    assert {tuple(r) for r in held.counts("by").select(*fresh.columns).collect()} == {tuple(r) for r in fresh.collect()}


def test_limiter_state_goes_with_the_watermark(spark, tmp_path):
    """Events arrive in any order within the delay; once the watermark is past, only the last event's user has state."""
    rng = random.Random(2)
    base = 1_700_000_000
    events = [(i, rng.choice([1, 1, 1, 2, 3]), base + i * 20 + rng.randint(0, 600)) for i in range(300)]
    batches = [events[:100], events[100:200], events[200:], [(9999, 7, base + 1_000_000)]]
    kind = "event_id long, user_id long, ts timestamp"
    frame = lambda rows: spark.createDataFrame([(e, u, t) for e, u, t in rows], "event_id long, user_id long, s long").select("event_id", "user_id", F.timestamp_seconds("s").alias("ts"))
    for rows in batches:
        frame(rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = J.rate_limit_stream(stream, "user_id", "ts", "event_id", 300, 3, "30 minutes")
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    J.finished(query, 300)
    got = {(r.event_id, r.accepted) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    expected = {(r.event_id, r.accepted) for r in J.rate_limit(frame(events), "user_id", "ts", "event_id", 300, 3).collect()}
    assert got == expected and len(query.recentProgress) >= 4
    state = query.recentProgress[-1]["stateOperators"][0]
    assert state["numRowsTotal"] <= 4  # the event that still waits, its timer and the time it is due


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [1, 3])
def test_near_names_are_all_found(spark, most):
    rng = random.Random(most)

    def bent(s):
        s = list(s)
        for _ in range(rng.randint(0, most + 1)):
            i = rng.randrange(len(s) + 1)
            s[i : i + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é", " "])
        return "".join(s)

    seeds = ["".join(rng.choices("ab c", k=n)) for n in (0, 1, 3, 5, 6, 8, 9, 12, 15, 30)] * 3
    names = [bent(rng.choice(seeds)) for _ in range(150)] + [None]
    rows = [(i, n, i % 2) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "id long, name string, block int")
    found = C.similar_names(df, "id", df.withColumnRenamed("id", "other"), "other", "name", ["block"], most)
    expected = {(a[0], b[0], d) for a in rows for b in rows if a[2] == b[2] and a[1] is not None and b[1] is not None and (d := edits(a[1], b[1])) <= most}
    assert {tuple(r) for r in found.collect()} == expected


def test_common_beginning_makes_few_candidates(spark):
    """Thousands of names of one block begin alike; what is compared grows with the names, not with their square."""
    rng = random.Random(9)
    rows = [(i, "summer camp of the north " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=14)), 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, name string, block int")
    counts = spark.createDataFrame([(n,) for _, n, _ in rows], "name string").select(F.explode(C.grams_of(F.col("name"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    rare = C.rare_grams(df, "id", "name", counts, 2)
    pairs = rare.groupBy("gram").agg((F.count("*") * F.count("*")).alias("n")).agg(F.sum("n")).first()[0]
    assert pairs < 2000 * 2000 / 10
    assert C.duplicate_pairs(df, "id", ["block"], "name", 2).count() == 0
