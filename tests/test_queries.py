"""Every query with SQL gives DuckDB's rows at the smallest scale; order of input rows never matters."""

import datetime
import random
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from leadlake import plans as P
from leadlake.operators import catalog as C
from leadlake.operators import keyed as K
from leadlake.streaming import jobs as J

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


def rows(df):
    cols = sorted(df.columns)
    text = lambda v: "" if v is None or v != v else f"{v:.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(text(v) for v in r) for r in df[cols].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(P.ORACLES))
def test_against_sql(spark, duck, name):
    assert rows(P.QUERIES[name](spark, SF).toPandas().replace({float("nan"): None})) == rows(duck.sql(P.ORACLES[name]).df().astype(object).where(lambda d: d.notna(), None))


@pytest.mark.parametrize("name", sorted(set(P.QUERIES) - set(P.ORACLES)))
def test_runs(spark, name):
    assert P.QUERIES[name](spark, SF).count() > 0


def test_keep_best_ignores_partitioning(spark):
    from pyspark.sql import functions as F

    data = [("k", i % 3, f"f{i}") for i in range(20)]
    results = {tuple(K.keep_best(spark.createDataFrame(d, "k string, p int, f string").repartition(n), ["k"], [F.col("p"), F.col("f")]).first()) for d, n in ((data, 1), (data[::-1], 5))}
    assert results == {("k", 0, "f0")}


def test_rate_limit_counts_only_accepted():
    assert J.admitted([0, 1, 2, 61, 61.5, 62], [], 60, 2) == [True, True, False, True, True, False]


def test_stream_dedupe_equals_batch(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    data = [(i % 5, datetime.datetime(2024, 1, 1, 0, i)) for i in range(20)]
    spark.createDataFrame(data, "k int, ts timestamp").repartition(4).write.parquet(str(source))
    for _ in range(2):  # a second run finds every file done
        stream = J.first_seen(spark.readStream.schema("k int, ts timestamp").parquet(str(source)), ["k"])
        J.process_once(stream, str(out), str(tmp_path / "c"), 120)
    assert sorted(r.k for r in spark.read.parquet(str(out)).collect()) == [0, 1, 2, 3, 4]


def test_a_stream_that_does_not_end_raises(spark):
    query = spark.readStream.format("rate").load().writeStream.format("noop").start()
    with pytest.raises(TimeoutError):
        J.finished(query, 1)


CALLBACK = """
import sys
from pyspark.sql import SparkSession
from leadlake.streaming import jobs
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.range(20).write.parquet(sys.argv[1] + "/in")
stream = spark.readStream.schema("id long").parquet(sys.argv[1] + "/in")
for _ in range(2):
    jobs.process_batches(stream, lambda df, _: df.write.mode("append").parquet(sys.argv[1] + "/out"), sys.argv[1] + "/c", 60)
assert spark.read.parquet(sys.argv[1] + "/out").count() == 20
"""


def test_callback_form_in_a_process_of_its_own(tmp_path):
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", CALLBACK, str(tmp_path)], check=True, timeout=180, cwd=root, capture_output=True)


def test_rank_does_not_depend_on_partitioning(spark):
    from pyspark.sql import functions as F

    data = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 1009).alias("v"))
    for n in (1, 7):
        rows = K.global_rank(data.repartition(n), [F.col("v").desc(), F.col("id")]).collect()
        assert [r.id for r in sorted(rows, key=lambda r: r["rank"])] == [r.id for r in sorted(rows, key=lambda r: (-r.v, r.id))]
        assert sorted(r["rank"] for r in rows) == list(range(1, 1001))


@pytest.mark.parametrize("most", [1, 2, 3])
def test_similar_names_finds_all(spark, most):
    rng = random.Random(most)
    names = ["".join(rng.choices("abc", k=rng.randint(0, 9))) for _ in range(120)]
    df = spark.createDataFrame([(i, n, i % 2) for i, n in enumerate(names)], "id long, name string, block int")
    found = {(r.x, r.y): r.distance for r in C.similar_names(df.withColumnRenamed("id", "x"), "x", df.withColumnRenamed("id", "y"), "y", "name", ["block"], most).collect()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    expected = {(i, j): edits(a, b) for i, a in enumerate(names) for j, b in enumerate(names) if i % 2 == j % 2 and edits(a, b) <= most}
    assert found == expected
