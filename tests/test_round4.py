"""Rows that the tables of the smallest scale don't hold, against the queries' SQL."""

import datetime

import duckdb

from leadlake import plans as P
from leadlake.sources import html as H


def both(spark, tmp_path, name, **tables):
    """A query's rows and those of its SQL over the given tables, in one order."""
    c = duckdb.connect()
    for t, df in tables.items():
        df.coalesce(1).write.parquet(str(tmp_path / f"{t}.parquet"))
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    out = P.QUERIES[name](spark, str(tmp_path))
    cols = sorted(out.columns)
    told = lambda rows: sorted(map(repr, rows))
    return told(tuple(r) for r in out.select(cols).collect()), told(c.sql(f"SELECT {', '.join(cols)} FROM ({P.ORACLES[name]})").fetchall())


def test_subpages_of_prices_like_years_times_of_a_day_and_large_keys(spark, tmp_path):
    day = datetime.datetime
    rows = [(5, 1, 2025.5, day(2024, 1, 2)), (9, 2, 70.0, day(2024, 1, 2, 8)), (21, 2, 80.0, day(2024, 1, 2, 9)), (9 + 12 * 10**9, 3, 90.0, day(2024, 1, 3)), (33, 3, 95.0, day(2024, 1, 2)), (45, 4, 60.0, None), (57, 4, 65.0, day(2024, 1, 2)), (1 + 12, 5, 0.5, day(2024, 1, 2))]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz")
    customer = spark.createDataFrame([(k,) for k in (1, 2, 3)], "c_custkey long")
    got, wanted = both(spark, tmp_path, "enrich_subpages", orders=orders, customer=customer)
    assert got == wanted and len(got) == 4


def test_page_heads_of_cut_references(spark, tmp_path):
    html = '<html lang="en"><head><title>a&amp;b &amp</title></head><body><nav><h1>no</h1></nav><article><h1>x &lt;y&gt; &quot;z&quot; &amp;amp &ampc</h1><p>t</p></article></body></html>'
    got, wanted = both(spark, tmp_path, "page_heads", pages=spark.createDataFrame([(1, "https://e.org/", html)], "page_id long, url string, html string"))
    assert got == wanted
    assert H.parse("<p>&#233; &eacute; R&D; &x &#; <a href='/?a=1&b=2&copy=3'>q</a></p>")["markdown"] == "é é R&D; &x &#; [q](/?a=1&b=2&copy=3)"


def test_page_profile_of_a_page_with_other_addresses(spark, tmp_path):
    html = "<html lang='en'><title>t</title><body><p>Write to x.1@mail7.example.</p>"
    got, wanted = both(spark, tmp_path, "page_profile", pages=spark.createDataFrame([(7, "https://e.org/", html)], "page_id long, url string, html string"))
    assert got == wanted


def test_work_on_one_partition_is_dealt_over_the_cores(spark):
    from pyspark.sql import functions as F

    from leadlake.operators import candidates as N
    from leadlake.operators import enrichment as E
    from leadlake.operators import queues as Q
    from leadlake.plans import enriched

    lone = spark.range(0, 2000, 1, 1)
    parts = lone.select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), (F.col("id") % 50).cast("int").alias("p_size"), F.lit(1.5).alias("p_retailprice"))
    spread = {
        "normalised": N.normalised(lone.select(F.col("id").cast("string").alias("name")), 2024), "phase1": E.phase1(enriched.candidates(lambda _: parts)),
        "query_plan": Q.query_plan(lone.select(F.col("id").cast("string").alias("seed"), F.col("id").alias("seed_order")), Q.query_templates(spark)),
    }
    for name in ("normalised", "phase1"):
        assert spread[name].select(F.spark_partition_id().alias("p")).distinct().count() >= 8, name
    assert "RoundRobinPartitioning" in spread["query_plan"]._jdf.queryExecution().executedPlan().toString()


def test_duplicate_probe_lists_every_copy(spark, tmp_path):
    rows = [(k, n, "B", "T", 1, 1.0) for k, n in ((1, "red bolt"), (2, "red bolt"), (3, "red bolt"), (4, "red volt"), (5, "blue gear"), (1001, None))]
    part = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    got, wanted = both(spark, tmp_path, "duplicate_probe", part=part)
    assert got == wanted and len([x for x in got if "'name'" in x]) == 17


def test_payloads_of_one_partition_are_dealt_over_the_cores(spark):
    from pyspark.sql import functions as F

    from leadlake.sources import files as Files

    payload = F.lit('{"RelatedTopics":[{"FirstURL":"https://e.org/","Text":"t"}]}')
    hits = Files.answer_hits(spark.range(0, 2000, 1, 1).select("id", payload.alias("payload")), "payload", "id")
    assert len([f for f in hits.inputFiles() if "payloads-" in f]) >= 8 and hits.count() == 2000
