"""State and written indexes that grow with the input, not with its keys."""

from pyspark.sql import functions as F

from leadlake.sources import search as S
from leadlake.streaming import jobs as J


def test_stream_of_many_users_keeps_a_state_row_per_bucket(spark, tmp_path):
    rows = [(i, None if i % 300 == 299 else i % 300, 1_000_000 + 7 * (i // 3)) for i in range(3000)]
    frame = lambda part: spark.createDataFrame(part, "event_id long, user_id long, s long").select("event_id", "user_id", F.timestamp_seconds("s").alias("ts"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for k in range(3):
            frame([*rows[1000 * k : 1000 * k + 1000], (-k - 1, 5, None)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("event_id long, user_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        out = J.rate_limit_stream(stream, "user_id", "ts", "event_id", 1500, 2, "30 minutes", buckets=4)
        query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        J.finished(query, 300)
        got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("event_id", "user_id", F.unix_seconds("ts"), "accepted").collect()}
        past = rows[-1][2] - 1800
        wanted = {tuple(r) for r in J.rate_limit(frame([r for r in rows if r[2] <= past]), "user_id", "ts", "event_id", 1500, 2).select("event_id", "user_id", F.unix_seconds("ts"), "accepted").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == wanted and {a for *_, a in wanted} == {True, False}
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 4


def test_index_has_a_row_per_gram_and_batch(spark, tmp_path):
    df = spark.range(0, 2000, 1, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("The 𝔘mbrella "), F.col("id").cast("string"))).alias("text"), F.lit("È a").alias("source"))
    path = str(tmp_path / "index")
    S.write_index(df, "key", ["text", "source"], path)
    assert spark.read.parquet(f"{path}/postings").count() < 3000  # 2 batches of some 1,100 grams; 30,000 pairs
    for query in ("𝔘MB", "umbrella 19", "È A", "a 1999", "none such"):
        got = sorted(r.key for r in S.indexed_search(df, "key", ["text", "source"], path, query).collect())
        holds = lambda r: any(query.lower() in (v or "").lower() for v in (r.text, r.source))
        assert got == sorted(r.key for r in df.collect() if holds(r)), query
