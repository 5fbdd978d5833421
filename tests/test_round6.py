"""Work that is done once, whatever is asked of it."""

from pyspark.sql import functions as F

from leadlake.functions.text import ascii_fold
from leadlake.operators import candidates as N


def test_query_index_computes_its_records_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def asked(i):
        seen.add(1)
        return [f"q{i % 3}", f"q{i % 3}", None, f"r{i}"]

    rows = spark.range(30).select(asked("id").alias("queries"), F.lpad(F.col("id").cast("string"), 2, "0").alias("candidate_id"), F.lit("n").alias("name"), F.when(F.col("id") % 2 == 0, "h").alias("host"))
    got = {r.query: r for r in N.query_index(rows).collect()}
    assert seen.value == 30
    assert len(got) == 34 and got["q1"].candidate_ids == [f"{i:02}" for i in range(1, 30, 3)] and got["q1"].n == 20 and got["q1"].hosts == ["h"] and got["r7"].hosts == [] and got[None].n == 30


def test_ascii_fold_of_plain_and_other_text(spark):
    texts = [None, "", "Plain - text_1", "Café Ñandú", "日本 a", "\x00\x7f\x80", "𝔘mbrella"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "v string").coalesce(1).select(ascii_fold(F.col("v"))).collect()]
    assert got == [None, "", "Plain - text_1", "Cafe Nandu", " a", "\x00\x7f", "mbrella"]
