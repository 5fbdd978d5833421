"""Written indexes, large rule packs, reports of any size, topics of any depth."""

import json
import random

import pytest
from pyspark.sql import functions as F

from leadlake import rules as R
from leadlake.functions import extract as X
from leadlake.functions.automaton import tagged
from leadlake.functions import automaton
from leadlake.operators import candidates as N
from leadlake.sources import files as Files
from leadlake.sources import search as S


def test_index_equals_scan(spark, tmp_path):
    rng = random.Random(1)
    words = ["camp", "Über", "été", "a", "no", "...", "\n", "x" * 50, "lodge 12"]
    rows = [(i, rng.choice([None, "", " ".join(rng.choices(words, k=rng.randint(1, 9)))]), rng.choice(words + [None])) for i in range(300)] + [(7, "camp camp", None), (None, "camp", None)]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    S.write_index(df, "id", ["a", "b"], str(tmp_path / "i"))
    for q in ("camp", "ÜBER", "été a", "p l", "a", "no", "", "xxxx", "zzz", "camp\n", "%_", "camp camp"):
        expected = sorted(r[0] for r in rows if r[0] is not None and any(q.lower() in (v or "\0").lower() for v in r[1:] if v is not None))
        found = [r.id for r in S.indexed_search(df, "id", ["a", "b"], str(tmp_path / "i"), q).collect()]
        assert sorted(i for i in found if i is not None) == expected, q
    empty = df.limit(0)
    S.write_index(empty, "id", ["a", "b"], str(tmp_path / "e"))
    assert S.indexed_search(empty, "id", ["a", "b"], str(tmp_path / "e"), "camp").count() == 0


def test_page_reads_its_ranges_only(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    rows = [(i, (i * 7919) % 1000) for i in range(2000)]
    S.write_sorted(spark.createDataFrame(rows, "id long, v long"), [F.col("v").desc(), F.col("id").asc()], str(tmp_path / "s"))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    for number in (1, 2, 17, 67, 68):
        page = S.sorted_page(spark, str(tmp_path / "s"), number, 30)
        assert [tuple(r) for r in page.collect()] == ordered[(number - 1) * 30 : number * 30]
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan or number == 68
    folders = sorted((tmp_path / "s" / "rows").glob("range=*"))
    page = [r.id for r in S.sorted_page(spark, str(tmp_path / "s"), 2, 30).collect()]
    held = {r.range for r in spark.read.parquet(str(tmp_path / "s" / "rows")).filter(F.col("id").isin(page)).select("range").collect()}
    assert len(folders) > 4 and len(held) <= 2
    for folder in folders:  # no other range is needed
        if int(folder.name.removeprefix("range=")) not in held:
            folder.rename(tmp_path / folder.name)
    assert [r.id for r in S.sorted_page(spark, str(tmp_path / "s"), 2, 30).collect()] == page


@pytest.mark.parametrize("most", [8 << 20, 40])
def test_automaton_equals_tags(spark, monkeypatch, most):
    monkeypatch.setattr(automaton, "MOST_CHARS", most)  # the second cuts a pack into many automata
    rng = random.Random(2)
    pieces = [n for pack in (R.FAMILIES, R.CAMP_TYPES) for n, _ in pack.pairs] + ["Éclair", "x", "science-fair", "camps", "été", "été2", "²"]
    rows = [(i, rng.choice([None, "", "".join(rng.choice(pieces) + rng.choice(["", " ", "-", "_", "."]) for _ in range(rng.randint(1, 6))).title()])) for i in range(300)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "id long, text string, other string")
    words = R.TagRules((("camp", "c"), ("été", "e"), ("science", "s"), ("camp", "again"), ("a", "c")), None, True)
    for pack in (R.FAMILIES, R.CAMP_TYPES, words, R.TagRules((("b", "x"), ("", "every"), ("a", "x")), "none")):
        got = tagged(df, F.col("text"), pack, "tags").select("id", "tags", "other")
        expected = df.select("id", X.tags(F.col("text"), pack).alias("tags"), "other")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert tagged(df.limit(0), F.col("text"), R.FAMILIES, "tags").count() == 0


def test_a_hundred_thousand_needles(spark):
    pack = R.TagRules(tuple((f"needle{i:06d}", f"tag{i % 1000}") for i in range(100_000)), "none")
    df = spark.createDataFrame([(i, f"has Needle{i * 37 % 100_000:06d} and needle{i:06d}.") for i in range(500)], "id long, text string")
    got = {r.id: r.tags for r in tagged(df, F.col("text"), pack, "tags").collect()}
    for i, found in got.items():
        rules = sorted({i * 37 % 100_000, i})
        assert found == list(dict.fromkeys(f"tag{r % 1000}" for r in rules))


def test_reports_are_split(spark, tmp_path):
    """Lines keep their numbers when a file is read in many splits; blank lines don't count."""
    rows = [json.dumps({"candidate_id": f"c{i}", "name": f"Name {i} " + "x" * (i % 90)}) for i in range(3000)]
    (tmp_path / "big.jsonl").write_text("\n\n".join(rows) + "\n \n")
    (tmp_path / "list.json").write_text(json.dumps([{"name": f"n{i}"} for i in range(50)]))
    (tmp_path / "half.json").write_text('[{"name": "a"}, {"name"')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        scan = N.scan_reports(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert scan.lines.select("block").distinct().count() > 10
    kinds = N.report_kinds(scan)
    assert {r.file: r.kind for r in kinds.collect()} == {"big.jsonl": "candidates", "list.json": "array", "half.json": "skip"}
    got = N.report_rows(scan, kinds).select("file", "line", "candidate_id", "name").collect()
    assert sorted((r.line, r.candidate_id) for r in got if r.file == "big.jsonl") == [(i + 1, f"c{i}") for i in range(3000)]
    assert sorted((r.line, r.name) for r in got if r.file == "list.json") == [(i + 1, f"n{i}") for i in range(50)]


def test_topics_of_any_depth(spark):
    topic = lambda name: {"FirstURL": f"u/{name}", "Text": name}
    deep = topic("deepest")
    for i in range(20):
        deep = {"Name": "n", "Topics": [topic(f"before {i}"), deep, {"FirstURL": "", "Text": "no url"}, {"Name": "empty"}]}
    payloads = [{"AbstractURL": "u/a", "Heading": "", "AbstractText": "t", "Results": [topic("r"), {"Text": "none"}], "RelatedTopics": [deep, topic("last")]}, {"RelatedTopics": []}, {"Results": None}]
    rows = [(i, json.dumps(p)) for i, p in enumerate(payloads)] + [(8, None), (9, "no json"), (9, json.dumps({"Results": [topic("twice")]})), (9, json.dumps({"Results": [topic("twice")]}))]
    got = Files.answer_hits(spark.createDataFrame(rows, "id long, payload string"), "payload", "id").collect()
    order = []

    def walk(t):
        if t.get("FirstURL") is not None:
            order.append(t)
        else:
            for x in t.get("Topics", []):
                walk(x)

    for t in payloads[0]["RelatedTopics"]:
        walk(t)
    expected = [(0, "abstract", 1, "u/a", "u/a", "t"), (0, "results", 1, "r", "u/r", "r")] + [(0, "related_topics", k, t["Text"], t["FirstURL"], t["Text"]) for k, t in enumerate(order, 1) if t["FirstURL"]]
    assert sorted(map(tuple, got)) == sorted(expected + [(9, "results", 1, "twice", "u/twice", "twice")] * 2)
    assert Files.answer_hits(spark.createDataFrame([], "id long, payload string"), "payload", "id").count() == 0
