from pyspark.sql import functions as F

from leadlake.sources import files, html


def test_scans(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\nbad\n{"a": 2}\n')
    assert sorted(r.a or 0 for r in files.jsonl_tolerant(spark, str(tmp_path / "a.jsonl"), "a int").collect()) == [0, 1, 2]
    (tmp_path / "l.txt").write_text("# x\n a \n\nb\n")
    assert [r.line for r in files.line_list(spark, str(tmp_path / "l.txt")).collect()] == ["a", "b"]
    (tmp_path / "d").mkdir()
    (tmp_path / "d/x.md").write_text("---\nname: N\nage: 3\n---\nbody\n")
    row = files.front_matter(spark, str(tmp_path / "d"), ["name", "age", "none"]).first()
    assert (row["name"], row.age, row.none, row.body.strip()) == ("N", "3", None, "body")
    (tmp_path / "e.json").write_text('{"scan": "s", "items": [{"a": 1}, {"a": 2, "scan": "own"}]}')
    both = files.exploded(spark.read.schema("scan string, items array<struct<a: int>>").json(str(tmp_path / "e.json")), "items", "scan")
    assert sorted((r.scan, r.a) for r in both.collect()) == [("s", 1), ("s", 2)]
    (tmp_path / "f.json").write_text('[{"a": 1}, {"a": 5}]')
    assert sorted(r.a for r in files.json_array(spark, str(tmp_path / "f.json"), "a int").collect()) == [1, 5]
    (tmp_path / "m").mkdir()
    (tmp_path / "m/x.jsonl").write_text('{"source_url": "u", "z": 1}\n{"resolved_url": "v"}\n')
    assert sorted((r.source_url or "", r.resolved_url or "") for r in files.manifest_urls(spark, str(tmp_path / "m")).collect()) == [("", "v"), ("u", "")]


def test_missing_file_is_empty(spark, tmp_path):
    assert files.jsonl(spark, str(tmp_path / "none"), "a int").count() == 0


def test_table_function(spark):
    html.register(spark)
    spark.createDataFrame([("<title>T</title><p>x",), (None,)], "html string").createOrReplaceTempView("some_pages")
    assert sorted(map(tuple, spark.sql("SELECT title, markdown FROM some_pages, LATERAL extract_content(html)").collect())) == [("", ""), ("T", "x")]


def test_summary(spark, tmp_path):
    files.write_summary(spark.createDataFrame([('{"a":1}',)], "summary string"), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).first().a == 1


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, w string")
    new = spark.createDataFrame([(2, "c", "p", 1), (2, None, None, 0), (3, "e", "q", 0)], "id int, v string, w string, p int")
    rows = files.upserted(old, new, "id", F.col("p"), ["w"])
    assert sorted(map(tuple, rows.collect())) == [(1, "a", "x", "kept"), (2, None, "y", "updated"), (3, "e", "q", "inserted")]
    assert {r.action: r.n for r in files.action_counts(rows).collect()} == {"kept": 1, "updated": 1, "inserted": 1}


def test_evidence_index(spark, tmp_path):
    (tmp_path / "x.md").write_text("---\nsource_url: https://www.e.org/a\ntitle: T\n---\none two\n\nthree\n")
    row = files.evidence_index(files.front_matter(spark, str(tmp_path), ["source_url", "title", "resolved_host"])).first()
    assert (row.resolved_host, row.source_host, row.title, row.body_preview) == ("www.e.org", "www.e.org", "T", "one two three")
    assert (row.body_word_count, row.body_line_count, row.body_length_chars, row.evidence_status) == (3, 3, 15, "indexed")


def test_main_content():
    page = '<html lang="en"><head><title> T </title><meta name="description" content=" D  d "><link rel="canonical" href="/c"></head><body><nav>menu</nav><main><h1>Head</h1><p>Text <b>bold</b> and <a href="/x">a link</a></p><ul><li>x</ul><ol><li>y</li><li>z</li></ol></main><footer>f</footer>'
    assert html.parse(page) == {"title": "T", "description": "D d", "canonical": "/c", "lang": "en", "markdown": "# Head\n\nText **bold** and [a link](/x)\n\n- x\n\n1. y\n\n2. z"}
    assert html.parse(None) == dict.fromkeys(html.FIELDS, "")


def test_best_block():
    long = "word " * 60
    page = f"<body><div><a>1</a><a>2</a></div><section><p>{long}</p></section><header>kept</header><script>s</script></body>"
    assert html.parse(page)["markdown"] == long.strip()  # links count against the body
    assert html.parse(page.replace("kept", "kept as it is"))["markdown"].endswith("kept as it is")  # else it scores more than the section
    assert html.parse("<body><p>short</p></body>")["markdown"] == "short"


def test_deep_nesting():
    page = "<div>" * 30_000 + "<script>no</script><h2>deep</h2>" + "</div>" * 30_000 + "</x>" * 1000 + "<p>end"
    assert html.parse(page)["markdown"] == "## deep\n\nend"


def test_canonical_meta(spark):
    rows = [("https://e.org/a/b?x", "/c", "https://e.org/c"), ("https://e.org/a/b", "c/", "https://e.org/a/c"), ("https://e.org", "c", "https://e.orgc"), ("https://e.org/", "http://www.f.org", "http://f.org/"), ("https://e.org/", "", None)]
    rows[2] = ("https://e.org/", "c", "https://e.org/c")
    df = spark.createDataFrame(rows, "u string, c string, e string")
    assert all(r.e == r.f for r in df.withColumn("f", html.canonical_meta(F.col("u"), F.col("c"))).collect())


def test_result_links():
    page = '<table><tr><td><a class="result-link" href="//duckduckgo.com/l/?uddg=https%3A%2F%2Fe.org&amp;r=1"> A <i>b</i> </a></td></tr><tr><td class="result-snippet">S <b>t</b></td></tr><tr><td><a class="result-link" href="/x">More info</a></td></tr></table>'
    assert html.result_links(page) == [(1, "A b", "//duckduckgo.com/l/?uddg=https%3A%2F%2Fe.org&r=1", "S t"), (2, "More info", "/x", "")]
