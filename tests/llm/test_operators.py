import base64
import hashlib
import os
import random
import struct
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from leadlake.llm import bpe, forest, graph, induction, mixing, quality, repeats, simhash, substring, suffix, tokencount, urlfilter, warc
from tests.llm import brute

RANKS, MODEL = P.path("byte_bpe_multi_50k.tiktoken"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, source string, kept string, fp string, n_tokens string, _row int, _batch int"


def texts():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefgé", k=rng.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, page = prose(60), prose(300)
    out = [None, "", " \n\t ", "One", "One two", "Ünï <|endoftext|> <s> </s>  two  blanks\r\n\r\n", page, page, page + " End", page.replace(" ", "\n", 5), prose(40) + " " + passage + " " + prose(90), passage + "\n" + prose(200)]
    out += [prose(rng.randint(20, 200)) for _ in range(12)]
    return out + ["ab " * 400, "x" * 5000, prose(40_000), "line one here\nline one here\n\n" * 5, "".join(chr(rng.randint(33, 0x2FF)) for _ in range(6000)), passage + " " + passage]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["a", "b", None, "é"][i % 4], "k", "f", "t", i, 0) for i, t in enumerate(texts())]
    return spark.createDataFrame([*rows, rows[6], (None, "no id here", "a", "k", "f", "t", 0, 0)], SCHEMA).repartition(3)


def by_text(rows):
    """Rows by (id, text)."""
    return {(r.doc_id, r.text): r for r in rows}


def keep(docs, *extra):
    return docs.select("doc_id", "text", "source", *extra)


def test_bpe(spark, docs):
    encoding = bpe.load_encoding(RANKS, P.PATTERN)
    rows = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = encoding.encode_ordinary(r.text or "")
        assert bytes(r.token_ids) == struct.pack(f"<{len(ids)}I", *ids) and r.n_tokens == len(ids) and bytes(r.decoded) == (r.text or "").encode()
    assert isinstance(encoding, tiktoken.Encoding)
    for t in ("ab c\n" * 50_000, "  \n\n x" * 30_000, "don't " * 30_000 + "x" * 40_000):
        assert bpe.encode_text(encoding, t, 1000).tolist() == encoding.encode_ordinary(t)


def test_quality(docs):
    for r in quality.quality(docs).collect():
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == brute.base_counts(r.text)
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_bands(spark):
    rng = random.Random(1)
    noise = " ".join("".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(8)) for _ in range(3000))
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000))
    ramp = " ".join(f"{i % 97}x{'y' * 80}{i}" for i in range(3000))
    rows = {r.k: r for r in quality.quality(spark.createDataFrame([("noise", noise), ("prose", prose), ("ramp", ramp)], "k string, text string")).collect()}
    assert rows["prose"].kept and not rows["noise"].kept and not rows["ramp"].kept and rows["ramp"].ratio < 0.08


def test_quality_bands_decide(spark):
    """Noise, encoded and templated texts that pass the base rule are rejected, prose of any script is not."""
    rng = random.Random(7)
    join = lambda word, n, sep=" ": sep.join(word() for _ in range(n))
    base64_word = lambda: base64.b64encode(rng.randbytes(rng.randint(3, 9))).decode().strip("=")
    lines = lambda n: "\n".join(base64.b64encode(rng.randbytes(57)).decode() for _ in range(n))
    stock = ["".join(rng.choices("etaoinshrdlucmfwyp", range(18, 0, -1), k=rng.randint(2, 9))) for _ in range(2000)]
    prose = lambda n: " ".join(rng.choices(stock, range(2000, 0, -1), k=n))
    georgian = str.maketrans({c: chr(0x10D0 + i) for i, c in enumerate("etaoinshrdlucmfwyp")})
    template = lambda n: "\n".join(f"Item {i * 7919 % 9973} costs {i * 31} dollars today" for i in range(n))
    bad = [join(base64_word, n) for n in (56, 150, 400, 4000)] + [lines(n) for n in (52, 100, 2000)] + [template(n) for n in (60, 200, 3000)]
    bad += [join(lambda: "".join(chr(rng.randint(33, 126)) for _ in range(7)), n) for n in (55, 200, 3000)]
    bad += [join(lambda: "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(4)), n) for n in (60, 200, 3000)]
    bad += [prose(3000) + "\n" + lines(110), prose(1500) + "\n" + template(250)]  # by the share of chunks
    good = [t for n in (60, 120, 250, 600, 3000, 12_000) for x in [prose(n)] for t in (x, x.translate(georgian))]
    good += [prose(3000) + "\n" + lines(30)]
    rows = quality.quality(spark.createDataFrame(list(enumerate([*bad, *good])), "k long, text string")).orderBy("k").collect()
    assert not any(r.base_failed for r in rows)
    assert [r.kept for r in rows] == [False] * len(bad) + [True] * len(good)


def test_bands_fitted_on_good_texts(spark):
    """Marked-up prose lies under prose in every length; only labelled texts tell. Texts without a label are judged as well, other scripts by the general limits."""
    rng = random.Random(17)
    stock = ["".join(rng.choices("etaoinshrdlucmfwyp", range(18, 0, -1), k=rng.randint(2, 9))) for _ in range(2000)]
    words = lambda n: rng.choices(stock, range(2000, 0, -1), k=n)
    georgian = str.maketrans({c: chr(0x10D0 + i) for i, c in enumerate("etaoinshrdlucmfwyp")})
    rows = []
    for k in range(3000):
        n = int(90 * 8 ** rng.random())
        text = " ".join(words(n)) if k % 5 else " ".join(w + "###" for w in words(n))
        rows.append((k, text.translate(georgian) if k % 50 == 1 else text, "own"))
    docs = spark.createDataFrame([*rows, (None, "x", "own"), (5000, None, "own")], "doc_id long, text string, script string")
    labels = spark.createDataFrame([(k, int(k % 5 > 0)) for k in range(0, 3000, 2)] + [(None, 1), (3, None), (4, 1), (4, 1), (9999, 1)], "doc_id long, quality int")
    bands = quality.fit_bands(docs, labels)
    assert bands.fitted and {s for s, _, _ in bands.fitted} == {1}
    out = quality.quality(docs, bands=bands)
    assert out.columns[:3] == ["doc_id", "text", "script"] and {r.script for r in out.collect()} == {"own"}
    kept = {r.doc_id: r.kept for r in out.filter("not base_failed").collect()}
    bad, good = [v for k, v in kept.items() if k % 5 == 0], [v for k, v in kept.items() if k % 5]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.4 * len(bad) and len(bad) > 200
    assert all(v for k, v in kept.items() if k % 50 == 1)
    assert quality.fit_bands(docs, labels.filter("false")) == quality.Bands() == quality.fit_bands(docs.filter("false"), labels)
    assert len(quality.fit_bands(docs, labels, most=300).fitted) <= len(bands.fitted)


def test_token_counts(docs):
    p, _ = tokencount.load_processor(MODEL)
    for r in tokencount.count_tokens(docs, MODEL).collect():
        n = len(p.encode(r.text or ""))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 4096)
    for t in ("a b  c " * 3000, "ü x\n" * 4000, "z" * 30_000 + " y" * 9000):
        assert tokencount.count_batch([t], MODEL)[0] == len(p.encode(t))


def test_substring(docs):
    rows = substring.dedup_substrings(docs).collect()
    words = [tuple(brute.words(r.text)) for r in rows]
    for r, w, hit in zip(rows, words, brute.repeated(words, 35), strict=True):
        kept = " ".join(x for x, h in zip(w, hit, strict=True) if not h)
        assert (r.n_words, r.n_removed, r.kept_text) == (len(w), sum(hit), kept)
    assert sum(r.n_removed for r in rows) > 1000


def test_bytes(docs):
    rows = suffix.dedup_bytes(docs.filter("length(coalesce(text, '')) < 20000")).collect()
    raw = [(r.text or "").encode() for r in rows]
    for r, b, hit in zip(rows, raw, brute.repeated(raw, 400), strict=True):
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(b), sum(hit), spans, bytes(x for x, h in zip(b, hit, strict=True) if not h))
    assert sum(r.n_removed for r in rows) > 1000


@pytest.mark.parametrize("window", [5, 9, 20])
def test_short_windows(spark, window):
    rng = random.Random(window)
    data = spark.createDataFrame([(i, " ".join(rng.choices("abc", k=rng.randint(0, 60)))) for i in range(40)], "doc_id long, text string")
    rows = substring.dedup_substrings(data, window=window, batch_bytes=200).collect()
    words = [tuple(brute.words(r.text)) for r in rows]
    assert [r.n_removed for r in rows] == [sum(h) for h in brute.repeated(words, window)]
    rows = suffix.dedup_bytes(data, window=2 * window, batch_bytes=200).collect()
    assert [r.n_removed for r in rows] == [sum(h) for h in brute.repeated([r.text.encode() for r in rows], 2 * window)]


def suffixes(text):
    order = sorted(range(len(text) - 1), key=lambda i: text[i:])[::-1]
    return [(b, 0 if k == 0 else len(os.path.commonprefix([text[order[k - 1] :], text[b:]]))) for k, b in enumerate(order)]


@pytest.mark.parametrize("memory_rows", [10, 1 << 20])
def test_induced_sorting(tmp_path, memory_rows):
    rng = random.Random(memory_rows)
    for symbols in [1, 2, 3, 30, 500] * 8:
        text = [rng.randint(1, symbols) for _ in range(rng.randint(0, 200))]
        text += text[: len(text) // 2] * rng.randint(0, 2) + [0]
        rows = []
        induction.suffix_order(np.array(text, np.uint16), max(text) + 1, str(tmp_path), lambda at, lcp: rows.extend(zip(at.tolist(), lcp.tolist(), strict=True)), memory_rows)
        assert rows == suffixes(text)


def test_larger_shard_uses_disk_and_recursion(tmp_path, monkeypatch):
    """With default ``memory_rows`` the pieces of 12 MB of text, 0.17 bytes a byte of it, go through files and recursive induction, as those of
    every shard do beyond MOST_SHARDS of SHARD_BYTES. The pieces are cut from real documents."""
    import pyarrow.parquet as pq

    words = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist()
    base = np.frombuffer("".join(t or "" for t in words).encode(), np.uint8).astype(np.int32) + 2
    starts = np.random.default_rng(6).integers(0, len(base) - 500, int(0.17 * (12 << 20) / 500))
    text = np.append(np.concatenate([np.append(base[s : s + 499], 1) for s in starts]), 0)
    depth, spilled, doubled, inner, take, plain = [], [], [], induction.suffix_order, induction.Queue.take, induction.doubled
    monkeypatch.setattr(induction, "suffix_order", lambda *a: (depth.append(len(a[0])), inner(*a)))
    monkeypatch.setattr(induction, "doubled", lambda names: (doubled.append(len(names)), plain(names))[1])
    monkeypatch.setattr(induction.Queue, "take", lambda self, b: (spilled.append(len(self.read)), take(self, b))[1])
    again = suffix.LeastGram().repeated(text, str(tmp_path))
    assert depth and max(doubled, default=0) <= suffix.MEMORY_ROWS and max(spilled) > 10 and not list(tmp_path.iterdir())
    every = text.astype("<u2").tobytes()
    for s in range(0, 20_000, 97):
        window, at = every[2 * s : 2 * s + 800], []
        while len(at) < 2 and (found := every.find(window, at[-1] + 1 if at else 0)) >= 0:
            at.append(found)
        assert again[s] == (1 not in text[s : s + 400] and sum(i % 2 == 0 for i in at) > 1)


def test_positions_of_32_bits(tmp_path):
    with pytest.raises(ValueError, match="too many"):
        induction.suffix_order(np.lib.stride_tricks.as_strided(np.zeros(1, np.int32), (induction.MOST_SYMBOLS + 1,), (0,)), 258, str(tmp_path), lambda *_: None)


@pytest.mark.parametrize(("memory_rows", "dense"), [(1 << 22, 1 << 14), (50, 1 << 14), (50, 3)])
def test_bytes_in_shards(spark, memory_rows, dense):
    """Shared passages between different neighbours, in shards larger than memory and with cores too frequent for a shard."""
    rng = random.Random(dense)
    passage = "".join(rng.choices("abcdé ", k=90))
    texts = ["".join(rng.choices("ab ", k=rng.randint(0, 30))) + passage[rng.randint(0, 20) : rng.randint(60, 90)] + "".join(rng.choices("ab ", k=rng.randint(0, 30))) for _ in range(60)]
    data = spark.createDataFrame(list(enumerate([*texts, "a" * 300, "", None, *texts[:3]])), "doc_id long, text string")
    rows = suffix.dedup_bytes(data, window=48, batch_bytes=500, memory_rows=memory_rows, dense=dense).collect()
    raw = [(r.text or "").encode() for r in rows]
    assert len(rows) == 66
    for r, b, hit in zip(rows, raw, brute.repeated(raw, 48), strict=True):
        assert (r.n_removed, bytes(r.kept)) == (sum(hit), bytes(x for x, h in zip(b, hit, strict=True) if not h))
    assert 1000 < sum(r.n_removed for r in rows) < sum(map(len, raw))


@pytest.mark.parametrize("hot", [1, 256])
def test_simhash(docs, hot):
    rows = simhash.near_duplicates(simhash.add_fingerprints(docs.filter("doc_id is not null")), hot=hot).collect()
    prints = [brute.fingerprint(r.text) for r in rows]
    assert [r.fp % (1 << 64) for r in rows] == prints
    expected = brute.components([r.doc_id for r in rows], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    assert [r.component_id for r in rows] == expected and len(set(expected)) < len(expected)


def test_simhash_dense_group(spark):
    rng = random.Random(2)
    prints = [rng.getrandbits(64)]
    while len(prints) < 300:
        prints.append(rng.choice(prints) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) if rng.random() < 0.9 else rng.getrandbits(64))
    data = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)], "doc_id long, fp long")
    expected = brute.components(list(range(300)), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    for hot in (4, 1000):
        assert [r.component_id for r in simhash.near_duplicates(data, hot=hot).orderBy("doc_id").collect()] == expected


def test_keep_one(docs):
    kept = [r.doc_id for r in simhash.keep_one(simhash.add_fingerprints(docs)).collect()]
    heads = {r.component_id for r in simhash.near_duplicates(simhash.add_fingerprints(docs)).collect()}
    assert sorted(kept, key=str) == sorted(heads, key=str)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100), (7, 7), (None, 5), (200, 100)]
    found = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 200: 100}


def test_components_of_adversarial_paths(spark):
    """Sorted, reversed, rotated and shuffled paths of 5,000 nodes, a star and its like: few rounds, no limit to run into."""
    rng, n = random.Random(9), 5000
    zigzag = [x for i in range(n // 2) for x in (i, n - 1 - i)]
    paths = [list(range(n)), [*range(n)][::-1], [0, *range(n - 1, 0, -1)], zigzag, rng.sample(range(n), n)]
    edges = [(k * n + a, k * n + b) for k, p in enumerate(paths) for a, b in zip(p, p[1:])]  # noqa: B905
    edges += [(len(paths) * n + 77, len(paths) * n + i) for i in range(n) if i != 77]
    found = graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == n * (len(paths) + 1) and all(r.component == r.node // n * n for r in found)


def test_mixing(spark, docs):
    rows = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "source").collect()
    c = duckdb.connect()
    documents = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
    c.register("documents", documents.astype({"doc_id": "Int64"}))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((key((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken)) for r in rows)) == sorted(key((a, b, s, round(t, 6), n)) for a, b, s, t, n in c.sql(mixing.SQL).fetchall())
    assert all(0 <= r.copies <= 3 and r.target <= 3 * r.source_size + 1e-6 for r in rows)
    targets = {r.source: r.target for r in rows}
    assert abs(sum(targets.values()) - sum(r["size"] for r in rows)) < 1e-6
    assert mixing.emit(mixing.mix(docs), ["doc_id"]).count() == sum(r.copies for r in rows)


def test_mixing_comes_near_targets(spark):
    data = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"))
    rows = mixing.mix(data).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.05 * r.target for r in rows)


def test_urls(spark):
    urls = [None, "", "no scheme", "https://www.EXAMPLE.com/en/a?x#y", "http://a.example.com/en/", "http://example.com/EN/", "https://com/", "https://x.com", "http://notexample.net/es/q", "http://net/fr/#f", "ftp://b.org/en/?http://x", "http://a.com:80/p", "//x.com/y", "http://c.com?q=/en/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*urls, urls[3]])], "page_id long, url string, host string")
    c = duckdb.connect()
    c.register("pages", pages.select("page_id", "url").toPandas())
    columns = ["page_id", "host", "path", "rule", "verdict"]
    ours = sorted(map(tuple, urlfilter.filter_urls(pages, urlfilter.production_rules(spark)).select(*columns).collect()))
    assert ours == sorted(c.sql(f"SELECT {', '.join(columns)} FROM ({urlfilter.SQL})").fetchall())


@pytest.mark.parametrize("most", [urlfilter.BROADCAST_FILTER_BYTES, 0])
def test_many_url_rules(spark, monkeypatch, most):
    """The second time the filter is too large to broadcast."""
    monkeypatch.setattr(urlfilter, "BROADCAST_FILTER_BYTES", most)
    rng = random.Random(3)
    rules = {(f"h{rng.randrange(300)}.org", rng.choice(["", "/", "/a", "/a/b/"])): rng.choice(["allow", "block"]) for _ in range(500)}
    pages = [(i, f"http://s.h{rng.randrange(600)}.org{rng.choice(['', '/', '/a/b/c', '/ab'])}") for i in range(400)]
    found = urlfilter.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame([(*k, v) for k, v in rules.items()], urlfilter.RULES_SCHEMA))
    for r in found.collect():
        fitting = [(h + p, v) for (h, p), v in rules.items() if r.host.endswith("." + h) and r.path.startswith(p)]
        assert (r.rule, r.verdict) == max(fitting, key=lambda x: len(x[0]), default=(None, "allow"))


def test_long_url_rules(spark):
    """Rules with paths longer than a probe, several with one start, beside a short one."""
    start = "/" + "x" * urlfilter.MAX_RULE_PATH
    rules = [("a.org", "/", "allow"), ("a.org", start + "/p", "block"), ("a.org", start + "/p/q", "allow"), ("b.org", start, "block")]
    urls = [f"http://{h}{p}" for h in ("a.org", "w.a.org", "b.org", "c.org") for p in ("/", start[:-1], start, start + "/p", start + "/pp", start + "/p/q/r")]
    pages = spark.createDataFrame(list(enumerate([*urls, urls[3]])), "page_id long, url string")
    rows = urlfilter.filter_urls(pages, spark.createDataFrame(rules, urlfilter.RULES_SCHEMA)).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        fitting = [(h + p, v) for h, p, v in rules if ("." + r.host).endswith("." + h) and r.path.startswith(p)]
        assert (r.rule, r.verdict) == max(fitting, key=lambda x: len(x[0]), default=(None, "allow"))


def test_warc(spark):
    nasty = "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"
    big = "".join(f"{i}\r\n" for i in range(30_000))
    html = [None, "", "short", "short", nasty, nasty * 50, big, big, "é" * 700, "é" * 700, "x\r\n", "\r\n" * 600, "tail" * 300 + "\r"]
    rows = [(i, f"http://h/{i} x" if i % 3 else None, h) for i, h in enumerate(html)] + [(None, None, big), (3, "u", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = warc.round_trip(pages, 4096).collect()
    assert len(found) == len(rows) and all(r.verified for r in found)
    payload = {i: (h or "").encode() for i, _, h in rows}
    for r in found:
        body = payload[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == body
    assert {r.page_id: r.refers_to for r in found if r.record_type == "revisit"} == {6: 7, None: 7, 8: 9}


def test_warc_notices_a_lost_segment(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"a" * 9000)
    records = list(warc.records(1, "u", b"a" * 9000, hashlib.sha1(b"a" * 9000).hexdigest(), None, "urn:page:1:0-1", 4096))
    assert len(records) == 3 and len(block) > 8192
    import gzip

    for name, some in (("whole", records), ("lost", [records[0], records[2]])):
        Path(tmp_path / name).mkdir()
        Path(tmp_path / name / "a.txt.gz").write_bytes(gzip.compress(b"".join(r + warc.END for r in some)))
    assert warc.read_archives(spark, str(tmp_path / "whole")).first().verified
    assert not warc.read_archives(spark, str(tmp_path / "lost")).first().verified


def test_forest(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((150, 32))
    vectors = [*(c + rng.standard_normal(32) * rng.uniform(0.05, 0.45) for c in centres for _ in range(8)), *rng.standard_normal((600, 32))]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)] + [(5000, vectors[3].astype(np.float32).tolist()), (5001, None), (5002, [0.0] * 32), (5003, [float("nan")] * 32), (5004, [None] * 32), (5005, [])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = {r.vec_id: r for r in forest.near_duplicates(data, leaf_rows=100).collect()}
    good = [(i, v) for i, v in rows if i < 5001]
    unit = np.array([v for _, v in good], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    true, ours = close.sum(axis=1), np.array([found[i].n_links for i, _ in good])
    assert (ours <= true).all() and ours.sum() >= 0.98 * true.sum() and true.sum() > 500
    assert found[5000].component_id == found[3].component_id and not found[5000].kept
    assert all((found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True) for i in range(5001, 5006))


@pytest.mark.parametrize(("sample", "block"), [(20_000, 8 << 20), (1500, 0)])
def test_forest_large_groups(spark, monkeypatch, sample, block):
    """One group of distinct near copies with a third of the rows, looser and smaller ones, and links that leave the groups."""
    monkeypatch.setattr(forest, "BLOCK_BYTES", block)
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((4, 64))
    near = [c + rng.standard_normal((n, 64)) * s for c, n, s in zip(centres, (2000, 400, 400, 600), (0.25, 0.33, 0.36, 0.1), strict=True)]
    bridge = centres[0] + np.linspace(0, 1, 40)[:, None] * (centres[1] - centres[0])
    vectors = np.concatenate([*near, bridge, rng.standard_normal((2600, 64))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(9000 + i, vectors[i].tolist()) for i in range(0, 4000, 50)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found = {r.vec_id: r for r in forest.near_duplicates(data, leaf_rows=100, sample_rows=sample).collect()}
    unit = np.array([v for _, v in rows], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    true, ours = close.sum(axis=1), np.array([found[i].n_links for i, _ in rows])
    assert (ours <= true).all() and ours.sum() >= 0.99 * true.sum()
    assert (ours[:2000] == true[:2000]).all() and true[:2000].min() > 500
    ids = [i for i, _ in rows]
    ours, label = [found[i].component_id for i in ids], forest.local_roots(close)
    assert sum(a == ids[b] for a, b in zip(ours, label, strict=True)) >= 0.99 * len(ids)


def near_pairs(rng, n, dim, pairs):
    """n vectors of which ``pairs`` pairs lie at cosines of 0.9 to 0.97, and the truth by brute force over blocks."""
    vectors = rng.standard_normal((n, dim))
    vectors[n - pairs :] = vectors[:pairs] + rng.standard_normal((pairs, dim)) * rng.uniform(0.2, 0.45, (pairs, 1))
    vectors = vectors.astype(np.float32)
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    true = np.concatenate([(unit[i : i + 1000] @ unit.T >= 0.9).sum(axis=1) - 1 for i in range(0, n, 1000)])
    return vectors, true


@pytest.mark.parametrize("n", [2000, 12_000])
def test_forest_recall_with_default_parameters(spark, n):
    vectors, true = near_pairs(np.random.default_rng(n), n, 64, n // 4)
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(4)
    ours = np.array([r.n_links for r in forest.near_duplicates(data).orderBy("vec_id").collect()])
    assert (ours <= true).all() and ours.sum() >= 0.95 * true.sum() and true.sum() > n // 8


def test_forest_splits_oversize_leaves(spark, monkeypatch):
    """A sample too small for usual leaves: their vectors are split again, in chunks, over several rounds."""
    monkeypatch.setattr(forest, "SUB_SAMPLE", 100)
    monkeypatch.setattr(forest, "CHUNK_ROWS", 150)
    compared, inner = [], forest.split_again

    def split(coarse, *rest):
        out = inner(coarse, *rest)
        compared.append((coarse.groupBy("code").count().agg(F.max("count")).first()[0], out.filter("rows is null").groupBy("code").count().agg(F.max("count")).first()[0]))
        return out

    monkeypatch.setattr(forest, "split_again", split)
    rng = np.random.default_rng(77)
    vectors, _ = near_pairs(rng, 6000, 32, 1500)
    vectors[100:160] = vectors[100] + rng.standard_normal((60, 32)) * 0.1  # a group that no split should part
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    true = close.sum(axis=1)
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(4)
    rows = forest.near_duplicates(data, leaf_rows=60, sample_rows=200).orderBy("vec_id").collect()
    ours = np.array([r.n_links for r in rows])
    assert compared[0][0] > 300 and compared[0][1] <= 120
    assert (ours <= true).all() and ours.sum() >= 0.9 * true.sum() and true.sum() > 3000
    labels = forest.local_roots(close)
    assert sum(r.component_id == x for r, x in zip(rows, labels, strict=True)) >= 0.97 * len(rows)


def test_forest_groups_that_the_sample_misses(spark):
    """Groups of 500 to 10,000 near the limit, none with enough vectors in the sample to be told: found where they crowd a leaf."""
    rng = np.random.default_rng(31)
    sizes = (500, 2000, 4000, 10_000)
    centres = rng.standard_normal((4, 64))
    centres *= 8 / np.linalg.norm(centres, axis=1)[:, None]
    parts = [c + rng.standard_normal((n, 64)) * 0.31 for c, n in zip(centres, sizes, strict=True)] + [rng.standard_normal((6000, 64))]
    vectors = np.concatenate(parts).astype(np.float32)
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    assert not len(forest.find_groups(unit[rng.permutation(len(unit))[:12]], np.arange(12), 0.9, 16, len(unit)).pivots)
    true = np.concatenate([(unit[i : i + 1000] @ unit.T >= 0.9).sum(axis=1) - 1 for i in range(0, len(unit), 1000)])
    order = rng.permutation(len(unit)).tolist()
    data = spark.createDataFrame([(i, vectors[i].tolist()) for i in order], "vec_id long, embedding array<float>").repartition(6)
    ours = np.array([r.n_links for r in forest.near_duplicates(data, sample_rows=12).orderBy("vec_id").collect()])
    assert (ours <= true).all()
    ends = np.append(0, np.cumsum(sizes))
    recall = [ours[a:b].sum() / true[a:b].sum() for a, b in zip(ends, ends[1:], strict=False)]
    assert min(recall) >= 0.9, recall
    assert all(true[a:b].sum() > (b - a) ** 2 // 3 for a, b in zip(ends, ends[1:], strict=False))  # over a third of the pairs are links


def test_vectors_of_two_lengths(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.1]), (2, [1.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.1])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in forest.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert found == {0: (1, 0), 1: (1, 0), 2: (1, 2), 3: (1, 2)}


def test_equal_rows_meet_in_several_batches(spark):
    """A row that a table without ids has many times doesn't fill one batch."""
    text = "".join(random.Random(5).choices("abcdef ", k=900))
    rows = suffix.dedup_bytes(spark.createDataFrame([(text,)] * 300, "text string").repartition(3), batch_bytes=20_000).collect()
    assert len(rows) == 300 and all(r.n_removed == 900 for r in rows)
    held = substring.dedup_substrings(spark.createDataFrame([(text,)] * 300, "text string"), batch_bytes=20_000)
    assert held.count() == 300


def test_budget_over_two_is_refused(spark):
    with pytest.raises(ValueError, match="2 bits"):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), budget=3)


def test_rules_with_nulls_and_both_verdicts(spark):
    rules = [(None, "/", "block"), ("a.org", None, "block"), ("a.org", "/", None), ("a.org", "/x", "allow"), ("a.org", "/x", "block"), ("b.org", "x", "block")]
    pages = spark.createDataFrame([(0, "http://a.org/x/y"), (1, "http://a.org/z"), (2, "http://b.org/x")], "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in urlfilter.filter_urls(pages, spark.createDataFrame(rules, urlfilter.RULES_SCHEMA)).collect()}
    assert found == {0: ("a.org/x", "block"), 1: (None, "allow"), 2: (None, "allow")}


def test_quality_against_plain_version(docs):
    """ratio, chunks and kept, text by text."""
    import zstandard

    bands, press = quality.Bands(), zstandard.ZstdCompressor(level=3).compress
    for r in quality.quality(docs).collect():
        raw = (r.text or "").encode()
        parts = [raw[i : i + bands.chunk] for i in range(0, len(raw), bands.chunk)] if len(raw) > bands.chunk else []
        parts = [p for p in parts if 2 * len(p) >= bands.chunk]
        bad = sum(not bands.chunk_band[0] <= len(press(p)) / len(p) <= bands.chunk_band[1] for p in parts)
        ratio = len(press(raw)) / len(raw) if raw else None
        low, high = next((a, b) for below, a, b in bands.whole if len(raw) < below)
        good = ratio is not None and low <= ratio <= high and bad <= bands.chunk_share * len(parts)
        assert (r.ratio, r.n_chunks, r.n_bad_chunks, r.kept) == (ratio, len(parts), bad, good and not r.base_failed)


def test_empty_tables(spark, docs):
    none = docs.filter("false")
    assert bpe.encode(none, RANKS, P.PATTERN).count() == 0
    assert quality.quality(none).count() == 0
    assert tokencount.count_tokens(none, MODEL).count() == 0
    assert substring.dedup_substrings(none).count() == 0
    assert suffix.dedup_bytes(none).count() == 0
    assert simhash.near_duplicates(simhash.add_fingerprints(none)).count() == 0
    assert mixing.mix(none).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).count() == 0
    assert urlfilter.filter_urls(pages, urlfilter.production_rules(spark)).count() == 0
    assert urlfilter.filter_urls(pages, urlfilter.production_rules(spark).filter("false")).count() == 0
    assert forest.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
