import hashlib
import random
from collections import Counter

import public_tokenizers as P

import corpus_pipeline
from leadlake.llm import bpe, mixing, quality
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs_in, docs = docs, spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if name == "quality_rules":
            good = {r.doc_id for r in quality.quality(docs_in).collect() if r.kept}
            assert sorted(after) == sorted(r for r in before if r.doc_id in good)
            assert all(c[0] >= 50 and 2 * c[4] <= c[0] for c in (brute.base_counts(r.text) for r in after))
        elif name == "simhash_dedup":
            prints = [brute.fingerprint(r.text) for r in before]
            heads = set(brute.components([r.doc_id for r in before], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2))  # noqa: B023
            assert sorted(after) == sorted(r for r in before if r.doc_id in heads)
        elif name == "substring_dedup":
            words = [tuple(brute.words(r.text)) for r in before]
            expected = {r.doc_id: r.text if not any(h) else " ".join(x for x, y in zip(w, h, strict=True) if not y) for r, w, h in zip(before, words, brute.repeated(words, 35), strict=True)}
            assert {r.doc_id: r.text for r in after} == expected and len(after) == len(before)
        elif name == "mix_sources":
            copies = {r.doc_id: r.copies for r in mixing.mix(docs_in).collect()}
            assert Counter(r.doc_id for r in after) == Counter({i: n for i, n in copies.items() if n})
        else:
            encoding = bpe.load_encoding(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
            assert Counter((r.doc_id, tuple(bpe.unpack_ids(r.token_ids)), r.decoded_sha256) for r in after) == Counter((r.doc_id, tuple(encoding.encode_ordinary(r.text)), hashlib.sha256(r.text.encode()).hexdigest()) for r in before)
            break
        assert docs.columns == columns
        before = after


CLASH = "ratio double, kept string, n_words int, fp string, size string, copies array<int>, kept_text string, n_removed string, _row int, _batch int, _p int, taken int, target string, `a b` int"


def test_stages_on_awkward_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, names that operators use, and an empty table."""
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choices("etaoinshr", k=rng.randint(3, 8))) for _ in range(n))
    passage, own = prose(60), (0.5, "mine", 7, "f", "s", [1], "kt", "nr", 1, 2, 3, 4, "tg", 9)
    texts = [None, "", "  ", prose(80), prose(90) + " " + passage, prose(100) + "\n" + passage, prose(20_000)]
    rows = [(i, t, "en", ["a", None, "b"][i % 3], len(t or ""), *own) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, prose(70), None, None, None, *own), (None, None, None, None, None, *own)]
    table = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")
    kept = lambda df: [tuple(r)[5:] for r in df.collect()]
    for start in (table, table.filter("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:  # each on the awkward table itself
            out = stage(spark, start, SF)
            assert out.columns == start.columns and all(k == tuple(rows[0][5:]) for k in kept(out)), name
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).write.parquet(str(tmp_path / f"{name}-{start is table}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}-{start is table}"))
        assert {r.doc_id for r in docs.collect()} <= {3, 4, 5, 6, None} and (docs.count() > 2) == (start is table)
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in corpus_pipeline.simhash_dedup(spark, table, SF).collect()) == [-1, 0, 3, 4, 5, 6]
    cut = {r.doc_id: r.text for r in corpus_pipeline.substring_dedup(spark, table, SF).collect()}
    assert passage not in cut[4] and passage not in cut[5] and cut[0] is None and cut[6] == texts[6]


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
