"""The line classifier, importance resampling and conversation repair against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadlake.llm import crf, importance, repair

# ---- line classifier ----


def good_text(rng, n):
    line = lambda: " ".join("".join(rng.choices("abcdefgéi", k=rng.randint(2, 8))) for _ in range(rng.randint(6, 20))).capitalize() + "."
    return "\n".join(line() for _ in range(n))


def bad_text(rng, n):
    kinds = [lambda: " | ".join(rng.choices(["home", "about", "login", "cart"], k=9)), lambda: "BUY NOW!! " * rng.randint(3, 9), lambda: "### " + "$$$ x " * 8, lambda: "same word " * 12]
    return "\n".join(rng.choice(kinds)() for _ in range(n))


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    bounds = np.array([0, 4, 5, 8, 8 + 1])
    bias, trans = rng.normal(size=9), rng.normal(size=(2, 2))
    layout = crf.Layout.of(bounds)
    alpha, beta, z = crf.forward_backward(bias[layout.rows], trans, layout)
    total = alpha + beta
    p = np.empty(9)
    p[layout.rows] = np.exp(total[:, 1] - np.logaddexp(total[:, 0], total[:, 1]))
    logs = []
    for a, b in itertools.pairwise(bounds):
        weight, good = [], np.zeros(b - a)
        for y in itertools.product((0, 1), repeat=int(b - a)):
            s = math.exp(sum(bias[a + t] * y[t] for t in range(b - a)) + sum(trans[y[t - 1], y[t]] for t in range(1, b - a)))
            weight.append(s)
            good += s * np.array(y)
        assert np.allclose(p[a:b], good / sum(weight))
        logs.append(math.log(sum(weight)))
    assert np.allclose(sorted(z), sorted(logs))


def test_gradient_leads_to_a_minimum():
    rng = random.Random(3)
    texts = [good_text(rng, rng.randint(1, 6)) if k % 2 else bad_text(rng, rng.randint(1, 6)) for k in range(40)]
    own, chars, bounds = crf.measures(pa.array(texts))
    assert len(own) == bounds[-1] == sum(len(t.split("\n")) for t in texts) and np.isfinite(own).all()
    assert chars.tolist() == [len(x) for t in texts for x in t.split("\n")]
    field = crf.fit(own, bounds, np.arange(40) % 2)
    scores = field.scores(pa.array(texts))
    assert ((scores >= 0.5) == (np.arange(40) % 2 == 1)).all()
    assert field.trans[0, 0] + field.trans[1, 1] > field.trans[0, 1] + field.trans[1, 0]  # neighbours agree
    # A line is judged with its neighbours: the same line is worse among bad ones.
    line = good_text(rng, 1)
    p = [field.marginals(crf.in_context(o, b), b)[1] for o, _, b in (crf.measures(pa.array([f"{x}\n{line}\n{x}"])) for x in (good_text(rng, 1), bad_text(rng, 1)))]
    assert p[0] > p[1]


def test_classifier_learns_and_holds_out(spark):
    rng = random.Random(5)
    rows = [(k, good_text(rng, rng.randint(1, 9)) if k % 3 else bad_text(rng, rng.randint(1, 9)), "s", "x") for k in range(600)]
    rows += [(None, None, None, "x"), (600, "", "s", "x"), (601, " \n\n ", "s", "x"), (602, "word " * 60_000, "s", "x"), (603, "a line\n" * 20_000, "s", None), rows[4], rows[4]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(500)] + [(7, 1), (None, 1), (9, None)], "doc_id long, quality int")
    field = crf.train(docs, labels)
    out = crf.classify(docs, field).collect()
    assert len(out) == len(rows) and set(out[0].asDict()) == {"doc_id", "text", "source", "held_out", "score", "predicted"}
    for r in out:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 500]
    assert len(held) > 100 and sum(r.predicted == (r.doc_id % 3 > 0) for r in held) / len(held) > 0.97
    assert len({r.score for r in out if r.doc_id == 4}) == 1
    # The held-out fold's labels never count.
    turned = labels.withColumn("quality", F.when(crf.fold_of(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = crf.train(docs, turned)
    assert np.array_equal(again.weights, field.weights) and np.array_equal(again.trans, field.trans)
    small = crf.train(docs, labels, train_docs=20, train_lines=60)  # bounds are kept
    assert not np.array_equal(small.weights, field.weights)
    none = crf.train(docs, labels.filter("quality = 1"))
    assert {r.score for r in crf.classify(docs, none).collect()} == {0.5}
    assert crf.classify(docs.limit(0), field).count() == 0


# ---- importance resampling ----

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in itertools.pairwise(w)]]


def resampled(docs, targets, percent=25, least=20):
    """(id, n_features, weight, score) rows in the order of their ranks, then the undrawn ones."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in targets:
        t.update(features(text)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    rows = []
    for i, text in docs:
        n, f = features(text)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return rows, [r[:4] for r in able[: len(able) * percent // 100]]


def test_resample_equals_plain_version(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcXYZ0é", k=rng.randint(1, 6))) for _ in range(300)] + ["w" * 62, "v" * 63, "u" * 64, "é" * 90]
    text = lambda n: "".join(w + rng.choice([" ", "-", "\n", ", "]) for w in rng.choices(words, k=n))
    docs = [(rng.choice([k, -k, k << 33]), text(rng.randint(0, 60))) for k in range(500)]
    docs += [(None, text(30)), (None, text(30)), (5000, None), (5001, ""), (5002, "--- !!"), (5003, text(30_000)), (5004, "x" * 100_000), docs[3], docs[3]]
    targets = [text(40) for _ in range(30)] + [None, ""]
    frame = spark.createDataFrame([(i, t, "k", "r") for i, t in docs], "doc_id long, text string, rank string, pos string").repartition(7)
    out = importance.resample(frame, spark.createDataFrame([(t,) for t in targets], "text string"))
    assert set(out.columns) == {"doc_id", "pos", "n_words", "n_features", "weight", "score", "rank"}
    got = out.collect()
    rows, drawn = resampled(docs, targets)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=key) == sorted((r[:4] for r in rows), key=key)
    ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.score, r.doc_id) for r in ranked] == [(r[3], r[0]) for r in drawn]
    assert importance.resample(frame.limit(0), frame.limit(0)).count() == 0
    assert importance.resample(frame.filter("doc_id > 4999 and doc_id < 5003"), frame.limit(0)).filter("rank is not null").count() == 0


@pytest.mark.parametrize("block", [1 << 18, 50])
def test_radix_sort(spark, monkeypatch, tmp_path, block):
    """Ties keep their order, one digit value holds most rows, keys use all 64 bits."""
    monkeypatch.setattr(importance, "BLOCK_ROWS", block)
    rng = random.Random(2)
    rows = [(rng.choice([7, 7, 7, rng.getrandbits(64) - (1 << 63), rng.randint(0, 3000)]), rng.choice([-1, 0, 5])) for _ in range(3000)]
    spark.createDataFrame(rows, "a long, b long").repartition(5).withColumn("at", F.monotonically_increasing_id()).write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    unsigned = lambda v: v % (1 << 64)
    expected = sorted(frame.collect(), key=lambda r: (unsigned(r.b), unsigned(r.a), r["at"]))
    got = sorted(importance.radix_sort(frame, ["a", "b"], "at").collect(), key=lambda r: r.pos)
    assert [r.pos for r in got] == list(range(3000))
    first = sorted({r["at"] >> 33 for r in got})
    assert [(r.a, r.b) for r in got] == [(r.a, r.b) for r in expected]
    if len(first) == 1:
        assert [r["at"] for r in got] == [r["at"] for r in expected]
    same = frame.limit(9).withColumn("a", F.lit(3).cast("long")).withColumn("b", F.lit(3).cast("long"))
    assert sorted(r.pos for r in importance.radix_sort(same, ["a", "b"], "at").collect()) == list(range(9))


# ---- conversation repair ----


def cheapest(codes):
    """Least (cost, letters) by trying all ways row by row; codes are (initial or '', fault)."""
    nxt = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {0: (0, "")}

    def inserted(best):
        out = dict(best)
        for q, (cost, s) in best.items():
            for _ in range(2):
                q, cost, s = nxt[q], cost + 5, s + "I"
                out[q] = min(out.get(q, (cost, s)), (cost, s))
        return out

    for initial, fault in codes:
        new = {}
        for q, (cost, s) in inserted(best).items():
            ways = [(q, 2, "D")]
            if fault in ("", "t"):
                extra = 5 if fault else 0
                ways.append((nxt[q], 1 + extra, "R"))
                to = 1 if initial == "s" and q == 0 else nxt[q] if (initial, nxt[q]) in (("u", 2), ("a", 3)) else None
                ways += [(to, extra, "K")] if to is not None else []
            for r, c, letter in ways:
                new[r] = min(new.get(r, (cost + c, s + letter)), (cost + c, s + letter))
        best = new
    return min(v for q, v in inserted(best).items() if q in (0, 3))


def plain(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, hash of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    turns = [t for t, _, _ in rows if t is not None]
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = cheapest([(r[:1], f) for (_, r, _), f in zip(rows, faults, strict=True)])
    lines, left, j = [], iter(rows), 0
    for letter in audit:
        _, role, text = next(left) if letter != "I" else (0, "", "")
        if letter == "D":
            continue
        j += letter != "K" or role[:1] != "s"
        lines.append(f"{role if letter == 'K' else 'user' if j % 2 else 'assistant'}:{text}")
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_auction_equals_trying_all_ways():
    rng = random.Random(6)
    for n in (0, 1, 2, 3, 5, 8, 13, 40):
        for _ in range(200):
            codes = [(rng.choice("suax"), rng.choice(["", "", "", "t", "d"])) for _ in range(n)]
            items = tuple((("suax".index(c)) * 3 + {"": 0, "t": 1, "d": 2}[f], 1) for c, f in codes)
            prices, traces = repair.solve(items, repair.END_PRICES)
            letters, state = traces[0]
            assert (prices[0], letters + repair.END_TRACES[state][0]) == cheapest(codes)
            # Cut anywhere, the halves' crossing costs add up to the same prices.
            k = rng.randint(0, n)
            ways = repair.crossing(items[:k])
            behind = repair.solve(items[k:], repair.END_PRICES)[0]
            assert [min(ways[4 * q + r] + behind[r] for r in range(4)) for q in range(4)] == list(prices)


def chats():
    rng = random.Random(7)
    said = ["Yes.", "No.", "Why?", "cut off", "", " \n", "Long text! ", "é:ü.", "line\nline.", "Done ", None]
    rows = []
    for c in range(150):
        role = itertools.cycle(["user", "assistant"])
        rows += [(c, rng.choice([t, t, t, t + 1, None]), rng.choice([next(role), "system", "tool", "user", "", None]) if rng.random() < 0.4 else next(role), f"{rng.choice(said)}{t}." if rng.random() < 0.6 else rng.choice(said)) for t in range(rng.randint(1, 9))]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (500, None, "user", "One."), (500, None, "user", "One."), (501, 1 << 61, "user", "Big."), (501, 3, "assistant", "Small.")]
    rows += [(502, 1, "user", "Copy.")] * 40 + [(503, 1, "user", " ")] * 40
    hot = [(504, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"Said {t}.", f"Cut {t}", "Again.", ""])) for t in range(1500)]
    return rows + hot


@pytest.mark.parametrize("shift", [8, 2])
def test_repair_equals_plain_version(spark, monkeypatch, shift):
    """Small blocks cut nearly every conversation; 504 holds two thirds of the rows."""
    monkeypatch.setattr(repair, "BLOCK_SHIFT", shift)
    rows = chats()
    random.Random(1).shuffle(rows)
    turns = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, audit string").repartition(5)
    edited = repair.repair(turns, spark.createDataFrame([(1,), (9000,), (None,)], "conv_id long"))
    got = {r.conv_id: tuple(r)[1:] for r in repair.summaries(edited).collect()}
    groups = {}
    for c, *rest in rows:
        groups.setdefault(c, []).append(rest)
    expected = {c: plain(g) for c, g in groups.items()} | {9000: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert got == expected
    back = edited.filter("conv_id = 504 and pos is not null").orderBy("pos").collect()
    joined = "\n".join(f"{r.role}:{r.text}" for r in back)
    assert hashlib.sha256(joined.encode()).hexdigest() == expected[504][-1]
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in back))


def test_damage_and_empty_tables(spark):
    rows = [(c, t, "assistant", f"One. Two! {t}?") for c in range(40) for t in range(5)] + [(None, None, None, None), (7, None, "user", "x.")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        row = (c, t, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
        expected += [row] * (0 if k == 0 else 2 if k == 3 else 1)
    key = lambda r: tuple((x is None, x or 0) for x in r[:2])
    assert sorted(map(tuple, repair.damage(turns).collect()), key=key) == sorted(expected, key=key)
    assert repair.summaries(repair.repair(repair.damage(turns.limit(0)))).count() == 0
    assert repair.summaries(repair.repair(turns.limit(0), turns)).count() == 41
