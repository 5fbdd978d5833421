"""Target-distribution importance resampling: hashed n-gram weights scored by array lookups, then a distributed radix sort."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.session import bound_arrow_batches, materialise
from leadlake.llm.words import codes_of, flat_bytes, per_text, portions, runs

BUCKETS = 10_000
#: A radix pass sorts by a digit of at most so many bits.
DIGIT_BITS = 11
#: Rows that one task places in a pass, at most about.
BLOCK_ROWS = 1 << 18
#: Words up to so many bytes take their two-word checksums from a table.
TABLE_BYTES = 63

#: Bytes of words once A-Z are lower-cased: digits, letters, and all bytes of characters over U+007F.
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def shift_tables(most: int) -> np.ndarray:
    """[k, j, b]: what b in byte j of a CRC-32 register has become after k zero bytes."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    out = np.zeros((most + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32)[:, None] * 8)
    for k in range(most):
        out[k + 1] = (out[k] >> 8) ^ step[out[k] & 255]
    return out


_tables: list[np.ndarray] = []


def pair_crcs(first: np.ndarray, spaced: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of ``a + b`` from those of a and b and the bytes of b, which are at most ``TABLE_BYTES`` + 1."""
    if not _tables:
        _tables.append(shift_tables(TABLE_BYTES + 1))
    out = spaced.copy()
    for j in range(4):
        out ^= _tables[0][lengths, j, (first >> np.uint32(8 * j)) & np.uint32(255)]
    return out


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each run of one or two words, its text, words of each text)."""
    raw, offsets = flat_bytes(texts)
    raw = LOWER[raw]
    starts, ends = runs(IN_WORD[raw], offsets)
    n_words = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n_words
    owner = np.repeat(np.arange(len(texts)), n_words)
    codes, names = codes_of(raw, starts, ends)
    words = names.to_pylist()
    single = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    spaced = np.fromiter((zlib.crc32(b" " + w) for w in words), np.uint32, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    at = np.flatnonzero(owner[:-1] == owner[1:])
    a, b = codes[at], codes[at + 1]
    pairs = pair_crcs(single[a], spaced[b], np.minimum(size[b], TABLE_BYTES + 1))
    for i in np.flatnonzero(size[b] > TABLE_BYTES + 1):  # long words one by one
        pairs[i] = zlib.crc32(b" " + words[b[i]], int(single[a[i]]))
    return np.concatenate([single[codes], pairs]).astype(np.int64) % buckets, np.concatenate([owner, owner[at]]), n_words


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket; each task sends a row per bucket at most."""
    bound_arrow_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in portions(batch.column(0)):
                total += np.bincount(features(part, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = texts.select(texts[f"`{text_col}`"].cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln) of how much likelier a bucket is in the target, one added to each count; both have bucket and n."""
    counts = []
    for table in (corpus, target):
        full = np.zeros(buckets, np.int64)
        for r in table.collect():  # a row per bucket
            full[r.bucket] = r.n
        counts.append(full)
    s, t = counts
    big_s, big_t = float(int(s.sum()) + buckets), float(int(t.sum()) + buckets)
    return np.array([math.floor(1000 * math.log(float(tb + 1) * big_s / (float(sb + 1) * big_t))) for sb, tb in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def weigh(text: Column, gains: np.ndarray) -> Column:
    """struct n_words, n_features, weight: the floored mean gain of a text's features (0 where it has none)."""

    @F.arrow_udf("struct<n_words: bigint, n_features: bigint, weight: bigint>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for part in portions(batch) if len(batch) else ():
                bucket, owner, n_words = features(part, len(gains))
                order = np.argsort(owner, kind="stable")
                n = np.bincount(owner, minlength=len(part))
                total = per_text(gains[bucket[order]], np.append(0, np.cumsum(n)))
                out.append((n_words, n, total // np.maximum(n, 1)))
            columns = [np.concatenate([np.zeros(0, np.int64), *(x[k] for x in out)]) for k in range(3)]
            yield pa.StructArray.from_arrays([pa.array(c.astype(np.int64), pa.int64()) for c in columns], ["n_words", "n_features", "weight"])

    return score(text)


def gumbel(key: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln(u))), u from the first 32 bits of SHA-256 of ``seed:key``; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("long")


def digits_of(mask: int) -> list[tuple[int, int]]:
    """(shift, bits) of the digits, least significant first, between the lowest and the highest bit that differs among the rows."""
    mask &= (1 << 64) - 1
    if not mask:
        return []
    low, n = (mask & -mask).bit_length() - 1, mask.bit_length()
    passes = -(-(n - low) // DIGIT_BITS)
    bits = -(-(n - low) // passes)
    return [(low + i * bits, min(bits, n - low - i * bits)) for i in range(passes)]


def radix_sort(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """``rows`` plus pos (from 0) in the order of ``keys``, long columns compared as unsigned numbers, the last the most significant.

    Rows with equal keys keep the order of ``at``, a written monotonically_increasing_id. Each pass counts a digit's values in every
    block of rows, turns the counts into global offsets (digit by digit, block by block), and gives every row the
    offset of its digit and block plus its rank among such rows of the block: a stable counting sort whose destinations are
    the next pass's blocks. Blocks are bounded, a common digit value is spread over all blocks, and each pass is written,
    so a lost executor costs a task. Digits that are the same in all rows take no pass. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    seen = rows.agg(F.count("*").alias("n"), *(f(F.col(k)).alias(f"{name}{i}") for i, k in enumerate(keys) for name, f in (("any", F.bit_or), ("all", F.bit_and)))).first()
    if not seen.n:
        return rows.withColumn("pos", F.lit(0).cast("long"))
    passes = [(k, *d) for i, k in enumerate(keys) for d in digits_of(seen[f"any{i}"] & ~seen[f"all{i}"])] or [(keys[0], 0, 1)]
    n_blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-seen.n // BLOCK_ROWS))
    width = -(-seen.n // n_blocks)
    names = rows.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    now = rows.withColumn("pos", F.col(at)).withColumn("_block", F.pmod(F.shiftright(at, 33), F.lit(n_blocks)))

    for key, shift, bits in passes:
        digit = F.shiftrightunsigned(F.col(key), shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
        dealt = now.withColumn("_digit", digit)
        counts = dealt.groupBy("_digit", "_block").agg(F.count("*").alias("n"))
        by_digit = materialise(counts.groupBy("_digit").agg(F.array_sort(F.collect_list(F.struct("_block", "n"))).alias("blocks")), "radix-counts")
        totals = by_digit.select("_digit", F.aggregate("blocks", F.lit(0).cast("long"), lambda s, b: s + b["n"]).alias("n")).collect()  # a row per digit value
        first, start = {}, 0
        for d, n in sorted((r[0], r.n) for r in totals):
            first[d], start = start, start + n

        def offsets(batches: Iterator[pa.RecordBatch], first: dict[int, int] = first) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for d, blocks in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    block, n = (blocks.values.field(k).to_numpy() for k in range(2))
                    yield pa.record_batch([pa.array(block), pa.array(np.full(len(block), d, np.int32)), pa.array(first[d] + np.cumsum(n) - n)], names=["_block", "_digit", "start"])

        def place(rows: pa.Table, starts: pa.Table) -> pa.Table:
            order = np.argsort(rows.column("pos").to_numpy(), kind="stable")
            digit = rows.column("_digit").to_numpy()[order]
            by = np.argsort(digit, kind="stable")
            values, begins = np.unique(digit[by], return_index=True)
            base = dict(zip(starts.column("_digit").to_pylist(), starts.column("start").to_pylist(), strict=True))
            group = np.repeat(np.arange(len(values)), np.diff(np.append(begins, len(by))))
            pos = np.empty(len(order), np.int64)
            pos[order[by]] = np.array([base[v] for v in values.tolist()], np.int64)[group] + np.arange(len(by)) - begins[group]
            return pa.table([*(rows.column(c) for c in names), pa.array(pos), pa.array(pos // width)], names=[*names, "pos", "_block"])

        starts = by_digit.mapInArrow(offsets, "_block long, _digit int, start long")
        now = dealt.groupBy("_block").cogroup(starts.groupBy("_block")).applyInArrow(place, f"{kinds}, pos long, _block long")
        now = materialise(now, "radix-pass")
    return now.drop("_block")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = 25, least_words: int = 20, buckets: int = BUCKETS, seed: int = 7) -> DataFrame:
    """``docs`` without its text column, plus n_words, n_features, weight, score and rank, replacing columns of those names.

    Features are runs of one or two words, hashed to buckets. weight is the floored mean of the buckets' log likelihood
    ratios target : corpus, score adds a Gumbel draw from a hash of the id, so the highest scores are a sample without
    replacement in proportion to exp(weight / 1000). rank numbers the drawn rows: floor(percent * N / 100) of the N rows
    with at least ``least_words`` words, highest score first, ties to the smaller id (null last; rows equal in both in any
    order). ``id_col`` holds whole numbers. A null text is empty: no features, weight 0, never drawn. Repeated rows are rows of their own with equal draws.
    Texts are read whole; extra columns pass through; an empty table gives an empty table, an empty target equal likelihoods.

    Two passes over the texts (counts, then lookups of the 10,000 gains in an array); only (id, score) is sorted, and only
    rows whose score can be drawn: the cut comes from the counts of the distinct whole-number scores.
    """
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    gains = bucket_gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets), buckets)
    new = ("n_words", "n_features", "weight", "score", "rank")
    kept = [c for c in docs.columns if c not in (*new, text_col)]
    own = [docs[f"`{c}`"] for c in kept]
    measured = docs.select(*own, docs[f"`{id_col}`"].cast("long").alias("_leadlake_id"), weigh(docs[f"`{text_col}`"].cast("string"), gains).alias("_leadlake_w"))
    scored = measured.select(*(F.col(f"`{c}`") for c in kept), "_leadlake_id", *(F.col(f"_leadlake_w.{c}").alias(c) for c in new[:3]))
    scored = scored.withColumn("score", F.col("weight") + gumbel(F.col("_leadlake_id"), seed)).withColumn("_leadlake_at", F.monotonically_increasing_id())
    scored = materialise(scored, "resample-scores")
    able = scored.filter(F.col("n_words") >= least_words)
    steps = able.groupBy("score").agg(F.count("*").alias("n")).collect()  # distinct whole numbers: some ten thousands
    draw = sum(r.n for r in steps) * percent // 100
    cut, left = None, draw
    for r in sorted(steps, key=lambda r: -r.score):
        if left <= 0:
            break
        cut, left = r.score, left - r.n
    flip = F.lit(-(1 << 63)).cast("long")  # signed order as unsigned order
    id_key, none = F.coalesce(F.col("_leadlake_id").bitwiseXOR(flip), F.lit(-1).cast("long")), F.isnull("_leadlake_id").cast("long")
    chosen = able.filter(F.col("score") >= cut) if cut is not None else able.filter(F.lit(False))
    chosen = chosen.select(F.col("_leadlake_at").alias("_leadlake_row"), id_key.alias("k_id"), none.alias("k_none"), F.bitwise_not("score").bitwiseXOR(flip).alias("k_score"))
    ranked = radix_sort(chosen, ["k_id", "k_none", "k_score"], "_leadlake_row").filter(F.col("pos") < draw)
    out = scored.join(ranked.select("_leadlake_row", (F.col("pos") + 1).alias("rank")), F.col("_leadlake_at") == F.col("_leadlake_row"), "left")
    return out.select(*(F.col(f"`{c}`") for c in kept), *new)


#: The whole query in DuckDB, with a table-driven CRC-32 of the distinct features.
SQL = r"""
WITH tab AS (SELECT list(v ORDER BY b) AS t FROM (
  SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(b))),
texts AS (SELECT 's' AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
w AS (SELECT side, r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM texts),
f AS (SELECT side, r, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature FROM w),
codes AS (SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(feature))), lambda i: ('0x' || substr(hex(encode(feature)), 1 + 2 * i, 2))::BIGINT)),
    lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)])), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT feature FROM f), tab),
b AS (SELECT side, r, bucket FROM f JOIN codes USING (feature)),
n AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM b GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((sum(s) OVER ())::DOUBLE + 10000) / ((s + 1)::DOUBLE * ((sum(t) OVER ())::DOUBLE + 10000))))::BIGINT AS gain FROM n),
m AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM b JOIN gains USING (bucket) WHERE side = 's' GROUP BY r),
scored AS (SELECT w.r, doc_id, len(words) AS n_words, 2 * len(words) - CASE WHEN len(words) > 0 THEN 1 ELSE 0 END AS n_features, coalesce(m.weight, 0) AS weight,
    coalesce(m.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN m USING (r) WHERE side = 's'),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () * 25 // 100 AS draw FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= draw THEN place END::BIGINT AS rank FROM scored LEFT JOIN ranked USING (r)
"""
