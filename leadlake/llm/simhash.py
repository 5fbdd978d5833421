"""SimHash near-dedup with pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.graph import connected_components
from leadlake.llm.session import bound_arrow_batches, materialise
from leadlake.llm.words import Words, gather, portions

BITS = 64
SEED = 42
#: Shingles whose bits are unpacked at once.
SHINGLE_BLOCK = 1 << 15
#: A bucket of more distinct fingerprints than this is linked through shared one-bit neighbours, not pair by pair.
HOT_BUCKET = 256


def fingerprints(texts: pa.Array, shingle: int = 3, seed: int = SEED) -> np.ndarray:
    """Unsigned 64-bit fingerprints of a batch of texts; no words: zero."""
    w = Words(texts, lower=True)
    out = np.zeros(w.n, np.uint64)
    if not len(w.starts):
        return out
    # The words of the batch joined by single blanks: every shingle is one slice of it.
    lengths = w.ends - w.starts + 1
    raw = np.append(w.raw, np.uint8(0x20))
    joined = gather(raw, w.starts, lengths)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    joined[ends - 1] = 0x20
    last = np.arange(len(starts)) + shingle - 1
    stop = w.first[1:][w.text]
    full = last < stop
    short = (w.counts[w.text] < shingle) & (np.arange(len(starts)) == w.first[w.text])  # the whole short text
    begin = np.flatnonzero(full | short)
    until = ends[np.minimum(begin + shingle, stop[begin]) - 1] - 1
    data = joined.tobytes()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(data[a:b], seed) for a, b in zip(starts[begin].tolist(), until.tolist(), strict=True)), np.uint64, len(begin))
    owner = w.text[begin]
    ones = np.zeros((w.n, BITS), np.int64)
    for i in range(0, len(h), SHINGLE_BLOCK):
        bits = np.unpackbits(h[i : i + SHINGLE_BLOCK].view(np.uint8).reshape(-1, 8)[:, ::-1], axis=1)
        texts_here, begins = np.unique(owner[i : i + SHINGLE_BLOCK], return_index=True)
        ones[texts_here] += np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
    major = 2 * ones > np.bincount(owner, minlength=w.n)[:, None]
    out[:] = np.packbits(major, axis=1)[:, ::-1].copy().view(np.uint64).ravel()
    return out


def fingerprint_column(text: Column, shingle: int = 3, seed: int = SEED) -> Column:
    """The fingerprint as a signed long of the same bits."""

    @F.arrow_udf("bigint")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprints(part, shingle, seed) for part in portions(batch)]
            yield pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64())

    return fingerprint.asNondeterministic()(text)  # else Catalyst computes it again for a filter


def segment_masks(segments: int) -> list[int]:
    """Masks of consecutive bit segments of nearly equal width."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def ring(segments: int, budget: int) -> tuple[int, list[int]]:
    """(segments of a chain that must be equal, allowed differences of the first 1, 2, ... segments of a chain).

    If all segments together differ in at most ``budget`` bits, some start on the ring has, for every l, at most
    l * budget / segments differences in its first l segments.
    """
    allowed = [budget * n // segments for n in range(1, segments + 1)]
    return sum(a == 0 for a in allowed), allowed


def links(prints: DataFrame, segments: int = 5, budget: int = 2, hot: int = HOT_BUCKET) -> DataFrame:
    """(a, b): edges between distinct fingerprints that connect exactly those within ``budget`` (at most 2) bits.

    Start i of the ring puts each fingerprint in the bucket of its chain of equal segments. Pairs of a bucket pass if
    the chain from i stays within its proportional budgets at every length, then if all bits do. A bucket of over ``hot``
    fingerprints would pair up quadratically: there every fingerprint is tied to itself and its 64 one-bit neighbours as
    meeting points. Two fingerprints share a meeting point exactly if they differ in at most 2 bits, so nothing is lost.
    Meeting points are no fingerprints of the table unless they occur in it; callers drop the others. A larger ``budget``
    raises ValueError.
    """
    if budget > 2:
        raise ValueError("two fingerprints share a meeting point only within 2 bits")
    masks = segment_masks(segments)
    n_equal, allowed = ring(segments, budget)
    chain = lambda i, n: sum(masks[(i + k) % segments] for k in range(n))  # noqa: E731  disjoint bits: the sum is the union
    starts = F.array(*(F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(signed(chain(i, n_equal))).alias("key")) for i in range(segments)))
    keyed = prints.select("fp", F.inline(starts))
    sizes = materialise(keyed.groupBy("i", "key").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-buckets")
    bucketed = materialise(keyed.join(sizes, ["i", "key"]), "simhash-keyed")
    small = bucketed.filter(F.col("n") <= hot)
    left, right = small.select("i", "key", F.col("fp").alias("a")), small.select("i", "key", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    within = F.bit_count(differ) <= budget
    in_ring = F.lit(False)
    for i in range(segments):
        chained = F.col("i") == i
        for n in range(n_equal + 1, segments):
            chained = chained & (F.bit_count(differ.bitwiseAND(signed(chain(i, n)))) <= allowed[n - 1])
        in_ring = in_ring | chained
    pairs = left.join(right, ["i", "key"]).filter(F.col("a") < F.col("b")).filter(in_ring).filter(within).select("a", "b")
    meeting = F.concat(F.array(F.col("fp")), F.array(*(F.col("fp").bitwiseXOR(signed(1 << k)) for k in range(BITS))))
    crowded = bucketed.filter(F.col("n") > hot).select("fp").distinct().select(F.col("fp").alias("a"), F.explode(meeting).alias("b"))
    return pairs.union(crowded).filter("a <> b")


def add_fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` plus fp (signed long), replacing a column of that name; one map without a shuffle.

    A-Z is lower-cased; a text with fewer words than a shingle is one shingle, a text without words (or null) has
    fingerprint 0. Texts are read whole; a very long one without separators is one word, and one shingle. Repeated rows get equal
    fingerprints, extra columns pass through. An empty table gives an empty table.
    """
    bound_arrow_batches(docs.sparkSession)
    text = docs[f"`{text_col}`"].cast("string")
    return docs.select(*(docs[f"`{c}`"] for c in docs.columns if c != "fp"), fingerprint_column(text, shingle).alias("fp"))


def components(marked: DataFrame, id_col: str = "doc_id", segments: int = 5, budget: int = 2, hot: int = HOT_BUCKET) -> DataFrame:
    """(fp, least, component, component_id): one row per distinct fingerprint, with the least id that has it, a name of its
    component and the least non-null id of the component (null if none). Equal fingerprints are one node: copies never pair up."""
    classes = materialise(marked.groupBy("fp").agg(F.min(f"`{id_col}`").alias("least")), "simhash-classes")
    found = connected_components(links(classes.select("fp"), segments, budget, hot)).withColumnRenamed("node", "fp")
    grouped = classes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    return materialise(grouped.join(named, "component").select("fp", "least", "component", "component_id"), "simhash-components")


def near_duplicates(marked: DataFrame, id_col: str = "doc_id", segments: int = 5, budget: int = 2, hot: int = HOT_BUCKET) -> DataFrame:
    """``marked`` (a table with fp, from ``add_fingerprints``) plus component_id, replacing a column of that name.

    Fingerprints link at ``budget`` or fewer differing bits. component_id is the least non-null id reachable by links,
    null if the component has none; rows that repeat an id keep their own fingerprints; fingerprint 0 is linked like any
    other. Extra columns pass through; an empty table gives an empty table.
    """
    kept = [c for c in marked.columns if c != "component_id"]
    own = marked.select(*(marked[f"`{c}`"] for c in kept))
    lookup = components(marked, id_col, segments, budget, hot).select(F.col("fp").alias("_leadlake_fp"), "component_id")
    return own.join(lookup, own["fp"] == lookup["_leadlake_fp"]).select(*(F.col(f"`{c}`") for c in kept), "component_id")


def keep_one(marked: DataFrame, id_col: str = "doc_id", segments: int = 5, budget: int = 2, hot: int = HOT_BUCKET) -> DataFrame:
    """One row of each component of ``marked``: that with the least id.

    If several fingerprints of a component have this id, the least is taken; of rows with equal id and fingerprint any one
    stays. The winners' (fingerprint, id) pairs are nearly unique, so the one shuffle of the texts has no hot key.
    """
    heads = components(marked, id_col, segments, budget, hot).filter(F.col("least").eqNullSafe(F.col("component_id")))
    winners = heads.groupBy("component").agg(F.min_by(F.struct("fp", "least"), F.col("fp")).alias("w"))
    winners = materialise(winners.select(F.col("w.fp").alias("fp"), F.coalesce(F.col("w.least").cast("string"), F.lit("")).alias("_leadlake_id")), "simhash-winners")
    named = marked.withColumn("_leadlake_id", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    return named.join(winners, ["fp", "_leadlake_id"], "left_semi").dropDuplicates(["fp", "_leadlake_id"]).drop("_leadlake_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
