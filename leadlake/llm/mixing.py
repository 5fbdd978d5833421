"""Mixing sources to target weights with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
MAX_COPIES = 3


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) from a hash of the key: the same in every run, in any partitioning, and easy to redo in SQL."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def source_targets(sized: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """One row per source: source, source_size, target. ``sized`` has source and size.

    Sources by code point, null last, take the weights in turn. Targets are min(cap * size, level * weight) where the
    level makes them add up to all sizes: sources in ascending order of cap * size / weight are filled one after the
    other, which ends where repeated resharing of the excess ends.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_source = materialise(by_source, "mix-sources")  # one narrow row per source from here on
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = by_source.withColumn("weight", weight.cast("double")).withColumn("full", cap * F.col("source_size")).withColumn("at", F.col("full") / F.col("weight"))
    up_to = Window.orderBy("at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(up_to), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up_to), F.lit(0.0))
    levels = ranked.withColumn("own_level", left / weight_left)
    # The level is that of the first source whose own level doesn't exceed its cap.
    level = F.min(F.when(F.col("own_level") <= F.col("at"), F.struct("at", "own_level"))).over(every)
    target = F.when(level.isNull() | (F.col("at") <= level["own_level"]), F.col("full")).otherwise(level["own_level"] * F.col("weight"))
    return levels.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None, weights: tuple[float, ...] = (5.0, 2.0, 1.0), cap: float = MAX_COPIES, seed: int = 0) -> DataFrame:
    """``docs`` plus size, source_size, target, copies and taken, replacing columns of those names.

    size defaults to the words of column text (null: 0). rate = target / source_size; each document is taken floor(rate)
    times, and once more if its hash-seeded uniform number is below the fraction, so copies never exceed ``cap``.
    A null source is a source of its own, after all others; a source without words has target 0 and copies 0. A null id
    hashes as an empty string; rows that repeat an id share its draw. An empty table gives an empty table.

    Documents are never shuffled by their source: sizes are summed before the shuffle and the per-source table is
    joined back (broadcast by Catalyst while it is small; else a sort-merge join that AQE splits for a hot source).
    """
    new = ("size", "source_size", "target", "copies", "taken")
    words = word_count(docs["text"].cast("string")) if size is None else size
    sized = docs.select(docs[f"`{source_col}`"].alias("source"), words.alias("size"))
    targets = materialise(source_targets(sized, weights, cap), "mix-targets").select(F.col("source").alias("_leadlake_source"), *(F.col(c).alias(f"_leadlake_{c}") for c in ("source_size", "target")))
    kept = [c for c in docs.columns if c not in new]
    left = docs.select(*(docs[f"`{c}`"] for c in kept), words.alias("size"))
    out = left.join(targets, left[f"`{source_col}`"].eqNullSafe(targets["_leadlake_source"]), "left")
    rate = F.when(F.col("_leadlake_source_size") > 0, F.least(F.lit(float(cap)), F.col("_leadlake_target") / F.col("_leadlake_source_size"))).otherwise(F.lit(0.0))
    extra = uniform(F.col(f"`{id_col}`"), seed) < rate - F.floor(rate)
    copies = F.least(F.lit(int(cap)), (F.floor(rate) + extra.cast("long"))).cast("long")
    out = out.withColumn("copies", copies)
    names = [F.col(f"`{c}`") for c in kept]
    return out.select(*names, "size", F.col("_leadlake_source_size").alias("source_size"), F.col("_leadlake_target").alias("target"), "copies", (F.col("size") * F.col("copies")).alias("taken"))


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each document as many times as it has copies."""
    repeated = mixed.filter("copies > 0").withColumn("_leadlake_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return repeated.select(*(F.col(f"`{c}`") for c in columns))


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM s),
o AS (SELECT *, 3.0::DOUBLE * source_size AS most, 3.0::DOUBLE * source_size / weight AS pos FROM r),
l AS (SELECT *, (sum(source_size) OVER ()
        - coalesce(sum(most) OVER (ORDER BY pos, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY pos, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lvl FROM o),
f AS (SELECT arg_min(lvl, pos) AS lvl FROM l WHERE lvl <= pos),
t AS (SELECT l.source, l.source_size, CASE WHEN f.lvl IS NULL OR l.pos <= f.lvl THEN l.most ELSE f.lvl * l.weight END::DOUBLE AS target FROM l, f),
j AS (SELECT d.doc_id, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN least(3.0::DOUBLE, t.target / t.source_size) ELSE 0 END AS rate,
        ('0x' || substr(md5('0:' || coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * least(3, floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM j
"""
