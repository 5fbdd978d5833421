"""Keep-one-per-key operators, merges and id-set joins. Order is always an argument, never an accident of partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.functions.text import slug
from leadlake.rules import STATUS_RANK
from leadlake.scratch import materialise


def names(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def computed(df: DataFrame, *columns: Column) -> DataFrame:
    """``df``, or the given columns of it, computed once: they come out of a generator that yields the row, so Catalyst doesn't copy
    their expressions into the filters and projections above. For wide projections that are read many times."""
    return (df.select(*columns) if columns else df).select(F.inline(F.array(F.struct("*"))))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over four tasks a core, for work that costs more a row than its bytes tell: a file of few row groups is
    read by as few tasks, and what is made of its rows would stay in them."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def keep_best(df: DataFrame, keys: Sequence[str], preference: Sequence[Column], union_col: str | None = None) -> DataFrame:
    """The row of each key with the least preference tuple; ``union_col`` becomes the sorted distinct values of all rows.

    Every part of the preference must be non-null, with an order (file, line) at its end. Rows are reduced before the
    shuffle; no sort of a whole key. (WIN-01, WIN-03, WIN-04, AGG-10)
    """
    best = F.min_by(F.struct(*names(df)), F.struct(*(p.alias(f"p{i}") for i, p in enumerate(preference)))).alias("_best")
    union = [] if union_col is None else [F.array_sort(F.collect_set(union_col)).alias("_union")]
    out = df.groupBy(*keys).agg(best, *union).select("_best.*", *(["_union"] if union else []))
    return out.withColumn(union_col, F.col("_union")).drop("_union") if union_col else out


def keep_best_named(df: DataFrame, url: str, key: str, name: str, preference: Sequence[Column]) -> DataFrame:
    """The best row of each record, known by its URL without trailing slashes, else by its id, else by its name's slug. (WIN-04, R3)"""
    plain = lambda c: F.nullif(F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))), F.lit(""))
    known = F.coalesce(F.nullif(F.regexp_replace(plain(url), "/+$", ""), F.lit("")), plain(key), slug(F.col(name)))
    return keep_best(df.withColumn("_key", known), ["_key"], preference).drop("_key")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key with the greatest order tuple. (WIN-02, PIP-19)"""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*names(df)), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))).alias("_last")).select("_last.*")


def in_ranges(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` dealt by ranges of the order tuple, sorted inside each, with _part, the number of the range, and _in, the place
    inside; written once. A key with most of the rows lies in many ranges, as long as the order tells its rows apart."""
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialise(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_in": inside}), name)


def conflicts(df: DataFrame, keys: Sequence[str], preference: Sequence[Column], order: Column, compare: Sequence[str]) -> DataFrame:
    """Rows that differ in ``compare`` from the best row so far of their key; order tells the rows of a key apart. (WIN-05)

    A segmented prefix scan: rows are dealt by ranges of (key, order), the best row of each key and range is found by
    partial aggregates, the ranges' best rows are carried forward (a key has one row per range there), and in a second
    pass each range runs on from what was carried to it. No task holds a key, but a range.
    """
    place = [*(F.col(k).asc_nulls_first() for k in keys), order.asc_nulls_first()]
    dealt = in_ranges(df.withColumn("_rank", F.struct(*(p.alias(f"p{i}") for i, p in enumerate(preference)), order.alias("o"), *compare)), place, "scan-ranges")
    segment = [*keys, "_part"]
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = dealt.groupBy(*segment).agg(F.min("_rank").alias("_end"))
    carried = ends.withColumn("_carried", F.min("_end").over(before)).filter(F.col("_carried").isNotNull()).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"), "_carried")
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*segment).orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    both = dealt.withColumn("_own", F.min("_rank").over(inside)).join(carried, same, "left")
    best = F.when(F.col("_own").isNull(), F.col("_carried")).when(F.col("_carried").isNull(), F.col("_own")).otherwise(F.when(F.col("_own") < F.col("_carried"), F.col("_own")).otherwise(F.col("_carried")))
    seen = both.withColumn("_best", best).filter(F.col("_best").isNotNull())
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_best.{c}"))
    return seen.filter(differs).select(*names(df), *(F.col(f"_best.{c}").alias(f"best_{c}") for c in compare))


def shared_values(df: DataFrame, value: Column, id_col: str) -> DataFrame:
    """Ids whose value occurs more than once; counted before the shuffle and joined back. (WIN-06)"""
    valued = df.select(F.col(id_col), value.alias("_value")).filter("_value is not null and _value <> ''")
    often = valued.groupBy("_value").agg(F.count("*").alias("_n")).filter("_n > 1")
    return valued.join(often, "_value", "left_semi").select(id_col).distinct()


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1, 2, 3 ... over the whole table without a one-task window: rows are dealt by ranges, sorted and numbered inside each,
    and written once; then each range adds the sizes of those before it. (WIN-07)"""
    dealt = in_ranges(df, order, "ranked")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per partition
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return dealt.join(before, "_part").withColumn(name, F.col("_before") + F.col("_in") + 1).drop("_part", "_in", "_before")


def batches(df: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """(WIN-08)"""
    return global_rank(df, order).withColumn("batch", F.floor((F.col("rank") - 1) / size))


def rank_of(status: Column, ranks: Mapping[str, int] = STATUS_RANK) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in ranks.items() for x in kv))[status], F.lit(0))


def status_merge(base: DataFrame, newer: DataFrame, key: str, payload: Sequence[str], status: str = "status") -> DataFrame:
    """Rows of ``base``; a newer row wins only with a higher status rank. (WIN-09)"""
    renamed = newer.select(key, *(F.col(c).alias(f"_new_{c}") for c in (status, *payload)))
    better = rank_of(F.col(f"_new_{status}")) > rank_of(F.col(status))
    return base.join(renamed, key, "left").select(key, *(F.when(better, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in (status, *payload)))


def update_merge(base: DataFrame, updates: DataFrame, key: str, payload: Sequence[str]) -> DataFrame:
    """(WIN-10)"""
    renamed = updates.select(key, *(F.col(c).alias(f"_new_{c}") for c in payload))
    return base.join(renamed, key, "left").select(key, *(F.coalesce(f"_new_{c}", c).alias(c) for c in payload))


def contact_merge(base: DataFrame, newer: DataFrame, key: str) -> DataFrame:
    """found wins; partial beats missing; of two partials that with more of email and phone. (WIN-11)"""
    renamed = newer.select(key, *(F.col(c).alias(f"_new_{c}") for c in ("status", "email", "phone")))
    filled = lambda e, p: F.col(e).isNotNull().cast("int") + F.col(p).isNotNull().cast("int")
    ours, theirs = rank_of(F.col("status")), rank_of(F.col("_new_status"))
    more = (theirs == 2) & (ours == 2) & (filled("_new_email", "_new_phone") > filled("email", "phone"))
    better = (theirs > ours) | more
    return base.join(renamed, key, "left").select(key, *(F.when(better, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in ("status", "email", "phone")))


def null_fill(base: DataFrame, found: DataFrame, key: str, rules: Mapping[str, Column], gate: Column) -> DataFrame:
    """Fills only null targets, from rows of ``found`` (columns named new_*) that pass the gate and with valid values; lists what it filled. (PIP-11)"""
    joined = base.join(found, key, "left")
    fills = {c: F.when(F.col(c).isNull() & F.coalesce(gate, F.lit(False)), value) for c, value in rules.items()}
    updated = F.array_compact(F.array(*(F.when(v.isNotNull(), F.lit(c)) for c, v in fills.items())))
    rest = [c for c in base.columns if c not in rules]
    return joined.select(*rest, *(F.coalesce(F.col(c), v).alias(c) for c, v in fills.items()), updated.alias("updated"))


def uncovered(df: DataFrame, url: Column, covered: DataFrame, *covered_cols: str) -> DataFrame:
    """Rows whose URL is in none of the covered columns. (JON-03, SET-03)"""
    known = covered.select(F.explode(F.array(*covered_cols)).alias("_covered")).filter("_covered is not null").distinct()
    return df.withColumn("_covered", url).join(known, "_covered", "left_anti").drop("_covered")


def best_result_per_type(results: DataFrame, id_col: str, type_col: str, types: Sequence[str], value: Column, order: Sequence[Column]) -> DataFrame:
    """One row per id, one column per type with its last value, and the list of types without one. (JON-06)"""
    last = [F.max_by(F.when(F.col(type_col) == t, value), F.when(F.col(type_col) == t, F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order))))).alias(t) for t in types]
    wide = results.groupBy(id_col).agg(*last)
    return wide.withColumn("missing", F.array_compact(F.array(*(F.when(F.col(t).isNull(), F.lit(t)) for t in types))))


def first_useful(df: DataFrame, key: str, order: Sequence[Column], n: int, useful: Column) -> DataFrame:
    """Of the first n rows of a key in order, the first that is useful. (PIP-14)"""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_rank") <= n)
    return keep_best(ranked.filter(useful), [key], [F.col("_rank")]).drop("_rank")
