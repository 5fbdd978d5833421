"""Numbers, dates, JSON and arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadlake.functions.text import bound, compact, has_any
from leadlake.rules import ENROL_PHRASES


def safe_int(v: Column, low: int | None = None, high: int | None = None) -> Column:
    """Null if not a number or out of a closed range. (NUM-01)"""
    n = v.cast("string").try_cast("double").try_cast("int")
    return n if low is None else F.when(n.between(low, high), n)


def safe_float(v: Column, low: float | None = None, high: float | None = None) -> Column:
    n = v.cast("string").try_cast("double")
    return n if low is None else F.when(n.between(low, high), n)


def safe_bool(v: Column) -> Column:
    """(NUM-02)"""
    low = F.lower(F.trim(v.cast("string")))
    return F.when(low.isin("true", "yes", "1"), True).when(low.isin("false", "no", "0"), False)


def iso_utc(ts: Column) -> Column:
    """(DAT-01)"""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_now(as_of: Column | None = None) -> Column:
    """The time of the query, or a given one in tests, as ISO text. (DAT-01)"""
    return iso_utc(F.current_timestamp() if as_of is None else as_of)


def activity(text: Column, year: int) -> Column:
    """active_recent if a text names one of three years or an enrolment phrase, else unknown. (DAT-02)"""
    said = lambda low: has_any(low, [str(year - k) for k in range(3)]) | has_any(low, ENROL_PHRASES)
    return F.when(bound(F.lower(F.coalesce(text, F.lit(""))), said), "active_recent").otherwise("unknown")


def json_list(v: Column) -> Column:
    """JSON text array as lower-case trimmed strings without blanks; bad JSON is empty. (JSN-01)"""
    items = F.transform(F.from_json(v, "array<string>"), lambda x: F.lower(F.trim(x)))
    return F.coalesce(F.filter(items, lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>"))


def list_json(v: Column) -> Column:
    """Clean list as JSON text, empty as null. (JSN-02)"""
    kept = F.filter(F.transform(v, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(kept) > 0, F.to_json(kept))


def embedded_object(v: Column) -> Column:
    """From the first { to the last }, null without. (JSN-03)"""
    return F.nullif(F.regexp_extract(v, r"(?s)(\{.*\})", 1), F.lit(""))


def embedded_array(v: Column) -> Column:
    return F.nullif(F.regexp_extract(v, r"(?s)(\[.*\])", 1), F.lit(""))


def merged(*arrays: Column) -> Column:
    """Ordered distinct union without null and blank. (ARR-01)"""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.concat(*(F.coalesce(a, empty) for a in arrays)), lambda x: x.isNotNull() & (x != "")))


def without_sentinel(v: Column, sentinel: str) -> Column:
    """Drops a sentinel if there is anything else. (ARR-02)"""
    return F.when(F.size(v) > 1, F.array_remove(v, sentinel)).otherwise(v)


def scalar_or_list(v: Column) -> Column:
    """A JSON list, or a single text as a list of one. (ARR-03)"""
    single = F.when(compact(v) != "", F.array(compact(v))).otherwise(F.array().cast("array<string>"))
    return F.coalesce(F.filter(F.transform(F.from_json(v, "array<string>"), compact), lambda x: x != ""), single)


def known_and_extra(tags: Column, known: Sequence[str], stop: Sequence[str] = ()) -> Column:
    """struct<known, extra>, both sorted. (ARR-04)"""
    given = F.array(*map(F.lit, known))
    extra = F.array_except(F.array_except(tags, given), F.array(*map(F.lit, stop)) if stop else F.array().cast("array<string>"))
    return F.struct(F.array_sort(F.array_intersect(tags, given)).alias("known"), F.array_sort(extra).alias("extra"))


def labels(*rules: tuple[Column, str]) -> Column:
    """Labels whose condition holds, in rule order. (ARR-05)"""
    return F.array_compact(F.array(*(F.when(condition, F.lit(label)) for condition, label in rules)))


def patched(record: Column, values: Mapping[str, Column]) -> Column:
    """A struct with fields replaced, also nested ones by dotted names. (STC-01)"""
    for name, value in values.items():
        record = record.withField(name, value)
    return record
