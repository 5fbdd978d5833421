"""Strings: whitespace, slugs, excerpts, placeholders, HTML stripping, sentences, statistics."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F



def folded_letters() -> tuple[str, str]:
    """Characters whose compatibility decomposition leaves one ASCII character, and what is left of them; others vanish."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()) for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000]
    single = [(a, b) for a, b in pairs if len(b) == 1]
    return "".join(a for a, _ in single), "".join(b for _, b in single)


ACCENTED, PLAIN = folded_letters()


def compact(v: Column) -> Column:
    """Whitespace runs as one blank, trimmed; null as empty. (STR-01)"""
    return F.trim(F.regexp_replace(F.coalesce(v, F.lit("")), r"\s{2,}|[^\S ]", " "))  # a single blank is left as it is


def ascii_fold(v: Column) -> Column:
    """Letters without their accents; what has no ASCII form vanishes. Text that is ASCII already is not searched."""
    return F.when(F.octet_length(v) == F.char_length(v), v).otherwise(F.regexp_replace(F.translate(v, ACCENTED, PLAIN), r"[^\x00-\x7F]", ""))


def ascii_nfkd(v: Column) -> Column:
    """ASCII of the whole compatibility decomposition, also where a character leaves several, as ligatures do; null stays null. (UDF-03)

    A pandas function; ``ascii_fold`` covers all characters that leave one and stays in the JVM.
    """

    @F.pandas_udf("string")
    def fold(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())

    return fold(v)


def slug(v: Column, empty: str = "unknown") -> Column:
    """Folded to ASCII, lower case, other characters as single dashes. (STR-02)"""
    dashed = F.regexp_replace(F.lower(ascii_fold(F.coalesce(v, F.lit("")))), r"[^a-z0-9]+", "-")
    return F.regexp_replace(F.btrim(dashed, F.lit("-")), "^$", empty)


def export_slug(v: Column) -> Column:
    """Punctuation dropped, blanks and underscores as dashes. (STR-03)"""
    kept = F.regexp_replace(F.lower(F.trim(F.coalesce(v, F.lit("")))), r"[^a-z0-9_\s-]", "")
    return F.regexp_replace(F.regexp_replace(kept, r"[\s_-]+", "-"), r"^-+|-+$", "")


def title_label(v: Column) -> Column:
    """A slug as words with capitals. (STR-04)"""
    return F.initcap(F.regexp_replace(v, "-+", " "))


def excerpt(v: Column, n: int) -> Column:
    """The first n characters of the compacted text. (STR-05)"""
    return F.substring(compact(v), 1, n)


def bounded(v: Column, n: int, marker: str = "\n[...]\n") -> Column:
    """A text over n characters keeps its first three quarters of n and its end, around a marker. (STR-06)"""
    head = n * 3 // 4
    return F.when(F.length(v) > n, F.concat(F.left(v, F.lit(head)), F.lit(marker), F.right(v, F.lit(n - head)))).otherwise(v)


def keyword_in_context(v: Column, keyword: str, context: int = 200) -> Column:
    """Around the first hit of the keyword in any case, context / 2 characters to each side, with ellipses; null without a hit. (STR-07)"""
    at = F.locate(keyword.lower(), F.lower(v))
    start = F.greatest(at - context // 2, F.lit(1))
    end = F.least(at + len(keyword) + context // 2, F.length(v) + 1)  # exclusive
    piece = F.trim(F.substring(v, start, end - start))
    dots = F.lit("...")
    return F.when(at > 0, F.concat(F.when(start > 1, dots).otherwise(""), piece, F.when(end <= F.length(v), dots).otherwise("")))


def first_text(*values: Column) -> Column:
    """The first value that isn't blank. (STR-08)"""
    return F.coalesce(*(F.nullif(compact(v), F.lit("")) for v in values))


def is_placeholder(v: Column, exact: Sequence[str] = ("", "unknown", "n/a", "none", "tbd"), containing: Sequence[str] = ("to be confirmed",)) -> Column:
    """Whether the text says nothing: one of a set, or with a phrase in it. (STR-09)"""
    low = F.lower(compact(v))
    return has_any(low, containing) | low.isin(*exact)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def has_any(lowered: Column, phrases: Sequence[str]) -> Column:
    """Whether some phrase occurs. Over a literal array, so that long lists don't make long plans and methods."""
    if len(phrases) > 3:
        return bound(lowered, lambda text: F.exists(F.lit(list(phrases)), lambda p: F.contains(text, p)))
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(lowered, F.lit(p))
    return out


def strip_html(v: Column) -> Column:
    """Text of HTML by patterns: no scripts and styles, tags as blanks, four entities, compacted. (STR-10)"""
    for pattern, by in ((r"(?is)<script[^>]*>.*?</script>", ""), (r"(?is)<style[^>]*>.*?</style>", ""), (r"<[^>]+>", " "), ("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        v = F.regexp_replace(v, pattern, by)
    return compact(v)


def evidence_sentences(v: Column, signal: str, low: int = 15, high: int = 500, most: int = 8) -> Column:
    """Distinct sentences of low..high characters that match a pattern, in order, at most ``most``. (STR-11)"""
    parts = F.transform(F.split(v, r"[.!?\n]+"), lambda x: F.trim(x))
    return F.slice(F.array_distinct(F.filter(parts, lambda s: F.length(s).between(low, high) & F.rlike(s, F.lit(signal)))), 1, most)


def join_parts(sep: str, *parts: Column) -> Column:
    """Non-blank parts, joined. (STR-12)"""
    return F.concat_ws(sep, *(F.nullif(compact(p), F.lit("")) for p in parts))


def n_words(v: Column) -> Column:
    return F.regexp_count(F.coalesce(v, F.lit("")), F.lit(r"[^ \t\n\r\x0b\f]+")).cast("long")


def n_lines(v: Column) -> Column:
    return F.when(F.coalesce(v, F.lit("")) == "", F.lit(0)).otherwise(F.regexp_count(v, F.lit("\n")) + 1).cast("long")


def sha256(v: Column) -> Column:
    """(STR-14)"""
    return F.sha2(v, 256)
