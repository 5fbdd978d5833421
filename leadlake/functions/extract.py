"""Rule tagging and field extraction from text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadlake import rules as R
from leadlake.functions.text import bound, compact, evidence_sentences, has_any, keyword_in_context, slug, strip_html

WORD_NUMBERS = ("one", "two", "three", "four", "five", "six")


def tags(text: Column, pack: R.TagRules) -> Column:
    """Tags of the rules whose needle occurs, in first-seen order. (TXT-01, TXT-02)

    The rules are a literal array that a lambda goes through, so a pack of any length makes a plan of one size."""
    low = F.lower(F.coalesce(text, F.lit("")))
    if pack.whole_words:
        hits = F.array_compact(F.array(*(F.when(F.rlike(low, F.lit(rf"\b{re.escape(needle)}\b")), F.lit(tag)) for needle, tag in pack.pairs)))
    else:
        rules = F.array(*(F.struct(F.lit(needle).alias("needle"), F.lit(tag).alias("tag")) for needle, tag in pack.pairs))
        hits = bound(low, lambda t: F.transform(F.filter(rules, lambda r: F.contains(t, r["needle"])), lambda r: r["tag"]))
    found = F.array_distinct(hits)
    return found if pack.default is None else F.when(F.size(found) == 0, F.array(F.lit(pack.default))).otherwise(found)


def duration(text: Column) -> Column:
    """struct<label, min_days, max_days> by a chain of phrases. (TXT-03)"""
    return bound(F.lower(F.coalesce(text, F.lit(""))), duration_of)


def duration_of(low: Column) -> Column:
    none = F.lit(None).cast("int")
    row = lambda label, least, most: F.struct(label.alias("label"), least.cast("int").alias("min_days"), most.cast("int").alias("max_days"))
    n = F.regexp_extract(low, r"(\d+)[ -]?week", 1)
    days = n.try_cast("int") * 7
    out = F.when(~F.contains(low, F.lit("week")), row(F.lit("unknown"), none, none))  # most texts; the patterns are searched in the others
    out = out.when(has_any(low, ["one-week-plus", "one week or longer"]), row(F.lit("one-week-plus"), F.lit(7), none))
    out = out.when(F.contains(low, F.lit("multi-week")), row(F.lit("multi-week"), F.lit(7), none)).when(n != "", row(F.concat(n.try_cast("int").cast("string"), F.lit("-week")), days, days))
    for k, word in enumerate(WORD_NUMBERS, 1):
        out = out.when(F.rlike(low, F.lit(rf"\b{word}[ -]?week\b")), row(F.lit(f"{word}-week"), F.lit(7 * k), F.lit(7 * k)))
    return out.otherwise(row(F.lit("week-based"), F.lit(7), none))


def record_basis(venue: Column, uncertainty: Column, city: Column) -> Column:
    """(TXT-05)"""
    texts = F.struct(F.lower(compact(venue)).alias("place"), F.lower(compact(uncertainty)).alias("doubt"), (F.coalesce(city, F.lit("")) == "").alias("nowhere"))

    def basis(x: Column) -> Column:
        both = F.trim(F.concat_ws(" ", x["place"], x["doubt"]))
        pending = lambda low: has_any(low, R.PENDING_PHRASES) | (x["place"] == "") | x["place"].isin(*R.VENUE_PLACEHOLDERS) | x["nowhere"]
        return bound(both, lambda low: F.when(has_any(low, R.MULTI_VENUE_PHRASES), "multi_venue_candidate").when(pending(low), "venue_candidate_pending_confirmation").otherwise("venue_candidate"))

    return bound(texts, basis)


def numbers(text: Column, pattern: str, group: int = 1, kind: str = "int") -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast(kind))


def amounts(text: Column) -> Column:
    """Sorted distinct amounts next to a currency mark, without 0 and years. (TXT-06)"""
    found = numbers(text, R.AMOUNT_PATTERN, kind="double")
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: (x > 0) & ~F.floor(x).between(*R.AMOUNT_YEARS))))


def currency(text: Column) -> Column:
    """The currency of the first pattern that occurs. (TXT-07)"""
    return F.coalesce(*(F.when(F.rlike(text, F.lit(pattern)), F.lit(code)) for pattern, code in R.CURRENCY_PATTERNS))


def pricing(text: Column, words: Sequence[str] = R.PRICE_WORDS, boarding: Sequence[str] = R.BOARDING_WORDS) -> Column:
    """struct<currency, amount_min, amount_max, boarding_included> from the surroundings of the first price word, else the whole text; null without an amount of 50 or more. (TXT-08)"""
    near = F.coalesce(*(keyword_in_context(text, w, 600) for w in words), text)
    seen = bound(near, lambda n: F.struct(n.alias("near"), amounts(n).alias("found")))

    def prices(x: Column) -> Column:
        large = F.filter(F.when(F.size(x["found"]) > 0, x["found"]).otherwise(amounts(text)), lambda a: a >= 50)
        included = F.when(has_any(F.lower(text), boarding), F.lit(True))
        row = lambda v: F.struct(F.coalesce(currency(x["near"]), currency(text)).alias("currency"), F.array_min(v).alias("amount_min"), F.array_max(v).alias("amount_max"), included.alias("boarding_included"))
        return bound(large, lambda v: F.when(F.size(v) > 0, row(v)))

    return bound(seen, prices)


def page_duration(text: Column) -> Column:
    """struct<min_days, max_days, one_week_plus>; null if neither days nor weeks are named. (TXT-10, NUM-03)"""
    named = F.struct(numbers(text, R.DAYS_PATTERN).alias("days"), numbers(text, R.WEEKS_PATTERN).alias("weeks"))

    def ends(x: Column) -> Column:
        days, weeks = F.filter(x["days"], lambda d: d.between(1, 60)), F.filter(x["weeks"], lambda w: w.between(1, 12))
        least, most = F.least(F.array_min(days), F.array_min(weeks) * 7), F.greatest(F.array_max(days), F.array_max(weeks) * 7)
        return F.when(F.size(x["days"]) + F.size(x["weeks"]) > 0, F.struct(least.alias("min_days"), most.alias("max_days")))

    long = lambda d: F.when(d.isNotNull(), F.struct(d["min_days"].alias("min_days"), d["max_days"].alias("max_days"), F.when((d["min_days"] >= 7) | (d["max_days"] >= 7), F.lit(True)).alias("one_week_plus")))
    return bound(bound(named, ends), long)


def range_bounds(text: Column, pattern: str, low: int, high: int) -> Column:
    """Both ends of every range that lies within the limits; the text is searched once, its matches again for their parts."""
    part = lambda m, k: F.regexp_extract(m, pattern, k).try_cast("int")
    pairs = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.array(part(m, 1), part(m, 2)))
    return F.flatten(F.filter(pairs, lambda p: F.forall(p, lambda x: F.coalesce(x.between(low, high), F.lit(False)))))


def ages_and_grades(text: Column) -> Column:
    """struct<age_min, age_max, grade_min, grade_max>; null if no age and no grade is found. (TXT-12)"""
    single = F.filter(numbers(text, R.GRADE_SINGLE_PATTERN), lambda x: x.between(1, 12))
    grades = F.when(F.rlike(text, F.lit(R.GRADE_RANGE_PATTERN)), range_bounds(text, R.GRADE_RANGE_PATTERN, 1, 12)).otherwise(single)
    phrase = F.when(F.rlike(text, F.lit(R.SENIOR_PATTERN)), F.array(F.lit(12), F.lit(12)))
    phrase = phrase.when(F.rlike(text, F.lit(R.JUNIOR_SENIOR_PATTERN)), F.array(F.lit(11), F.lit(12))).when(F.rlike(text, F.lit(R.NINE_TO_TWELVE_PATTERN)), F.array(F.lit(9), F.lit(12)))
    found = F.struct(range_bounds(text, R.AGE_RANGE_PATTERN, 3, 25).alias("ages"), bound(grades, lambda g: F.when(F.size(g) > 0, g).otherwise(phrase)).alias("grades"))
    ends = lambda x: F.struct(F.array_min(x["ages"]).alias("age_min"), F.array_max(x["ages"]).alias("age_max"), F.array_min(x["grades"]).alias("grade_min"), F.array_max(x["grades"]).alias("grade_max"))
    return bound(found, lambda x: F.when((F.size(x["ages"]) > 0) | x["grades"].isNotNull(), ends(x)))


def emails(text: Column) -> Column:
    """Addresses without those of junk; a text without @ is not searched."""
    found = F.when(F.contains(text, F.lit("@")), F.regexp_extract_all(text, F.lit(R.EMAIL_PATTERN), F.lit(0)))
    return F.filter(found, lambda e: ~has_any(F.lower(e), R.JUNK_EMAIL_PARTS))


def phones(text: Column) -> Column:
    """Numbers of 10 to 15 digits; a text without three digits close together is not searched."""
    tried = F.when(F.rlike(text, F.lit(r"\d[\s.\-()]*\d[\s.\-()]*\d")), F.regexp_extract_all(text, F.lit(R.PHONE_PATTERN), F.lit(0)))
    found = F.filter(tried, lambda p: F.length(F.regexp_replace(p, r"\D", "")).between(10, 15))
    return F.transform(found, lambda x: F.trim(x))


def contact(text: Column, domain: str | None = None) -> Column:
    """struct<email, phone, status>: the first of each; found, partial or missing. Addresses at the site's own ``domain`` come before others. (TXT-14)"""
    own = lambda e: bound(e, lambda x: F.concat(F.filter(x, lambda a: F.endswith(F.lower(a), F.lit(f"@{domain}"))), x))
    both = F.struct(F.get(emails(text) if domain is None else own(emails(text)), F.lit(0)).alias("email"), F.get(phones(text), F.lit(0)).alias("phone"))
    status = lambda x: F.when(x["email"].isNotNull() & x["phone"].isNotNull(), "found").when(x["email"].isNotNull() | x["phone"].isNotNull(), "partial").otherwise("missing")
    return bound(both, lambda x: F.struct(x["email"].alias("email"), x["phone"].alias("phone"), status(x).alias("status")))


def valid_email(v: Column) -> Column:
    """(TXT-16)"""
    low = F.lower(F.trim(v))
    return F.when(F.rlike(low, F.lit(f"^{R.EMAIL_PATTERN}$")), low)


def valid_phone(v: Column) -> Column:
    return F.when(F.length(F.regexp_replace(v, r"\D", "")) >= 7, compact(v))


def labelled_range(text: Column, label: str) -> Column:
    """struct<low, high> of the first "label 8-12" or "label 9 to 12". (TXT-23)"""
    pattern = rf"(?i){label}s?\s*:?\s*(\d{{1,2}})\s*(?:-|–|to)\s*(\d{{1,2}})"
    return F.struct(F.regexp_extract(text, pattern, 1).try_cast("int").alias("low"), F.regexp_extract(text, pattern, 2).try_cast("int").alias("high"))


def candidate_id(country: Column, region: Column, city: Column, name: Column, venue: Column, host: Column, multi: Column) -> Column:
    """Deterministic id; a row of many venues says so for its city and venue, a pending venue takes the host along. (PIP-04, R7)"""
    known = lambda v, many, none: bound(F.coalesce(F.nullif(v, F.lit("")), F.when(multi, many).otherwise(none)), lambda x: slug(x))
    parts = F.struct(known(city, "multi site", "unknown city").alias("city"), known(venue, "multi site", "pending venue").alias("venue"), F.coalesce(host, F.lit("")).alias("host"))
    along = lambda p: F.when(((p["venue"] == "pending-venue") | (p["venue"] == "unknown")) & (p["host"] != ""), slug(p["host"]))
    text = lambda p: F.concat_ws("-", F.lit("cand"), country, region, p["city"], name, p["venue"], along(p))
    return bound(bound(parts, text), lambda x: slug(x))  # each slug and the host are made once


def provisional(tags: Column) -> Column:
    """struct<families, types, duration> that free tags name; the duration is that of the first tag with a week, else null. (TXT-04)"""
    low = F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.lower(t))
    known = lambda names: F.array_distinct(F.filter(low, lambda t: t.isin(*names)))
    week = F.get(F.filter(low, lambda t: F.contains(t, F.lit("week"))), F.lit(0))
    return F.struct(known(R.KNOWN_FAMILIES).alias("families"), known(R.KNOWN_TYPES).alias("types"), F.when(week.isNotNull(), duration(week)).alias("duration"))


def overnight_signals(text: Column) -> Column:
    """Distinct words of overnight stay, in lower case and sorted. (TXT-18)"""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(R.OVERNIGHT_PATTERN), F.lit(0)), lambda x: F.lower(x))))


def operator_type(operator: Column, name: Column) -> Column:
    """(TXT-21)"""
    both = F.lower(F.concat_ws(" ", operator, name))
    return F.coalesce(*(F.when(has_any(both, words), F.lit(kind)) for kind, words in R.OPERATOR_TYPES), F.lit("organization"))


def confidence(needs: Column, basis: Column, overnight: Column, active: Column) -> Column:
    """(TXT-24)"""
    low = F.array_contains(needs, "confirm_exact_venue") | (compact(basis) == "multi_venue_candidate")
    return F.when(low, "low").when(overnight & active & (F.size(needs) <= 1), "high").when(overnight | active, "medium").otherwise("low")


def meta_record(*texts: Column) -> Column:
    """Whether a row speaks of a list of programs, not of one. (TXT-25)"""
    return has_any(F.lower(F.concat_ws(" ", *texts)), R.META_PHRASES)


def in_scope(overnight: Column, families: Column, types: Column, *texts: Column) -> Column:
    """Strong signals that a row belongs to the catalog. (TXT-25, ARR-06)"""
    empty = F.array().cast("array<string>")
    shared = F.arrays_overlap(F.coalesce(types, empty), F.array(*map(F.lit, R.KNOWN_TYPES)))
    return F.coalesce(overnight, F.lit(False)) | F.array_contains(F.coalesce(families, empty), "college-pre-college") | shared | has_any(F.lower(F.concat_ws(" ", *texts)), R.RESIDENTIAL_PHRASES)


def renamed(code: Column, names: Mapping[str, str], default: Column | None = None) -> Column:
    """A code's name in a small table; others get the default. (MAP-01, MAP-02)"""
    found = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[F.lower(compact(code))]
    return found if default is None else F.coalesce(found, default)


def label_of(pairs: Sequence[tuple[str, Sequence[str]]], lowered: Column) -> Column:
    """The label of the first pair of which some phrase occurs, else null."""
    return F.coalesce(*(F.when(has_any(lowered, words), F.lit(label)) for label, words in pairs))


EVIDENCE_PATTERN = r"(?i)\$\s?\d|\bages?\b|\bgrades?\b|overnight|residential|sleepaway|boarding|dorm"


def page_profile(html: Column, domain: str | None = None) -> Column:
    """What a page says at a glance: title, description, lang, prices, ages, duration, contact, overnight signals and up to eight
    sentences of evidence, by patterns over the markup and its text. The text is made once per page. ``domain`` is the site's own, for ``contact``. (TXT-17)"""
    meta = F.regexp_extract(html, r"""(?is)<meta[^>]*\bname=["']description["'][^>]*\bcontent=["']([^"']*)["']""", 1)
    base = F.struct(
        compact(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"), compact(meta).alias("description"), F.lower(F.regexp_extract(html, r'(?i)<html[^>]*\blang="([^"]*)"', 1)).alias("lang"), strip_html(html).alias("text")
    )

    def facts(p: Column) -> Column:
        text = p["text"]
        prices = bound(amounts(text), lambda a: F.struct(F.array_min(a).alias("low"), F.array_max(a).alias("high")))
        return F.struct(
            p["title"].alias("title"), p["description"].alias("description"), p["lang"].alias("lang"), prices.alias("prices"), ages_and_grades(text).alias("ages"),
            page_duration(text).alias("duration"), contact(text, domain).alias("contact"), overnight_signals(text).alias("signals"), evidence_sentences(text, EVIDENCE_PATTERN).alias("evidence"),
        )

    flat = lambda x: F.struct(x["title"].alias("title"), x["description"].alias("description"), x["lang"].alias("lang"), x["prices"]["low"].alias("price_min"), x["prices"]["high"].alias("price_max"), *(x[c].alias(c) for c in ("ages", "duration", "contact", "signals", "evidence")))
    return bound(bound(base, facts), flat)
