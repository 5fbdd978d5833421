"""Staged field extraction over candidates: a registry of extractors, later phases that only improve, and patches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadlake import rules as R
from leadlake.functions import extract as X
from leadlake.functions import url as U
from leadlake.functions import values as V
from leadlake.functions.text import has_any
from leadlake.operators.keyed import computed, keep_best, rank_of, spread

#: struct<status, confidence, evidence, the type's own fields> of a candidate's columns.
Extractor = Callable[[], Column]


def result(status: Column, confidence: Column, evidence: Column, **fields: Column) -> Column:
    parts = {"status": status, "confidence": confidence, "evidence": F.nullif(evidence, F.lit("")), **fields}
    return F.struct(*(v.alias(n) for n, v in parts.items()))


def pricing() -> Column:
    """From pricing_summary: found with an amount of 50 or more and a currency, partial with any text. (TXT-09)"""
    text = F.coalesce("pricing_summary", F.lit(""))
    large = F.filter(X.amounts(text), lambda x: x >= 50)
    some, currency, low = F.size(large) > 0, X.currency(text), F.lower(text)
    status = F.when(text == "", "missing").when(some & currency.isNotNull(), "found").otherwise("partial")
    confidence = F.when(some & currency.isNotNull(), "high").when(some, "medium").otherwise("low")
    return result(
        status, confidence, text, currency=currency, amount_min=F.array_min(large), amount_max=F.array_max(large), boarding_included=F.when(some & has_any(low, R.PHASE1_BOARDING_WORDS), F.lit(True)),
        fees_text=F.when(some & has_any(low, R.FUNDED_PHRASES), text), pricing_url=F.when(some, F.col("canonical_url")),
    )


def duration() -> Column:
    """From the duration guess: found with days, partial with a telling label. (TXT-11)"""
    label, least, most = F.coalesce("duration_guess.label", F.lit("")), F.col("duration_guess.min_days"), F.col("duration_guess.max_days")
    flagged = F.coalesce(F.col("priority_flags.one_week_plus"), F.lit(False)) | F.coalesce(least >= 7, F.lit(False)) | F.coalesce(most >= 7, F.lit(False))
    dated = least.isNotNull() | most.isNotNull()
    status = F.when(dated, "found").when((label != "") & ~label.isin(*R.EMPTY_DURATIONS), "partial").otherwise("missing")
    confidence = F.when(F.coalesce((least > 0) & (most > 0), F.lit(False)), "high").when(dated, "medium").otherwise("low")
    return result(status, confidence, label, min_days=least, max_days=most, session_model=X.label_of(R.SESSION_MODELS, F.lower(label)), one_week_plus=F.when(flagged, F.lit(True)), duration_text=F.nullif(label, F.lit("")))


def age_grade() -> Column:
    """From eligibility_summary, its grade wordings in turn, and the audience's usual ages. (TXT-13, MAP-01)"""
    text = F.coalesce("eligibility_summary", F.lit(""))
    pair = lambda pattern: (F.regexp_extract(text, pattern, 1).try_cast("int"), F.regexp_extract(text, pattern, 2).try_cast("int"))
    ages, ranged, ordinal = pair(R.AGE_RANGE_PATTERN), pair(R.GRADE_RANGE_PATTERN), pair(R.ORDINAL_GRADES_PATTERN)
    singles = X.numbers(text, R.GRADE_SINGLE_PATTERN)
    usual = F.create_map(*(F.lit(x) for k, (a, b) in R.AUDIENCE_AGES.items() for x in (k, f"{a}-{b}")))[F.coalesce("audience_type", F.lit(""))]
    phrase = F.when(F.rlike(text, F.lit(R.SENIOR_PATTERN)), F.array(F.lit(12), F.lit(12))).when(F.rlike(text, F.lit(R.JUNIOR_SENIOR_PATTERN)), F.array(F.lit(11), F.lit(12))).when(F.rlike(text, F.lit(R.TENTH_ELEVENTH_PATTERN)), F.array(F.lit(10), F.lit(11)))
    grades = F.when(ranged[0].isNotNull(), F.array(*ranged)).when(F.size(singles) > 0, F.array(F.array_min(singles), F.array_max(singles))).when(ordinal[0].isNotNull(), F.array(*ordinal)).otherwise(phrase)
    age = [F.coalesce(ages[k], F.split_part(usual, F.lit("-"), F.lit(k + 1)).try_cast("int")) for k in (0, 1)]
    status = F.when(age[0].isNotNull() | grades.isNotNull(), "found").when(text != "", "partial").otherwise("missing")
    confidence = F.when(age[0].isNotNull(), "high").when(grades.isNotNull(), "medium").otherwise("low")
    return result(status, confidence, text, age_min=age[0], age_max=age[1], grade_min=F.get(grades, F.lit(0)), grade_max=F.get(grades, F.lit(1)), eligibility_text=F.nullif(text, F.lit("")))


def contact() -> Column:
    """What is known without a page: the site and the operator. (TXT-15)"""
    url, operator = (F.coalesce(c, F.lit("")) != "" for c in ("canonical_url", "operator_name"))
    none = F.lit(None).cast("string")
    return result(
        F.when(url | operator, "partial").otherwise("missing"), F.when(url & operator, "medium").otherwise("low"), none, contact_email=none, contact_phone=none, inquiry_url=F.col("canonical_url"), operator_name=F.col("operator_name")
    )


def taxonomy() -> Column:
    """Known tags of both kinds, and other families after the known ones. (ARR-04)"""
    families = V.known_and_extra(F.array_distinct("program_family"), R.STANDARD_FAMILIES, ("institutional-lead", "unspecified"))
    named, types = F.concat(families["known"], families["extra"]), V.known_and_extra(F.array_distinct("camp_types"), R.STANDARD_TYPES)["known"]
    both, any_tag = (F.size(named) > 0) & (F.size(types) > 0), (F.size(named) > 0) | (F.size(types) > 0)
    status, sure = F.when(any_tag, "found").otherwise("missing"), F.when(both, "high").when(any_tag, "medium").otherwise("low")
    return result(status, sure, F.lit(None).cast("string"), program_family_tags=named, camp_type_tags=types)


#: The extractors in order; pass your own mapping to ``phase1`` for others. (UDF-01)
EXTRACTORS: Mapping[str, Extractor] = {"pricing": pricing, "duration": duration, "age_grade": age_grade, "contact": contact, "taxonomy": taxonomy}
FETCHED = ("pricing", "duration", "age_grade", "contact")


def phase1(candidates: DataFrame, extractors: Mapping[str, Extractor] = EXTRACTORS) -> DataFrame:
    """``candidates`` plus one struct per extractor and missing, the types to look for on pages. One projection, after the candidates are dealt evenly over the cores. (PIP-12)"""
    done = spread(candidates).withColumns({name: f() for name, f in extractors.items()})
    return done.withColumn("missing", V.labels(*((F.col(f"{t}.status") == "missing", t) for t in FETCHED if t in extractors)))


def long_results(enriched: DataFrame, types: Sequence[str] = tuple(EXTRACTORS)) -> DataFrame:
    """(candidate_id, enrichment_type, status, confidence, evidence, fields as JSON), one row per candidate and type."""
    rows = F.array(*(F.struct(F.lit(t).alias("enrichment_type"), *(F.col(f"{t}.{c}").alias(c) for c in ("status", "confidence", "evidence")), F.to_json(F.col(t).dropFields("status", "confidence", "evidence")).alias("fields")) for t in types))
    return enriched.select("candidate_id", F.inline(rows))


def histograms(results: DataFrame) -> DataFrame:
    """(enrichment_type, measure, value, n) of statuses and confidences. (AGG-07)"""
    pairs = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in ("status", "confidence")))
    return results.select("enrichment_type", F.inline(pairs)).groupBy("enrichment_type", "measure", "value").agg(F.count("*").alias("n"))


def enrichment_followups(candidates: DataFrame, results: DataFrame) -> DataFrame:
    """Candidates whose last result of some type is missing or that have none, with these types. (PIP-12, JON-06)"""
    last = [F.max_by(F.when(F.col("enrichment_type") == t, F.col("status")), F.when(F.col("enrichment_type") == t, F.col("seq"))).alias(f"_{t}") for t in FETCHED]
    wide = results.groupBy("candidate_id").agg(*last)
    absent = V.labels(*((F.coalesce(F.col(f"_{t}"), F.lit("missing")) == "missing", t) for t in FETCHED))
    joined = candidates.select("candidate_id", "canonical_url", "name").join(wide, "candidate_id", "left").withColumn("missing_enrichment_types", absent)
    return joined.filter(F.size("missing_enrichment_types") > 0).select("candidate_id", "canonical_url", "name", "missing_enrichment_types", F.lit("enrichment_followup_needed").alias("status"))


def with_status(results: DataFrame, candidates: DataFrame, status: Sequence[str]) -> DataFrame:
    """Results of the given statuses with their candidates. (JON-02)"""
    return results.filter(F.col("status").isin(*status)).withColumnRenamed("status", "enrichment_status").join(candidates, "candidate_id", "inner")


def from_page(text: Column) -> dict[str, Column]:
    """What a page's text says of each type, as the fields that page extraction fills; null where it says nothing. (TXT-08, TXT-10, TXT-12, TXT-14)"""
    seen = X.contact(text)
    return {"pricing": X.pricing(text), "duration": X.page_duration(text), "age_grade": X.ages_and_grades(text), "contact": F.when(seen["status"] != "missing", seen)}


def improved(kind: str, old: StructType, found: str, fields: StructType, status: Column, evidence: Column) -> Column:
    """The old struct, or one with the fields that were found if their status ranks higher. (WIN-09)"""
    fresh = {"status": status, "confidence": F.lit("medium"), "evidence": evidence}
    new = F.struct(*(fresh.get(f.name, F.col(found)[f.name] if f.name in fields.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in old.fields))
    return F.when(F.col(found).isNotNull() & (rank_of(status) > rank_of(F.col(f"{kind}.status"))), new).otherwise(F.col(kind))


def phase2(enriched: DataFrame, pages: DataFrame, url: str, text: str) -> DataFrame:
    """``enriched`` (from ``phase1``) after a look at each candidate's page: missing types are extracted from its text, a contact
    also where no e-mail is known, and win only with a higher status; phase2 lists the types that won. (PIP-13)

    Pages are joined by canonical URL, the first by text per URL; a candidate without a page stays as it is.
    """
    texts = pages.select(U.canonical(F.col(url)).alias("_url"), F.col(text).alias("_text")).filter("_text is not null").groupBy("_url").agg(F.min("_text").alias("_text"))
    joined = enriched.withColumn("_key", F.when(F.col("canonical_url").isNotNull(), U.canonical(F.col("canonical_url"))))
    joined = joined.join(texts, joined["_key"] == texts["_url"], "left").drop("_key", "_url")
    found = {}
    for kind, said in from_page(F.col("_text")).items():
        wanted = F.col("contact.contact_email").isNull() if kind == "contact" else F.array_contains("missing", kind)
        if kind == "contact":
            said = F.when(said.isNotNull(), F.struct(said["email"].alias("contact_email"), said["phone"].alias("contact_phone"), F.col("canonical_url").alias("inquiry_url"), F.col("contact.operator_name").alias("operator_name"), said["status"].alias("found_as")))
        found[kind] = F.when(wanted & F.col("_text").isNotNull(), said)
    read = computed(joined.withColumns({f"_found_{kind}": said for kind, said in found.items()}))  # a page is searched once
    schema, merged, gained = read.schema, {}, []
    for kind in found:
        name = f"_found_{kind}"
        status = F.when(F.col(f"{name}.contact_email").isNotNull(), "found").otherwise("partial") if kind == "contact" else F.lit("found")
        gained.append(F.when(F.col(name).isNotNull() & (rank_of(status) > rank_of(F.col(f"{kind}.status"))), F.lit(kind)))
        merged[kind] = improved(kind, schema[kind].dataType, name, schema[name].dataType, status, F.lit(None).cast("string"))
    return read.withColumns({"phase2": F.array_compact(F.array(*gained))} | merged).drop("_text", *(f"_found_{kind}" for kind in found))


def from_subpages(candidates: DataFrame, hits: DataFrame, pages: DataFrame, extract: Callable[[Column], Column], useful: Callable[[Column], Column], n: int = 3) -> DataFrame:
    """(candidate_id, url, value): of the first ``n`` hits of a candidate, those on its host in order of rank, the first with a
    useful value, from the page or else from the hit's snippet. (PIP-14)

    ``hits`` has candidate_id, rank, url and snippet; ``pages`` url and text; a host below the candidate's counts as its own.
    """
    hosts = candidates.select("candidate_id", U.host(U.canonical(F.col("canonical_url"))).alias("_host"))
    near = hits.withColumn("_rank", F.row_number().over(Window.partitionBy("candidate_id").orderBy("rank", "url"))).filter(F.col("_rank") <= n)
    near = near.withColumn("_url", U.canonical(F.col("url"))).withColumn("_hit", U.host(F.col("_url"))).join(hosts, "candidate_id")
    near = near.filter((F.col("_host") == "") | (F.col("_hit") == F.col("_host")) | F.endswith("_hit", F.concat(F.lit("."), F.col("_host"))))
    texts = pages.select(U.canonical(F.col("url")).alias("_page"), "text").groupBy("_page").agg(F.min("text").alias("_text"))
    read = near.join(texts, near["_url"] == texts["_page"], "left").withColumns({"_a": extract(F.col("_text")), "_b": extract(F.col("snippet"))})
    value = F.when(useful(F.col("_a")), F.col("_a")).when(useful(F.col("_b")), F.col("_b"))
    return keep_best(read.withColumn("value", value).filter("value is not null").select("candidate_id", F.col("_url").alias("url"), "value", "_rank"), ["candidate_id"], [F.col("_rank")]).drop("_rank")


def apply_patches(catalog: DataFrame, patches: DataFrame, key: str, payload: str) -> tuple[DataFrame, DataFrame]:
    """(patches to apply, rejected patches with reason): no_key, no_payload or unknown_key. (JON-12)

    The patches to apply are the input of ``keyed.null_fill``; the last of a key is for ``keyed.keep_last`` to choose.
    """
    known = catalog.select(key, F.lit(True).alias("_known")).distinct()
    joined = patches.join(known, key, "left")
    reason = F.when(F.coalesce(F.col(key).cast("string"), F.lit("")) == "", "no_key").when(F.col(payload).isNull(), "no_payload").when(F.col("_known").isNull(), "unknown_key")
    judged = joined.withColumn("reason", reason).drop("_known")
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


#: Target -> (type whose status must be found or partial, least, most) of null-filling.
FILL_RANGES = {
    "pricing_min": ("pricing", 10, 999_999), "pricing_max": ("pricing", 10, 999_999), "duration_min_days": ("duration", 1, 365), "duration_max_days": ("duration", 1, 365),
    "ages_min": ("age_grade", 3, 25), "ages_max": ("age_grade", 3, 25), "grades_min": ("age_grade", 0, 16), "grades_max": ("age_grade", 0, 16),
}
FILL_SOURCES = {
    "pricing_min": "pricing.amount_min", "pricing_max": "pricing.amount_max", "duration_min_days": "duration.min_days", "duration_max_days": "duration.max_days",
    "ages_min": "age_grade.age_min", "ages_max": "age_grade.age_max", "grades_min": "age_grade.grade_min", "grades_max": "age_grade.grade_max",
}


def fill_catalog(catalog: DataFrame, enriched: DataFrame, key: str = "candidate_id") -> DataFrame:
    """Catalog rows with null price, duration, age and grade targets filled from found or partial results in range, and updated, the list of targets filled. (PIP-11, R15)"""
    found = enriched.select(key, *(F.col(c).alias(f"_new_{t}") for t, c in FILL_SOURCES.items()), *(F.col(f"{t}.status").alias(f"_status_{t}") for t in ("pricing", "duration", "age_grade")))
    joined = catalog.join(found, key, "left")
    fills = {}
    for target, (kind, low, high) in FILL_RANGES.items():
        value = F.col(f"_new_{target}")
        fills[target] = F.when(F.col(target).isNull() & F.col(f"_status_{kind}").isin("found", "partial") & value.between(low, high), value)
    updated = V.labels(*((v.isNotNull(), t) for t, v in fills.items()))
    rest = [F.col(f"`{c}`") for c in catalog.columns if c not in fills]
    return joined.select(*rest, *(F.coalesce(F.col(t), v.cast(catalog.schema[t].dataType)).alias(t) for t, v in fills.items()), updated.alias("updated"))
