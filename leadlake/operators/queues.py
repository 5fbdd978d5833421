"""Work queues, query plans and page jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake import rules as R
from leadlake.functions import extract as X
from leadlake.functions import url as U
from leadlake.functions.text import compact, first_text, has_any, slug
from leadlake.functions.values import embedded_array, embedded_object, labels
from leadlake.operators.keyed import global_rank, keep_best, spread


def followups(df: DataFrame, id_col: str, rules: Sequence[tuple]) -> DataFrame:
    """One row per rule that holds: (condition, action, priority, reason and, if wanted, next step). (PIP-06)"""
    parts = ("action", "priority", "reason", "next_step")
    hits = F.array_compact(F.array(*(F.when(rule[0], F.struct(*(F.lit(x).alias(n) for n, x in zip(parts, rule[1:])))) for rule in rules)))  # noqa: B905
    items = df.select(F.col(id_col), F.inline(hits))
    return items.withColumn("queue_id", slug(F.concat_ws("-", F.col(id_col).cast("string"), "action")))


def query_scope(*parts: str | None) -> str:
    """Country and region as one suffix, without parts that name no place. (R12)"""
    return " ".join(p.strip() for p in parts if (p or "").strip().lower() not in R.IGNORED_SCOPE)


def query_templates(spark: SparkSession, family: str = "") -> DataFrame:
    """The default templates and those of a program family, in order, as a small table. (PIP-01)"""
    texts = (*R.DEFAULT_EXPANSIONS, *R.FAMILY_EXPANSIONS.get(family.lower(), ()))
    return spark.createDataFrame(list(enumerate(texts)), "template_order int, template string")


def query_plan(seeds: DataFrame, templates: DataFrame, scope: Column | None = None) -> DataFrame:
    """seed x template (a bounded table, broadcast), each also with the scope unless it has it already; first of each text in any
    case, with where it comes from: the seed's origin, _expanded and _scoped. (PIP-01, JON-07, R12)

    ``seeds`` has seed and seed_order, and may have origin (cli or file).
    """
    origin = F.col("origin") if "origin" in seeds.columns else F.lit("cli")
    paired = spread(seeds.withColumn("origin", origin)).join(F.broadcast(templates), F.lit(True))
    base = F.trim(F.replace(F.col("template"), F.lit("{seed}"), F.col("seed")))
    source = F.when(F.col("template") == "{seed}", F.col("origin")).otherwise(F.concat("origin", F.lit("_expanded")))
    scoped = F.lit(None).cast("string") if scope is None else F.when((scope != "") & ~F.contains(F.lower(base), F.lower(scope)), F.concat_ws(" ", base, scope))
    variant = lambda n, query, label: F.struct(F.lit(n).alias("variant"), query.alias("query"), label.alias("source"))
    variants = F.array_compact(F.array(variant(0, base, source), F.when(scoped.isNotNull(), variant(1, scoped, F.concat(source, F.lit("_scoped"))))))
    rows = paired.select("seed", "seed_order", "template_order", F.inline(variants)).withColumn("key", F.lower("query"))
    best = keep_best(rows, ["key"], [F.col("seed_order"), F.col("template_order"), F.col("variant")]).drop("key")
    return best.withColumn("parent_query", F.when(F.col("query") != F.col("seed"), F.col("seed")))


def inverted(df: DataFrame, key: str, order: Column, **values: Column) -> DataFrame:
    """Per key the distinct non-null values of each column in first-seen order, and the number of rows n. (AGG-09)

    Rows are reduced to one per key and value before a key's values are collected, so a list grows with the distinct
    values that it is to hold, not with the rows.
    """
    lists = df.groupBy(key).agg(F.count("*").alias("n"))
    for name, value in values.items():
        firsts = df.select(key, value.alias("_v"), order.alias("_o")).filter("_v is not null").groupBy(key, "_v").agg(F.min("_o").alias("_o"))
        held = firsts.groupBy(F.col(key).alias("_key")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_v"))), lambda x: x["_v"]).alias(name))
        lists = lists.join(held, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return lists.select(key, *(F.coalesce(name, F.array()).alias(name) for name in values), "n")


def accept_hits(hits: DataFrame, url_col: str, order: Sequence[Column], allow: Sequence[str] = (), deny: Sequence[str] = ()) -> DataFrame:
    """Hits of allowed hosts, the first of each canonical URL. (PIP-03, FLT-12)"""
    clean = hits.withColumn("normalized_url", U.canonical(F.col(url_col))).withColumn("host", U.host(F.col("normalized_url")))
    return keep_best(clean.filter(U.allowed(F.col("host"), allow, deny)), ["normalized_url"], order)


def ranked_hits(hits: DataFrame, url_col: str, order: Sequence[Column], allow: Sequence[str] = (), deny: Sequence[str] = ()) -> DataFrame:
    """Accepted hits with their rank over all queries. (PIP-03, WIN-07)"""
    return global_rank(accept_hits(hits, url_col, order, allow, deny), order)


def query_log(specs: DataFrame, hits: DataFrame, query: str, url_col: str, order: Sequence[Column], allow: Sequence[str] = (), deny: Sequence[str] = ()) -> DataFrame:
    """(query, raw_results, accepted_results) of every query asked, also of those without hits. (AGG-11)"""
    raw = hits.groupBy(query).agg(F.count("*").alias("raw"))
    kept = accept_hits(hits, url_col, order, allow, deny).groupBy(query).agg(F.count("*").alias("accepted"))
    both = specs.select(query).distinct().join(raw, query, "left").join(kept, query, "left")
    return both.select(query, *(F.coalesce(c, F.lit(0)).alias(f"{n}_results") for c, n in (("raw", "raw"), ("accepted", "accepted"))))


def snapshot_changes(old: DataFrame, new: DataFrame, key: str, body: str) -> DataFrame:
    """(key, change) of two snapshots by content hash: captured for new or changed, unchanged, skipped_existing where there is no new page, capture_failed for an empty one. (PIP-10)"""
    was, now = (d.select(key, F.lit(True).alias(f"{n}_there"), F.sha2(body, 256).alias(f"{n}_hash")) for d, n in ((old, "old"), (new, "new")))
    change = F.when(F.col("new_there").isNull(), "skipped_existing").when(F.col("new_hash").isNull(), "capture_failed").when(F.col("old_hash").eqNullSafe(F.col("new_hash")), "unchanged").otherwise("captured")
    return was.join(now, key, "full").select(key, change.alias("change"))


def dossier(df: DataFrame, title: Column, *sections: tuple[str, Column]) -> DataFrame:
    """Adds Markdown text: a title and the sections that have text. (STR-12)"""
    body = [F.when(first_text(v).isNotNull(), F.concat(F.lit(f"## {name}\n\n"), F.trim(v))) for name, v in sections]
    return df.withColumn("dossier", F.concat_ws("\n\n", F.concat(F.lit("# "), title), *body))


def dossiers(candidates: DataFrame) -> DataFrame:
    """Adds reasons (why a row can't be rendered; empty if it can), confidence, operator_type, front_matter (nested JSON, which
    is YAML too) and dossier, the Markdown of a candidate. (PIP-16, TXT-21 to TXT-24, R17)"""
    from leadlake.operators.candidates import skip_reasons

    c = lambda n: compact(F.col(n))
    has = lambda n: F.col(n) if n in candidates.columns else F.lit(None).cast("string")
    overnight, active = c("overnight_evidence_snippet") != "", (c("activity_status_guess") == "active_recent") & (c("recent_activity_evidence_snippet") != "")
    ages, grades = X.labelled_range(F.col("eligibility_summary"), "age"), X.labelled_range(F.col("eligibility_summary"), "grade")
    span = lambda name, r: F.when(r["low"].isNotNull(), F.concat(F.lit(f"{name} "), r["low"].cast("string"), F.lit("-"), r["high"].cast("string"), F.lit(".")))
    label, least, most = F.coalesce("duration_guess.label", F.lit("unknown")), F.col("duration_guess.min_days"), F.col("duration_guess.max_days")
    days = F.when(least.isNotNull() | most.isNotNull(), F.concat(F.coalesce(least.cast("string"), F.lit("?")), F.lit(" to "), F.coalesce(most.cast("string"), F.lit("?")), F.lit(" days.")))
    family = F.coalesce(F.nullif(F.array_join(F.slice("program_family", 1, 3), ", "), F.lit("")), F.lit("overnight"))
    place, url = F.concat(c("city"), F.lit(", "), c("region")), F.nullif(c("canonical_url"), F.lit(""))
    title = F.concat(c("name"), F.lit(" at "), c("venue_name"))
    quick = F.concat(c("name"), F.lit(": "), F.when(label != "unknown", F.concat(label, F.lit(" "))).otherwise(""), family, F.lit(" program, "), place, F.lit("."))
    bullets = lambda values: F.array_join(F.transform(F.array_compact(values), lambda v: F.concat(F.lit("- "), v)), "\n")
    fact = lambda name, v: F.concat(F.lit(f"{name}: "), v)
    facts = F.array(
        fact("Operator", first_text(c("operator_name"), F.lit("unknown"))), fact("Venue", first_text(c("venue_name"), F.lit("unknown"))), fact("Place", place), fact("Site", url),
        F.when(F.size("program_family") > 0, fact("Families", F.array_join("program_family", ", "))), F.when(F.size("camp_types") > 0, fact("Types", F.array_join("camp_types", ", "))), F.when(label != "unknown", fact("Length", label)),
    )
    needs = F.transform("validation_needs", lambda n: F.initcap(F.replace(n, F.lit("_"), F.lit(" "))))
    sections = (
        ("Quick Take", quick), ("Verified Facts", bullets(facts)), ("Overnight Evidence", c("overnight_evidence_snippet")), ("Recent Activity Evidence", c("recent_activity_evidence_snippet")),
        ("Ages and Grades", F.concat_ws(" ", F.col("eligibility_summary"), span("Ages", ages), span("Grades", grades))), ("Session Length", F.concat_ws(" ", F.concat(label, F.lit(".")), days)), ("Pricing", F.col("pricing_summary")),
        ("Location", F.concat_ws(" ", c("venue_name"), place, F.array_join("notes", " "))), ("Contact", url), ("Open Questions", bullets(needs)), ("Sources", bullets(F.array(url))),
    )
    boarding = F.when(has_any(F.lower(F.concat_ws(" ", "overnight_evidence_snippet", "pricing_summary")), R.BOARDING_PHRASES), F.lit(True))
    made = candidates.withColumns({
        "reasons": skip_reasons(candidates), "confidence": X.confidence(F.col("validation_needs"), F.col("record_basis"), overnight, active), "operator_type": X.operator_type(F.coalesce("operator_name", F.lit("")), F.col("name")),
        "_ages": ages, "_grades": grades, "_boarding": boarding,
    })
    given_url = lambda held: F.when(held, url)
    header = F.to_json(F.struct(
        slug(F.concat_ws("-", "country", "region", "city", "venue_name")).alias("venue_id"), slug(F.col("name")).alias("camp_id"), F.col("candidate_id").alias("record_id"), "name", title.alias("display_name"), "country", "region", "city", "venue_name", "program_family", "camp_types", "priority_flags",
        F.nullif(compact(has("source_language")), F.lit("")).alias("source_language_primary"), F.col("activity_status_guess").alias("activity_status"), F.lit(R.ACTIVITY_MONTHS).alias("activity_evidence_window_months"),
        F.struct(F.col("operator_name").alias("name"), F.col("operator_type").alias("type")).alias("operator"), F.struct(F.col("_ages.low").alias("min"), F.col("_ages.high").alias("max")).alias("ages"), F.struct(F.col("_grades.low").alias("min"), F.col("_grades.high").alias("max")).alias("grades"),
        F.struct(least.alias("min_days"), most.alias("max_days")).alias("duration"), F.struct(F.create_map(*(F.lit(x) for kv in R.CURRENCY_BY_COUNTRY.items() for x in kv))[F.col("country")].alias("currency"), F.col("_boarding").alias("boarding_included")).alias("pricing"),
        F.struct(url.alias("canonical_url"), given_url(c("recent_activity_evidence_snippet") != "").alias("session_dates_url"), given_url(c("pricing_summary") != "").alias("pricing_url")).alias("website"),
        F.struct(overnight.alias("overnight_confirmed"), active.alias("active_past_2_years_confirmed"), F.col("confidence")).alias("verification"),
        F.struct(given_url(overnight).alias("overnight_source_url"), given_url(active).alias("recent_activity_source_url"), given_url(label != "unknown").alias("duration_source_url"), given_url(c("pricing_summary") != "").alias("pricing_source_url")).alias("evidence"),
        F.lit("draft").alias("draft_status"),
    ))
    return dossier(made.withColumn("front_matter", header), title, *sections).drop("_ages", "_grades", "_boarding")


VERDICT = "verdict string, confidence string, reason string, exclusion_reason string, signals array<string>"


def guarded(said: Column, strong: Column, meta: Column, negative: str) -> Column:
    """A verdict as parsed, or, if it is negative on a row with strong signals that is no meta record, unclear at medium confidence, with the reason and the signals extended. (R14)"""
    held = F.coalesce((said["verdict"] == negative) & strong & ~meta, F.lit(False))
    reason = F.trim(F.concat_ws(" ", said["reason"], F.lit(R.GUARD_REASON)))
    signals = F.array_append(F.filter(F.coalesce(said["signals"], F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "")), F.lit(R.GUARD_SIGNAL))
    changed = F.struct(F.lit("unclear").alias("verdict"), F.lit("medium").alias("confidence"), reason.alias("reason"), F.lit(None).cast("string").alias("exclusion_reason"), signals.alias("signals"))
    return F.when(held, changed).otherwise(said)


def with_verdict(df: DataFrame, said: Column, strong: Column, meta: Column, negative: str) -> DataFrame:
    """``df`` plus verdict, confidence, reason, exclusion_reason, signals and excluded: a negative verdict of high or medium confidence excludes."""
    judged = df.withColumn("_v", guarded(said, strong, meta, negative))
    excluded = F.coalesce((F.col("_v.verdict") == negative) & F.col("_v.confidence").isin("high", "medium"), F.lit(False))
    return judged.withColumns({n: F.col(f"_v.{n}") for n in ("verdict", "confidence", "reason", "exclusion_reason", "signals")} | {"excluded": excluded}).drop("_v")


def triage(df: DataFrame, reply: Column, strong: Column, negative: str = "no", meta: Column | None = None) -> DataFrame:
    """``df`` with the verdict columns from a reply that holds a JSON object in free text. (PIP-15)"""
    return with_verdict(df, F.from_json(embedded_object(reply), VERDICT), F.coalesce(strong, F.lit(False)), F.lit(False) if meta is None else meta, negative)


def triage_batch(df: DataFrame, id_col: str, replies: DataFrame, reply: str, strong: Column, negative: str = "no", meta: Column | None = None) -> DataFrame:
    """``df`` with the verdict columns and skipped (missing_reply where no batch reply answers for the id). A reply holds a JSON
    array of verdicts with ids in free text. (PIP-15, JON-11)"""
    items = replies.select(F.explode(F.from_json(embedded_array(F.col(reply)), f"array<struct<id string, {VERDICT}>>")).alias("_said")).filter("_said.id is not null")
    last = items.groupBy(F.col("_said.id").alias("_id")).agg(F.max("_said").alias("_said"))
    joined = df.join(last, F.col(id_col).cast("string") == F.col("_id"), "left").withColumn("skipped", F.when(F.col("_id").isNull(), "missing_reply"))
    return with_verdict(joined, F.col("_said").dropFields("id"), F.coalesce(strong, F.lit(False)), F.lit(False) if meta is None else meta, negative).drop("_id", "_said")


def validation_needs(basis: Column, types: Column, activity: Column, duration: Column, recent: Column, price: Column, contact: Column, ages: Column, no_type: str = "unknown") -> Column:
    """What a candidate still needs, in rule order. (ARR-05, PIP-04, R4)"""
    return labels(
        (basis == "multi_venue_candidate", "split_into_venue_records"), (basis == "venue_candidate_pending_confirmation", "confirm_exact_venue"), (types == F.array(F.lit(no_type)), "confirm_overnight"),
        ((activity != "active_recent") | ~recent, "confirm_recent_activity"), (duration == "unknown", "confirm_duration"), (~price, "pricing"), (~contact, "contact"), (~ages, "ages_or_grades"),
    )
