"""Candidates: normalisation of noisy leads, keep-best over reports, review queues, query packs and region plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlake import rules as R
from leadlake.functions import extract as X
from leadlake.functions import url as U
from leadlake.functions import values as V
from leadlake.functions.text import compact, has_any, slug
from leadlake.operators import catalog as C
from leadlake.operators import keyed as K
from leadlake.operators import queues as Q
from leadlake.scratch import materialise

STRINGS = (
    "candidate_id candidate_name name title url query snippet operator_name venue_name city region country canonical_url source_language uncertainty overnight_evidence_snippet recent_activity_evidence_snippet "
    "record_basis candidate_shape activity_status_guess duration_hint_text contact contact_email contact_phone pricing price tuition ages grades age_range grade_range status pricing_summary eligibility_summary audience_type"
).split()
LISTS = ("program_family", "program_family_tags", "provisional_program_family_tags", "camp_types", "camp_type_tags", "validation_needs", "notes")
DURATION = "struct<label: string, min_days: int, max_days: int>"
FLAGS = "struct<college_precollege: boolean, one_week_plus: boolean, likely_college_precollege: boolean, likely_one_week_plus: boolean>"
SNIPPET = "struct<snippet: string>"
STRUCTS = {"duration_guess": DURATION, "priority_flags": FLAGS, "overnight_evidence": SNIPPET, "recent_activity_evidence": SNIPPET}
#: Every field that normalisation reads, as a schema for JSON scans.
SCHEMA = ", ".join([*(f"{c} string" for c in STRINGS), *(f"{c} array<string>" for c in LISTS), *(f"{c} {t}" for c, t in STRUCTS.items())])
TEXT_FIELDS = ("candidate_name", "name", "title", "snippet", "query", "overnight_evidence_snippet", "recent_activity_evidence_snippet", "venue_name", "operator_name", "uncertainty")


def whole(df: DataFrame) -> DataFrame:
    """``df`` with the fields of ``SCHEMA`` that it lacks as nulls."""
    types = {**dict.fromkeys(STRINGS, "string"), **dict.fromkeys(LISTS, "array<string>"), **STRUCTS}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


def given(*values: Column) -> Column:
    """The first value that is not null and not empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def normalised(df: DataFrame, year: int, defaults: Mapping[str, str] | None = None, families: R.TagRules = R.FAMILIES, types: R.TagRules = R.CAMP_TYPES) -> DataFrame:
    """Candidates of raw leads; other columns of ``df`` pass through. One projection in three steps. (PIP-04, R4 to R8)

    A run's default wins over the record for city and venue, the record's own value for region and country. Families, types,
    needs and flags that a record brings are kept; the others follow from its texts by the rule packs. A nested text counts
    where the flat field is empty. (JSN-05) Every step is computed once per row, whatever is asked of the result.
    The raw leads are dealt evenly over the cores first.
    """
    defaults, own = defaults or {}, [c for c in df.columns if c not in (*STRINGS, *LISTS, *STRUCTS)]
    c = lambda name: F.col(f"`{name}`")
    run = lambda name: F.lit(defaults.get(name)).cast("string")
    none = F.array().cast("array<string>")
    rows = whole(K.spread(df))
    extracted = rows.withColumns({
        "_name": F.coalesce(given(c("candidate_name"), c("name"), c("title"), c("url")), F.lit("unknown-candidate")),
        "_city": F.coalesce(run("city"), c("city")),
        "_region": given(c("region"), run("region"), F.lit("UNK")),
        "_country": given(c("country"), run("country"), F.lit("US")),
        "_venue": given(run("venue_name"), c("venue_name")),
        "_url": given(c("canonical_url"), c("url")),
        "_overnight": given(c("overnight_evidence_snippet"), F.col("overnight_evidence.snippet"), c("snippet")),
        "_recent": given(c("recent_activity_evidence_snippet"), F.col("recent_activity_evidence.snippet")),
        "_text": compact(F.concat_ws(" ", *(c(t) for t in TEXT_FIELDS))),
        "_tags": F.concat(*(F.coalesce(c(t), none) for t in ("provisional_program_family_tags", "program_family_tags", "camp_type_tags"))),
    }).withColumn("_hint", X.provisional(F.col("_tags")))
    extracted = K.computed(extracted)
    tagged = extracted.withColumns({
        "_families": V.merged(c("program_family"), c("program_family_tags"), F.col("_hint.families"), X.tags(F.col("_text"), families)),
        "_types": V.merged(c("camp_types"), c("camp_type_tags"), F.col("_hint.types"), X.tags(F.col("_text"), types)),
        "_duration": F.coalesce(F.when(c("duration_guess").isNotNull(), F.struct(F.coalesce(given(F.col("duration_guess.label")), F.lit("unknown")).alias("label"), F.col("duration_guess.min_days").alias("min_days"), F.col("duration_guess.max_days").alias("max_days"))),
                                F.col("_hint.duration"), X.duration(F.concat_ws(" ", F.col("_text"), c("duration_hint_text"), F.array_join("_tags", " ")))),
        "_basis": F.coalesce(X.renamed(given(c("record_basis"), c("candidate_shape")), R.BASIS_NAMES), X.record_basis(F.col("_venue"), c("uncertainty"), F.col("_city"))),
        "_activity": F.coalesce(given(c("activity_status_guess")), V.activity(F.col("_text"), year)),
        "_clean": F.when(F.col("_url").isNotNull(), U.canonical(F.col("_url"))),
    })
    tagged = K.computed(tagged).withColumns({"_families": V.without_sentinel(F.col("_families"), families.default or ""), "_types": V.without_sentinel(F.col("_types"), types.default or "")})
    some = lambda *names: given(*(c(n) for n in names)).isNotNull()
    derived = Q.validation_needs(
        F.col("_basis"), F.col("_types"), F.col("_activity"), F.col("_duration.label"), F.col("_recent").isNotNull(), some("pricing", "price", "tuition"), some("contact", "contact_email", "contact_phone"),
        some("ages", "grades", "age_range", "grade_range"), types.default or "",
    )
    flags = F.when(c("priority_flags").isNotNull(), F.struct(
        F.coalesce(F.col("priority_flags.college_precollege"), F.col("priority_flags.likely_college_precollege")).alias("college_precollege"),
        F.coalesce(F.col("priority_flags.one_week_plus"), F.col("priority_flags.likely_one_week_plus")).alias("one_week_plus"),
    )).otherwise(F.struct(F.array_contains("_families", "college-pre-college").alias("college_precollege"), (F.coalesce(F.col("_duration.min_days"), F.lit(0)) >= 7).alias("one_week_plus")))
    labels = F.transform(F.filter(F.concat("_families", "_types"), lambda x: (x != "") & (x != "unspecified")), lambda x: slug(x))
    city = F.when(given(F.col("_city")).isNotNull(), F.array(slug(F.col("_city")))).otherwise(none)
    uncertainty = compact(c("uncertainty"))
    return K.computed(
        tagged, *(c(x) for x in own),
        F.coalesce(given(c("candidate_id")), X.candidate_id(F.col("_country"), F.col("_region"), F.col("_city"), F.col("_name"), F.col("_venue"), U.host(F.col("_clean")), F.col("_basis") == "multi_venue_candidate")).alias("candidate_id"),
        F.col("_basis").alias("record_basis"), F.col("_name").alias("name"), c("operator_name"), F.coalesce(F.col("_venue"), F.lit("venue to be confirmed")).alias("venue_name"),
        F.col("_city").alias("city"), F.col("_region").alias("region"), F.col("_country").alias("country"), F.col("_clean").alias("canonical_url"), c("source_language"),
        F.col("_families").alias("program_family"), F.col("_types").alias("camp_types"), flags.alias("priority_flags"), F.col("_activity").alias("activity_status_guess"), F.col("_duration").alias("duration_guess"),
        F.array_distinct(F.concat(F.array(slug(F.col("_country")), slug(F.col("_region"))), city, labels)).alias("tags"),
        F.col("_overnight").alias("overnight_evidence_snippet"), F.col("_recent").alias("recent_activity_evidence_snippet"),
        F.when(F.size(c("validation_needs")) > 0, F.array_sort(F.array_distinct(c("validation_needs")))).otherwise(F.sort_array(derived)).alias("validation_needs"),
        V.merged(c("notes"), F.array(uncertainty)).alias("notes"), F.coalesce(given(c("status")), F.lit("discovered")).alias("status"),
        c("pricing_summary"), c("eligibility_summary"), c("audience_type"), F.to_json(F.struct(*(c(x) for x in (*STRINGS, *LISTS)))).alias("raw_discovery_source"),
    )


def preference(file: str, line: str) -> list[Column]:
    """The order in which candidates of one id are better, ties by file and line. (WIN-01, R2)"""
    words = lambda name: compact(F.col(name))
    absent = lambda held: F.when(held, 0).otherwise(1)
    recent, overnight = words("recent_activity_evidence_snippet"), words("overnight_evidence_snippet")
    return [
        X.renamed(F.col("record_basis"), R.BASIS_RANK, F.lit(3)), F.lower(words("city")).isin(*R.NO_CITY).cast("int"), F.lower(words("venue_name")).isin(*R.NO_VENUE).cast("int"), absent(recent != ""), absent(overnight != ""),
        absent(words("operator_name") != ""), absent(words("activity_status_guess") == "active_recent"), F.coalesce(F.array_size("validation_needs"), F.lit(0)), -F.length(recent), -F.length(overnight),
        -F.coalesce(F.length(F.array_join("notes", " ")), F.lit(0)), F.col(file), F.col(line),
    ]


def best_candidates(rows: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """The best row of each id, with all files that have it as source_reports; rows without an id are left out. (PIP-05, WIN-01, AGG-10)"""
    known = rows.filter("coalesce(candidate_id, '') <> ''").withColumn("source_reports", F.col(file))
    return K.keep_best(known, ["candidate_id"], preference(file, line), "source_reports")


def candidate_conflicts(rows: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """Rows whose URL or name is not that of the best row before them, by file and line. (PIP-05, WIN-05)"""
    known = rows.filter("coalesce(candidate_id, '') <> ''")
    ranks = {f"_p{i}": p for i, p in enumerate(preference(file, line)[:-2])}
    narrow = materialise(known.select("candidate_id", file, line, "canonical_url", "name", *(p.alias(n) for n, p in ranks.items())), "conflict-rows")  # the ranges read it twice
    order = F.struct(F.col(file).alias("file"), F.col(line).alias("line"))
    return K.conflicts(narrow, ["candidate_id"], [*map(F.col, ranks), F.col(file), F.col(line)], order, ["canonical_url", "name"]).select("candidate_id", file, line, "canonical_url", "name")


def candidate_followups(candidates: DataFrame) -> DataFrame:
    """Up to nine review actions per candidate, with priority, reason and next step. (PIP-06, R9)"""
    shared = K.shared_values(candidates, U.canonical(F.col("canonical_url")), "candidate_id").withColumn("_shared", F.lit(True))
    rows = candidates.join(shared, "candidate_id", "left")
    needs = lambda n: F.array_contains(F.coalesce("validation_needs", F.array().cast("array<string>")), n)
    college = F.array_contains(F.coalesce("program_family", F.array().cast("array<string>")), "college-pre-college") | F.coalesce(F.col("priority_flags.college_precollege"), F.lit(False))
    when = {
        "split_multi_venue_candidate": F.col("record_basis") == "multi_venue_candidate", "confirm_exact_venue": needs("confirm_exact_venue"), "capture_pricing": needs("pricing"), "capture_contact": needs("contact"),
        "confirm_recent_activity": needs("confirm_recent_activity"), "confirm_overnight": needs("confirm_overnight"), "duplicate_review": F.col("_shared"), "priority_review_college_precollege": college,
        "priority_review_one_week_plus": F.col("priority_flags.one_week_plus"),
    }
    items = Q.followups(rows, "candidate_id", [(condition, action, *R.FOLLOWUP_TEXTS[action]) for action, condition in when.items()])
    return items.select(F.col("queue_id").alias("followup_id"), "candidate_id", "action", "priority", F.col("reason").alias("why"), "next_step", F.lit("queued").alias("status"))


def split_queue(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tasks, stubs) for candidates of many venues. (PIP-07)"""
    multi = candidates.filter("record_basis = 'multi_venue_candidate'").withColumn("split_task_id", slug(F.concat("candidate_id", F.lit("-split-task"))))
    tasks = multi.select("split_task_id", "candidate_id", "name", "operator_name", "canonical_url", F.lit("queued").alias("status"), F.lit(R.SPLIT_STEP).alias("next_step"))
    stubs = multi.select(
        "split_task_id", F.col("candidate_id").alias("parent_candidate_id"), F.lit("venue_candidate_pending_confirmation").alias("record_basis"), "name", "operator_name", F.lit("venue to be confirmed").alias("venue_name"),
        "city", "region", "country", "canonical_url", F.lit("split_stub").alias("status"), F.array(*map(F.lit, R.SPLIT_NOTES)).alias("notes"),
    )
    return tasks, stubs


def pending_queries(records: DataFrame, year: int, reasons: Sequence[str] = R.PENDING_REASONS, excluded: Sequence[str] = ("multi_venue_candidate",)) -> DataFrame:
    """Records that wait for one of ``reasons``, with the reasons that match and up to three search texts. (PIP-08, R11)"""
    name, city, region = (compact(F.col(n)) for n in ("name", "city", "region"))
    said = lambda v: F.when(~((v == "") | has_any(F.lower(v), R.PENDING_WORDS)), v)
    host = F.nullif(U.host(U.canonical(F.col("canonical_url"))), F.lit(""))
    site = F.concat(F.lit("site:"), F.col("host"))
    text = lambda last: compact(F.concat_ws(" ", site, F.concat(F.lit('"'), name, F.lit('"')), said(city), said(region), F.lit(last)))
    matched = F.filter("reasons", lambda r: r.isin(*reasons))
    kept = K.computed(records.withColumn("host", host).filter(~F.coalesce(F.col("record_basis").isin(*excluded), F.lit(False))).withColumn("matched_reasons", matched).filter(F.size("matched_reasons") > 0))
    queries = F.array_distinct(F.array(*(text(last) for last in ("location", "address", f"summer {year}"))))
    return kept.select("candidate_id", name.alias("name"), "city", "region", "country", "canonical_url", "host", F.coalesce("record_basis", F.lit("")).alias("record_basis"), "matched_reasons", queries.alias("queries"))


def query_index(pending: DataFrame) -> DataFrame:
    """Per search text the ids, names and hosts that ask for it, in order of id. (PIP-08, AGG-09)"""
    asked = materialise(pending.select("queries", "candidate_id", "name", "host"), "pending-queries")  # the count and each list read it
    rows = asked.select(F.explode("queries").alias("query"), "candidate_id", "name", "host")
    return Q.inverted(rows, "query", F.col("candidate_id"), candidate_ids=F.col("candidate_id"), candidate_names=F.col("name"), hosts=F.col("host"))


def reason_counts(pending: DataFrame) -> DataFrame:
    """(counter, key, n) of matched reasons and of record bases. (AGG-08)"""
    basis = given(F.col("record_basis"))
    pairs = F.concat(F.transform("matched_reasons", lambda r: F.struct(F.lit("reason").alias("counter"), r.alias("key"))), F.array(F.struct(F.lit("record_basis").alias("counter"), F.coalesce(basis, F.lit("unknown")).alias("key"))))
    return pending.select(F.inline(pairs)).groupBy("counter", "key").agg(F.count("*").alias("n"))


def region_plan(regions: DataFrame, templates: Sequence[tuple] = R.REGION_TEMPLATES) -> DataFrame:
    """(country, region_code, region_name, language_mode, angle, query): a region takes its own templates, else its country's. (PIP-02)

    ``regions`` has country, region_code and region_name; the templates are a small literal table.
    """
    mode, angles = F.lit(None).cast("string"), F.array().cast("array<string>")
    for country, code, language, texts in reversed(sorted(templates, key=lambda t: t[1] is None)):
        fits = (F.col("country") == country) & (F.lit(True) if code is None else F.col("region_code") == code)
        mode, angles = F.when(fits, F.lit(language)).otherwise(mode), F.when(fits, F.array(*map(F.lit, texts))).otherwise(angles)
    rows = regions.select("country", "region_code", "region_name", mode.alias("language_mode"), F.posexplode(angles).alias("angle", "_template"))
    return rows.withColumn("query", F.replace("_template", F.lit("{region}"), F.col("region_name"))).withColumn("angle", F.col("angle") + 1).drop("_template")


def unreported(specs: DataFrame, spec_col: str, reports: DataFrame, report_col: str) -> DataFrame:
    """Specs without a report; a report's name may end in -NN for its number. (JON-05)"""
    done = reports.select(F.regexp_replace(report_col, r"-\d{2}$", "").alias(spec_col)).distinct()
    return specs.join(done, spec_col, "left_anti")


def capture_selection(candidates: DataFrame, covered: DataFrame, tie: Column, deny: Sequence[str] = (), one_week: bool = False, limit: int | None = None, **filters: Sequence[str]) -> DataFrame:
    """Candidates to capture, with capture_url and capture_host: the first per URL in capture order, without denied hosts, without
    URLs in ``covered`` (source_url, resolved_url), narrowed by optional value lists per column. ``limit`` keeps the first of all. (PIP-09)"""
    url = U.canonical(F.col("canonical_url"))
    rows = K.computed(candidates.withColumn("capture_url", url)).withColumn("capture_host", U.host(F.col("capture_url")))
    rows = rows.filter((F.col("capture_url") != "") & U.allowed(F.col("capture_host"), (), deny))
    for name, allowed in filters.items():
        rows = C.matching(rows, name, allowed)
    if one_week:
        rows = rows.filter("priority_flags.one_week_plus")
    order = [*C.capture_order(F.col("activity_status_guess"), F.col("record_basis"), F.coalesce("priority_flags.one_week_plus", F.lit(False)), F.col("country"), F.col("region"), F.col("candidate_id")), tie]
    first = K.keep_best(K.uncovered(rows, F.col("capture_url"), covered, "source_url", "resolved_url"), ["capture_url"], order)
    return first if limit is None else first.orderBy(*order).limit(limit)


def skip_reasons(records: DataFrame) -> Column:
    """Why a record can't be rendered as a dossier, in rule order; empty if it can. (R17, ARR-05)"""
    low = lambda n: F.lower(compact(F.col(n)))
    basis = low("record_basis")
    return V.labels(
        (basis == "multi_venue_candidate", "multi_venue_candidate"), (basis == "venue_candidate_pending_confirmation", "pending_venue_confirmation"), (low("venue_name").isin(*R.NO_VENUE), "unknown_venue"),
        (low("city").isin(*R.NO_CITY), "unknown_city"), (low("name") == "", "missing_name"), (low("region") == "", "missing_region"),
    )


def resolution(ids: DataFrame, best: DataFrame) -> DataFrame:
    """Each asked id with its best row and status: not_found, the first reason against it, or resolved. (JON-08)"""
    found = best.withColumn("_reasons", skip_reasons(best)).withColumn("_there", F.lit(True))
    joined = ids.select("candidate_id").distinct().join(found, "candidate_id", "left")
    status = F.when(F.col("_there").isNull(), "not_found").otherwise(F.coalesce(F.get("_reasons", F.lit(0)), F.lit("resolved")))
    return joined.withColumn("resolution", status).drop("_reasons", "_there")


class Scan(NamedTuple):
    """What a folder of reports holds: the names of all files; the non-blank lines of .jsonl files (file, block, id, value; block
    and id order a file's lines); the rows of whole .json documents (file, id and their fields)."""

    files: DataFrame
    lines: DataFrame
    docs: DataFrame


def scan_reports(spark: SparkSession, folder: str, pattern: str = "*") -> Scan:
    """Reads a folder of reports. Files of lines are split wherever Spark splits them, so one may be of any size; a whole document
    is parsed element by element into rows, never held as text. A document that is no JSON, or holds something else
    than objects, gives no rows. Spark doesn't list files of no bytes. (SRC-05, SRC-08)"""
    name = F.col("_metadata.file_name").alias("file")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select(name)
    lines = spark.read.option("pathGlobFilter", pattern).text(folder).select(name, F.col("_metadata.file_block_start").alias("block"), "value")
    lines = lines.filter(F.endswith("file", F.lit(".jsonl")) & (F.trim("value") != "")).withColumn("id", F.monotonically_increasing_id())
    schema = f"scan_type string, scope string, candidates array<struct<{SCHEMA}>>, {SCHEMA}"
    try:
        docs = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.[jJ][sS][oO][nN]" if pattern == "*" else pattern).json(folder)
        docs = docs.select(name, "*").filter(F.endswith(F.lower("file"), F.lit(".json"))).withColumn("id", F.monotonically_increasing_id())
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        docs = spark.createDataFrame([], f"file string, {schema}, id long")
    return Scan(files, materialise(lines, "report-lines"), materialise(docs, "report-documents"))


def report_kinds(scan: Scan) -> DataFrame:
    """(file, kind) of every file: raw, candidates, array, batch or skip. (SRC-08, R10)

    A file of lines is judged by its name and the keys of its first row (one that is no JSON object is skipped), a document by its
    name and rows: one row with a list of candidates is a batch. An empty document or list is skipped.
    """
    name = F.col("file")
    ends = lambda suffixes: F.coalesce(*(F.when(F.endswith(name, F.lit(x)), True) for x in suffixes), F.lit(False))
    first = scan.lines.groupBy("file").agg(F.min_by("value", F.struct("block", "id")).alias("_first"))
    keys = F.json_object_keys("_first")
    any_of = lambda names: F.coalesce(F.arrays_overlap(keys, F.array(*map(F.lit, names))), F.lit(False))
    usable, has_id = ~ends(("_normalized.jsonl", *R.HELPER_SUFFIXES)) & keys.isNotNull(), any_of(["candidate_id"])
    kind = F.when(usable & ~has_id & ~any_of(R.HELPER_KEYS) & any_of(R.RAW_KEYS), "raw").when(usable & has_id & ~any_of(R.CANDIDATE_HELPER_KEYS) & any_of(R.CANDIDATE_KEYS), "candidates")
    whole = scan.docs.groupBy("file").agg(F.count("*").alias("_n"), F.count("candidates").alias("_lists"))
    of_whole = F.when(~ends(["_summary.json"]), F.when((F.col("_n") == 1) & (F.col("_lists") == 1), "batch").otherwise("array"))
    known = first.select("file", kind.alias("kind")).union(whole.select("file", of_whole.alias("kind")))
    return scan.files.join(known, "file", "left").select("file", F.coalesce("kind", F.lit("skip")).alias("kind"))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with line, 1, 2, 3 ... in each file: places inside a split plus the lines of the file's splits before it, of which there are few."""
    splits = lines.groupBy("file", "block").agg(F.min("id").alias("_least"), F.count("*").alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = splits.select("file", "block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least") + 1).alias("_shift"))
    return lines.join(shift, ["file", "block"]).withColumn("line", (F.col("id") + F.col("_shift")).cast("int")).drop("_shift")


def report_rows(scan: Scan, kinds: DataFrame) -> DataFrame:
    """Rows of the usable reports: file, line from 1, the fields of ``SCHEMA``, and of a batch its scan_type and report_scope. Blank lines don't count as rows. (SRC-05)"""
    fields, head = [f.name for f in scan.docs.select("candidates").schema[0].dataType.elementType], ("file", "line", "kind", "scan_type", "report_scope")
    none = F.lit(None).cast("string")
    lines = numbered_lines(scan.lines).join(kinds.filter(F.col("kind").isin("raw", "candidates")), "file")
    of_lines = lines.select("file", "line", "kind", none.alias("scan_type"), none.alias("report_scope"), F.from_json("value", SCHEMA).alias("_c"))
    docs = scan.docs.join(kinds.filter(F.col("kind").isin("array", "batch")), "file")
    arrays = numbered_lines(docs.filter("kind = 'array'").withColumn("block", F.lit(0).cast("long"))).select("file", "line", "kind", none.alias("scan_type"), none.alias("report_scope"), F.struct(*fields).alias("_c"))
    batches = docs.filter("kind = 'batch'").select("file", "kind", "scan_type", F.col("scope").alias("report_scope"), F.posexplode("candidates").alias("line", "_c"))
    batches = batches.select("file", (F.col("line") + 1).alias("line"), "kind", "scan_type", "report_scope", "_c")
    return of_lines.union(arrays).union(batches).select(*head, "_c.*")


def normalised_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the reports that are normalised already, with file and line. (SRC-09)"""
    scan = scan_reports(spark, folder, "*_normalized.jsonl")
    return report_rows(scan, scan.files.select("file", F.lit("candidates").alias("kind")))


def ingest(rows: DataFrame, year: int) -> dict[str, DataFrame]:
    """Tables of a run over report rows (``report_rows``): candidates, conflicts, followups, split_tasks, split_stubs and summary. (PIP-05, SNK-06)"""
    normal = materialise(normalised(rows, year), "candidates")
    best, clashes = materialise(best_candidates(normal), "best-candidates"), candidate_conflicts(normal)
    followups, (tasks, stubs) = candidate_followups(best), split_queue(best)
    counts = {"aggregate_candidates": best, "aggregate_followups": followups, "aggregate_split_tasks": tasks, "duplicate_candidate_ids": clashes}
    parts = rows.groupBy("file").agg(F.count("*").alias("n")).select(F.lit("report").alias("kind"), F.col("file").alias("name"), "n")
    for name, df in counts.items():
        parts = parts.union(df.agg(F.lit("count"), F.lit(name), F.count("*")))
    held = lambda kind, entry: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, entry)))  # noqa: E731  a row per count and report file
    summary = parts.agg(F.to_json(F.struct(
        F.map_from_entries(held("count", F.struct("name", "n"))).alias("counts"), held("report", F.struct(F.col("name").alias("file"), F.col("n").alias("records"))).alias("reports_ingested")
    )).alias("summary"))
    return {"candidates": best, "conflicts": clashes, "followups": followups, "split_tasks": tasks, "split_stubs": stubs, "summary": summary}
