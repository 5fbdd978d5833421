"""Queries of the candidate pipeline, over leads that Spark and SQL derive from customers the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake import rules as R
from leadlake.functions import extract as X
from leadlake.operators import candidates as N
from leadlake.plans.queries import SLUG_SQL
from leadlake.plans.registry import query
from leadlake.scratch import fresh_path, materialise
from leadlake.sources import files

YEAR = 2024
VENUES = (None, "Various campuses", "Hall to be confirmed", "unknown", "Main Hall", "North Lodge", "Multi-site")
TEXTS = (" overnight", " residential stay on campus", " apply now", " two week session", " 3-week band camp", "")


def leads(t) -> DataFrame:
    """One lead per customer, with gaps, placeholders and phrases that follow from its key and columns."""
    k = F.col("c_custkey").cast("int")
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (k % n + 1).cast("int"))
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    url = F.concat(F.lit("HTTP://www.Host"), F.col("n_nationkey").cast("string"), F.lit(".example.com/p/"), (k % 50).cast("string"), F.lit("/?utm_source=x&b=2&a=1"))
    return rows.select(
        F.col("c_custkey").alias("key"), F.when(k % 11 != 0, F.col("c_name")).alias("candidate_name"), F.concat(F.lit("Lead "), k.cast("string")).alias("title"),
        F.when(k % 3 == 1, "Sample College").when(k % 3 == 2, F.col("c_mktsegment")).alias("operator_name"), pick(VENUES, 7).alias("venue_name"),
        F.when(k % 5 == 1, "").when(k % 5 > 1, F.concat(F.lit("Town "), F.col("n_nationkey").cast("string"))).alias("city"), F.col("n_name").alias("region"), F.when(k % 4 != 0, "CA").alias("country"),
        F.when(k % 6 != 0, url).alias("canonical_url"), F.concat(F.lower("c_mktsegment"), pick(TEXTS, 6)).alias("snippet"), F.when(k % 4 == 1, "dates 2024").alias("recent_activity_evidence_snippet"),
        F.when(k % 9 == 0, "sites  pending").alias("uncertainty"), F.when(k % 8 == 0, F.array(F.lit("STEM"), F.lit("overnight"), F.lit("2-week"))).alias("provisional_program_family_tags"),
        F.when(k % 10 == 3, F.array(F.lit("pricing"), F.lit("contact"), F.lit("pricing"))).alias("validation_needs"), F.when(k % 3 == 1, "a@b.org").alias("contact_email"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_acctbal").cast("string")).alias("price"), F.when(k % 7 == 2, "ages 8-12").alias("ages"),
        F.when(k % 13 == 5, "venue_unconfirmed").alias("candidate_shape"),
    )


def words_sql(text: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in phrases) + ")"


def tags_sql(text: str, pack: R.TagRules) -> str:
    return "[" + ", ".join(f"CASE WHEN contains({text}, '{n}') THEN '{tag}' END" for n, tag in pack.pairs) + f", CASE WHEN NOT {words_sql(text, [n for n, _ in pack.pairs])} THEN '{pack.default}' END]"


LEADS_SQL = """
WITH leads AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS candidate_name, 'Lead ' || c_custkey AS title,
  CASE c_custkey % 3 WHEN 1 THEN 'Sample College' WHEN 2 THEN c_mktsegment END AS operator_name, [NULL, 'Various campuses', 'Hall to be confirmed', 'unknown', 'Main Hall', 'North Lodge', 'Multi-site'][1 + (c_custkey % 7)::INT] AS venue_name,
  CASE WHEN c_custkey % 5 = 1 THEN '' WHEN c_custkey % 5 > 1 THEN 'Town ' || n_nationkey END AS city, n_name AS region, CASE WHEN c_custkey % 4 <> 0 THEN 'CA' END AS country,
  CASE WHEN c_custkey % 6 <> 0 THEN 'http://host' || n_nationkey || '.example.com/p/' || (c_custkey % 50) || '?a=1&b=2' END AS url,
  lower(c_mktsegment) || [' overnight', ' residential stay on campus', ' apply now', ' two week session', ' 3-week band camp', ''][1 + (c_custkey % 6)::INT] AS snippet, CASE WHEN c_custkey % 4 = 1 THEN 'dates 2024' END AS recent,
  CASE WHEN c_custkey % 9 = 0 THEN 'sites pending' END AS uncertainty, c_custkey % 8 = 0 AS tagged, c_custkey % 10 = 3 AS needy, c_custkey % 3 = 1 AS has_contact, c_acctbal > 5000 AS has_price, c_custkey % 7 = 2 AS has_age, c_custkey % 13 = 5 AS shaped
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
x AS (SELECT *, lower(trim(regexp_replace(concat_ws(' ', candidate_name, title, snippet, recent, venue_name, operator_name, uncertainty), '\\s+', ' ', 'g'))) AS txt FROM leads),
""" + f"""
y AS (SELECT *, coalesce(candidate_name, title) AS name, coalesce(country, 'US') AS land,
  CASE WHEN shaped THEN 'venue_candidate_pending_confirmation' WHEN {words_sql("lower(concat_ws(' ', coalesce(venue_name, ''), uncertainty))", R.MULTI_VENUE_PHRASES)} THEN 'multi_venue_candidate'
    WHEN {words_sql("lower(concat_ws(' ', coalesce(venue_name, ''), uncertainty))", R.PENDING_PHRASES)} OR lower(coalesce(venue_name, '')) IN ('', 'venue to be confirmed', 'unknown') OR coalesce(city, '') = '' THEN 'venue_candidate_pending_confirmation' ELSE 'venue_candidate' END AS record_basis,
  list_sort(list_distinct(list_filter(list_concat(CASE WHEN tagged THEN ['stem'] ELSE [] END, {tags_sql('txt', R.FAMILIES)}), lambda v: v IS NOT NULL))) AS fams,
  list_sort(list_distinct(list_filter(list_concat(CASE WHEN tagged THEN ['overnight'] ELSE [] END, {tags_sql('txt', R.CAMP_TYPES)}), lambda v: v IS NOT NULL))) AS kinds,
  CASE WHEN contains(txt, '2024') OR contains(txt, '2023') OR contains(txt, '2022') OR {words_sql('txt', R.ENROL_PHRASES)} THEN 'active_recent' ELSE 'unknown' END AS activity,
  CASE WHEN tagged THEN '2-week' WHEN contains(txt, '3-week') THEN '3-week' WHEN contains(txt, 'two week') THEN 'two-week' ELSE 'unknown' END AS label FROM x),
z AS (SELECT *, CASE WHEN len(fams) > 1 THEN list_filter(fams, lambda v: v <> 'unspecified') ELSE fams END AS families, CASE WHEN len(kinds) > 1 THEN list_filter(kinds, lambda v: v <> 'unknown') ELSE kinds END AS types,
  CASE label WHEN '2-week' THEN 14 WHEN '3-week' THEN 21 WHEN 'two-week' THEN 14 END AS days,
  {SLUG_SQL.format("coalesce(nullif(venue_name, ''), CASE WHEN record_basis = 'multi_venue_candidate' THEN 'multi site' ELSE 'pending venue' END)")} AS venue_slug,
  {SLUG_SQL.format("coalesce(nullif(city, ''), CASE WHEN record_basis = 'multi_venue_candidate' THEN 'multi site' ELSE 'unknown city' END)")} AS city_slug FROM y),
n AS (SELECT *, {SLUG_SQL.format("concat_ws('-', 'cand', land, region, city_slug, name, venue_slug, CASE WHEN venue_slug IN ('pending-venue', 'unknown') THEN regexp_extract(url, '^http://([^/]*)', 1) END)")} AS candidate_id,
  list_sort(list_distinct(CASE WHEN needy THEN ['pricing', 'contact'] ELSE list_filter([CASE WHEN record_basis = 'multi_venue_candidate' THEN 'split_into_venue_records' END, CASE WHEN record_basis = 'venue_candidate_pending_confirmation' THEN 'confirm_exact_venue' END,
    CASE WHEN types = ['unknown'] THEN 'confirm_overnight' END, CASE WHEN activity <> 'active_recent' OR recent IS NULL THEN 'confirm_recent_activity' END, CASE WHEN label = 'unknown' THEN 'confirm_duration' END,
    CASE WHEN NOT has_price THEN 'pricing' END, CASE WHEN NOT has_contact THEN 'contact' END, CASE WHEN NOT has_age THEN 'ages_or_grades' END], lambda v: v IS NOT NULL) END)) AS needs,
  list_contains(families, 'college-pre-college') AS college, coalesce(days, 0) >= 7 AS week_plus, coalesce(venue_name, 'venue to be confirmed') AS venue FROM z)
"""


def joined(name: str):
    return F.array_join(F.array_sort(name), ",")


@query(LEADS_SQL + """SELECT key, candidate_id, record_basis, name, venue, city, region, land AS country, url AS canonical_url, array_to_string(families, ',') AS families, array_to_string(types, ',') AS types, activity, label, days AS min_days,
 array_to_string(needs, ',') AS needs, college, week_plus, uncertainty AS notes FROM n""")
def candidate_normalise(t):
    """(PIP-04, TXT-04, MAP-02, R4 to R8)"""
    rows = N.normalised(leads(t), YEAR)
    return rows.select(
        "key", "candidate_id", "record_basis", "name", F.col("venue_name").alias("venue"), "city", "region", "country", "canonical_url", joined("program_family").alias("families"), joined("camp_types").alias("types"),
        F.col("activity_status_guess").alias("activity"), F.col("duration_guess.label").alias("label"), F.col("duration_guess.min_days").alias("min_days"), F.array_join("validation_needs", ",").alias("needs"),
        F.col("priority_flags.college_precollege").alias("college"), F.col("priority_flags.one_week_plus").alias("week_plus"), F.nullif(F.array_join("notes", " "), F.lit("")).alias("notes"),
    )


def reports(t) -> DataFrame:
    """Leads as rows of two reports: ids repeat, because fifty customers each share one."""
    k = F.col("key")
    rows = leads(t).withColumn("candidate_id", F.concat(F.lit("c-"), (k % 97).cast("int").cast("string")))
    return rows.withColumn("file", F.when(k % 2 == 0, "a.jsonl").otherwise("b.jsonl")).withColumn("line", k)


BEST_SQL = LEADS_SQL + """, r AS (SELECT *, 'c-' || (key % 97) AS cid, CASE WHEN key % 2 = 0 THEN 'a.jsonl' ELSE 'b.jsonl' END AS file FROM n),
p AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY CASE record_basis WHEN 'venue_candidate' THEN 0 WHEN 'venue_candidate_pending_confirmation' THEN 1 ELSE 2 END, (coalesce(city, '') = '')::INT, (lower(venue) IN ('unknown', 'venue to be confirmed'))::INT,
  (recent IS NULL)::INT, (coalesce(operator_name, '') = '')::INT, (activity <> 'active_recent')::INT, len(needs), -length(coalesce(recent, '')), -length(snippet), -length(coalesce(uncertainty, '')), file, key) AS rn FROM r),
b AS (SELECT *, (SELECT string_agg(DISTINCT q.file, ',' ORDER BY q.file) FROM r q WHERE q.cid = p.cid) AS files FROM p WHERE rn = 1)
"""


@query(BEST_SQL + "SELECT cid AS candidate_id, key, name, record_basis, files FROM b")
def report_best(t):
    """The best row of each candidate over all reports. (PIP-05, WIN-01, AGG-10, R2)"""
    best = N.best_candidates(N.normalised(reports(t), YEAR))
    return best.select("candidate_id", "key", "name", "record_basis", F.array_join("source_reports", ",").alias("files"))


@query(BEST_SQL + f""", s AS (SELECT url FROM b WHERE url IS NOT NULL GROUP BY url HAVING count(*) > 1)
SELECT cid AS candidate_id, x.action, lower(cid || '-' || replace(x.action, '_', '-')) AS followup_id, x.priority FROM b, (VALUES {', '.join(f"('{a}', '{v[0]}')" for a, v in R.FOLLOWUP_TEXTS.items())}) AS x(action, priority)
WHERE CASE x.action WHEN 'split_multi_venue_candidate' THEN record_basis = 'multi_venue_candidate' WHEN 'confirm_exact_venue' THEN list_contains(needs, 'confirm_exact_venue') WHEN 'capture_pricing' THEN list_contains(needs, 'pricing')
 WHEN 'capture_contact' THEN list_contains(needs, 'contact') WHEN 'confirm_recent_activity' THEN list_contains(needs, 'confirm_recent_activity') WHEN 'confirm_overnight' THEN list_contains(needs, 'confirm_overnight')
 WHEN 'duplicate_review' THEN url IN (SELECT url FROM s) WHEN 'priority_review_college_precollege' THEN college WHEN 'priority_review_one_week_plus' THEN week_plus END""")
def report_followups(t):
    """(PIP-06, R9)"""
    return N.candidate_followups(N.best_candidates(N.normalised(reports(t), YEAR))).select("candidate_id", "action", "followup_id", "priority")


@query(BEST_SQL.replace("key % 97", "key % 91") + "SELECT 'task' AS kind, lower(cid || '-split-task') AS split_task_id, cid AS candidate_id, name, 'queued' AS status FROM b WHERE record_basis = 'multi_venue_candidate' UNION ALL SELECT 'stub', lower(cid || '-split-task'), cid, name, 'split_stub' FROM b WHERE record_basis = 'multi_venue_candidate'")
def report_splits(t):
    """All leads of an id have one kind of venue and shape here, so some ids have many venues in every report. (PIP-07)"""
    rows = reports(t).withColumn("candidate_id", F.concat(F.lit("c-"), (F.col("key") % 91).cast("int").cast("string")))
    tasks, stubs = N.split_queue(N.best_candidates(N.normalised(rows, YEAR)))
    both = tasks.select(F.lit("task").alias("kind"), "split_task_id", "candidate_id", "name", "status")
    return both.union(stubs.select(F.lit("stub"), "split_task_id", "parent_candidate_id", "name", "status"))


@query(BEST_SQL + """, prior AS (SELECT r.cid, r.key, r.file, r.url, r.name, arg_min({'u': q.url, 'n': q.name}, q.rn) AS best FROM r JOIN p q ON q.cid = r.cid AND (q.file, q.key) < (r.file, r.key) GROUP BY ALL)
SELECT cid AS candidate_id, file, key AS line, url AS canonical_url, name FROM prior WHERE url IS DISTINCT FROM best.u OR name IS DISTINCT FROM best.n""")
def report_conflicts(t):
    """(PIP-05, WIN-05)"""
    return N.candidate_conflicts(N.normalised(reports(t), YEAR))


@query(BEST_SQL + f""", c AS (SELECT (SELECT count(*) FROM b) AS candidates, (SELECT count(*) FROM b WHERE record_basis = 'multi_venue_candidate') AS tasks) SELECT candidates, tasks, (SELECT count(DISTINCT file) FROM r)::BIGINT AS reports FROM c""")
def report_summary(t):
    """The run summary as read back from its JSON. (SNK-06)"""
    text = N.ingest(reports(t), YEAR)["summary"].select(F.from_json("summary", "counts map<string,bigint>, reports_ingested array<struct<file: string, records: bigint>>").alias("s"))
    return text.select(F.col("s.counts.aggregate_candidates").alias("candidates"), F.col("s.counts.aggregate_split_tasks").alias("tasks"), F.size("s.reports_ingested").cast("long").alias("reports"))


REPORT_FILES = ("a.jsonl", "b.jsonl", "c.json", "d.json")


def report_folder(t) -> str:
    """Leads written as four reports: raw rows, candidates, a list, a batch; and files that are none."""
    rows = leads(t)
    spark, k = rows.sparkSession, F.col("key")
    folder = fresh_path(spark, "reports")
    body = F.to_json(F.struct(F.when(k % 4 != 0, F.concat(F.lit("c-"), (k % 97).cast("string"))).alias("candidate_id"), *(c for c in rows.columns if c != "key")))
    texts = materialise(rows.select(k, body.alias("value")), "report-texts")
    ends = {2: ("[", "]"), 3: ('{"scan_type":"weekly","scope":"all","candidates":[', "]}")}
    for i, name in enumerate(REPORT_FILES):
        part = texts.filter(k % 4 == i)
        if i in ends:
            least = part.agg(F.min("key")).first()[0]
            part = part.withColumn("value", F.concat(F.when(k == least, "").otherwise(","), "value"))
            head, tail = ends[i]
            part = part.union(spark.createDataFrame([(-1, head), (1 << 62, tail)], part.schema))
        files.write_text_file(part.orderBy("key"), f"{folder}/{name}")
    lone = lambda text: spark.createDataFrame([(text,)], "value string")
    for name, text in (("e_summary.json", "[]"), ("f.json", "no json"), ("g.json", "[1, 2]"), ("h.jsonl", '{"candidate_id": "x", "matched_reason": "r", "name": "n"}'), ("i.jsonl", "no json")):
        files.write_text_file(lone(text), f"{folder}/{name}")
    return folder


@query(BEST_SQL.split("p AS (SELECT")[0].rstrip(", \n") + """ SELECT ['a.jsonl', 'b.jsonl', 'c.json', 'd.json'][1 + (key % 4)::INT] AS file, ['raw', 'candidates', 'array', 'batch'][1 + (key % 4)::INT] AS kind, count(*)::BIGINT AS n, max(line)::INT AS lines, max(CASE WHEN key % 4 = 3 THEN 'weekly' END) AS scan_type
FROM (SELECT *, row_number() OVER (PARTITION BY key % 4 ORDER BY key) AS line FROM r) GROUP BY key % 4 UNION ALL SELECT f, 'skip', 0, NULL, NULL FROM (VALUES ('e_summary.json'), ('f.json'), ('g.json'), ('h.jsonl'), ('i.jsonl')) v(f)""")
def report_files(t):
    """Reports as written, judged and read. (SRC-05, SRC-08)"""
    scan = N.scan_reports(t("customer").sparkSession, report_folder(t))
    kinds = materialise(N.report_kinds(scan), "report-kinds")
    counts = N.report_rows(scan, kinds).groupBy("file").agg(F.count("*").alias("n"), F.max("line").alias("lines"), F.max("scan_type").alias("scan_type"))
    return kinds.join(counts, "file", "left").select("file", "kind", F.coalesce("n", F.lit(0)).alias("n"), "lines", "scan_type")


FILES_SQL = BEST_SQL.replace("'c-' || (key % 97) AS cid, CASE WHEN key % 2 = 0 THEN 'a.jsonl' ELSE 'b.jsonl' END AS file", "CASE WHEN key % 4 = 0 THEN candidate_id ELSE 'c-' || (key % 97) END AS cid, ['a.jsonl', 'b.jsonl', 'c.json', 'd.json'][1 + (key % 4)::INT] AS file")


@query(FILES_SQL + "SELECT cid AS candidate_id, name, record_basis, city, url AS canonical_url, files FROM b")
def report_ingest(t):
    """The best row of each candidate over reports read from files. (PIP-05, SRC-05, SRC-08, WIN-01)"""
    scan = N.scan_reports(t("customer").sparkSession, report_folder(t))
    out = N.ingest(N.report_rows(scan, N.report_kinds(scan)), YEAR)
    return out["candidates"].select("candidate_id", "name", "record_basis", "city", "canonical_url", F.array_join("source_reports", ",").alias("files"))


PENDING_SQL = LEADS_SQL + """, w AS (SELECT *, list_filter([CASE WHEN record_basis = 'venue_candidate_pending_confirmation' THEN 'pending_venue_confirmation' END, CASE WHEN lower(venue) IN ('unknown', 'venue to be confirmed') THEN 'unknown_venue' END, CASE WHEN coalesce(city, '') = '' THEN 'unknown_city' END], lambda v: v IS NOT NULL) AS reasons FROM n WHERE record_basis <> 'multi_venue_candidate'),
q AS (SELECT key, name, regexp_extract(url, '^http://([^/]*)', 1) AS host, record_basis, reasons, list_transform(['location', 'address', 'summer 2024'], lambda v: concat_ws(' ', 'site:' || nullif(regexp_extract(url, '^http://([^/]*)', 1), ''), '"' || name || '"', nullif(city, ''), region, v)) AS queries FROM w WHERE len(reasons) > 0)
"""


def pending(t) -> DataFrame:
    rows = N.normalised(leads(t), YEAR).withColumn("candidate_id", F.lpad(F.col("key").cast("string"), 9, "0"))
    return N.pending_queries(rows.withColumn("reasons", N.skip_reasons(rows)), YEAR)


@query(PENDING_SQL + "SELECT lpad(key::VARCHAR, 9, '0') AS candidate_id, nullif(host, '') AS host, array_to_string(list_sort(reasons), ',') AS reasons, array_to_string(queries, '|') AS queries FROM q")
def pending_queries(t):
    """(PIP-08, R11, ARR-05, R17)"""
    return pending(t).select("candidate_id", "host", F.array_join(F.array_sort("matched_reasons"), ",").alias("reasons"), F.array_join("queries", "|").alias("queries"))


@query(PENDING_SQL + ", e AS (SELECT unnest(queries) AS query, key, name, nullif(host, '') AS host FROM q) SELECT query, string_agg(lpad(key::VARCHAR, 9, '0'), ',' ORDER BY key) AS ids, string_agg(DISTINCT host, ',') AS hosts, count(*)::BIGINT AS n FROM e GROUP BY query")
def pending_index(t):
    """(PIP-08, AGG-09)"""
    return N.query_index(pending(t)).select("query", F.array_join("candidate_ids", ",").alias("ids"), F.nullif(F.array_join("hosts", ","), F.lit("")).alias("hosts"), "n")


@query(PENDING_SQL + "SELECT 'reason' AS counter, key, count(*)::BIGINT AS n FROM (SELECT unnest(reasons) AS key FROM q) GROUP BY 2 UNION ALL SELECT 'record_basis', record_basis, count(*) FROM q GROUP BY 2")
def pending_counts(t):
    """(AGG-08)"""
    return N.reason_counts(pending(t))


REGION_SQL = " UNION ALL ".join(
    f"SELECT s_suppkey, {k} AS angle, replace('{q}', '{{region}}', s_name) AS query, '{mode}' AS language_mode FROM s WHERE country = '{country}' AND {f'code = {chr(39)}{code}{chr(39)}' if code else 'NOT (country = ' + chr(39) + 'CA' + chr(39) + ' AND code IN (' + chr(39) + 'QC' + chr(39) + ', ' + chr(39) + 'NB' + chr(39) + '))'}"
    for country, code, mode, queries in R.REGION_TEMPLATES
    for k, q in enumerate(queries, 1)
)


@query("WITH s AS (SELECT s_suppkey, s_name, ['US', 'CA', 'MX'][1 + s_nationkey % 3] AS country, ['QC', 'NB', 'ON', 'XX'][1 + (s_suppkey % 4)::INT] AS code FROM supplier) " + REGION_SQL)
def region_plan(t):
    """Suppliers as regions of three countries. (PIP-02)"""
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), n.cast("int") + 1)
    regions = t("supplier").select("s_suppkey", pick(("US", "CA", "MX"), F.col("s_nationkey") % 3).alias("country"), pick(("QC", "NB", "ON", "XX"), F.col("s_suppkey") % 4).alias("region_code"), F.col("s_name").alias("region_name"))
    plan = N.region_plan(regions)
    return plan.join(regions.select("s_suppkey", "region_name"), "region_name").select("s_suppkey", "angle", "query", "language_mode")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def unreported(t):
    """Orders as specs, returned lines as numbered reports. (JON-05)"""
    specs = t("orders").select("o_orderkey", F.concat(F.lit("spec-"), F.col("o_orderkey").cast("string")).alias("spec"))
    done = t("lineitem").filter("l_returnflag = 'R'").select(F.concat(F.lit("spec-"), F.col("l_orderkey").cast("string"), F.lit("-0"), F.col("l_linenumber").cast("string")).alias("report"))
    return N.unreported(specs, "spec", done, "report").select("o_orderkey")


@query(BEST_SQL + """, a AS (SELECT DISTINCT 'c-' || (o_custkey % 120) AS cid FROM orders)
SELECT a.cid AS candidate_id, CASE WHEN b.cid IS NULL THEN 'not_found' WHEN record_basis = 'multi_venue_candidate' THEN 'multi_venue_candidate' WHEN record_basis = 'venue_candidate_pending_confirmation' THEN 'pending_venue_confirmation'
 WHEN lower(venue) IN ('unknown', 'venue to be confirmed') THEN 'unknown_venue' WHEN coalesce(city, '') = '' THEN 'unknown_city' ELSE 'resolved' END AS resolution FROM a LEFT JOIN b ON a.cid = b.cid""")
def resolution(t):
    """Asked ids against the best rows. (JON-08, R17)"""
    asked = t("orders").select(F.concat(F.lit("c-"), (F.col("o_custkey") % 120).cast("string")).alias("candidate_id"))
    return N.resolution(asked, N.best_candidates(N.normalised(reports(t), YEAR))).select("candidate_id", "resolution")


CAPTURE_SQL = LEADS_SQL + """, f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY (activity <> 'active_recent')::INT, CASE record_basis WHEN 'venue_candidate' THEN 0 WHEN 'venue_candidate_pending_confirmation' THEN 1 ELSE 2 END, (NOT week_plus)::INT, land, region, candidate_id, key) AS rn FROM n
 WHERE url IS NOT NULL AND NOT contains(url, '//host7.') AND record_basis <> 'multi_venue_candidate' AND url NOT IN (SELECT 'http://host' || s_nationkey || '.example.com/p/' || (s_suppkey % 50) || '?a=1&b=2' FROM supplier))
SELECT url AS capture_url, key FROM f WHERE rn = 1"""


@query(CAPTURE_SQL)
def capture_selection(t):
    """Leads to capture, the first per URL, without denied hosts and URLs that suppliers cover. (PIP-09, SRT-04, FLT-05, FLT-06, JON-03)"""
    rows = N.normalised(leads(t), YEAR)
    covered = t("supplier").select(F.concat(F.lit("http://host"), F.col("s_nationkey").cast("string"), F.lit(".example.com/p/"), (F.col("s_suppkey") % 50).cast("string"), F.lit("?a=1&b=2")).alias("source_url"), F.lit(None).cast("string").alias("resolved_url"))
    return N.capture_selection(rows, covered, F.col("key"), deny=["host7.example.com"], record_basis=["venue_candidate", "Venue_Candidate_Pending_Confirmation"]).select("capture_url", "key")


@query("SELECT o_orderkey, CASE WHEN need OR multi THEN 'low' WHEN a AND b AND n <= 1 THEN 'high' WHEN a OR b THEN 'medium' ELSE 'low' END AS confidence FROM (SELECT o_orderkey, o_orderstatus = 'P' AS need, o_custkey % 4 = 0 AS multi, o_totalprice > 100000 AS a, o_orderpriority LIKE '1%' AS b, (o_orderstatus = 'P')::INT + (o_custkey % 3)::INT AS n FROM orders)")
def confidence_rollup(t):
    """(TXT-24)"""
    needs = F.concat(F.when(F.col("o_orderstatus") == "P", F.array(F.lit("confirm_exact_venue"))).otherwise(F.array().cast("array<string>")), F.array_repeat(F.lit("pricing"), (F.col("o_custkey") % 3).cast("int")))
    basis = F.when(F.col("o_custkey") % 4 == 0, "multi_venue_candidate").otherwise("venue_candidate")
    return t("orders").select("o_orderkey", X.confidence(needs, basis, F.col("o_totalprice") > 100000, F.startswith("o_orderpriority", F.lit("1"))).alias("confidence"))


WORD_SQL = "lower(p_name || ' ' || p_type || ' ' || ['camp', 'college', 'ymca', 'church', 'lead directory', 'dorms'][1 + p_size % 6])"


@query(f"""SELECT p_partkey, CASE WHEN {words_sql('w', R.OPERATOR_TYPES[0][1])} THEN 'university' WHEN contains(w, 'ymca') THEN 'ymca' WHEN {words_sql('w', R.OPERATOR_TYPES[2][1])} THEN 'faith-based' WHEN contains(w, 'camp') THEN 'camp-operator' ELSE 'organization' END AS operator_type,
 {words_sql('w', R.META_PHRASES)} AS meta, p_retailprice > 1500 OR p_type = 'PROMO' OR {words_sql('w', R.RESIDENTIAL_PHRASES)} AS in_scope, '' AS signals FROM (SELECT *, {WORD_SQL} AS w FROM part)""")
def scope_signals(t):
    """(TXT-18, TXT-21, TXT-25, ARR-06)"""
    words = F.element_at(F.array(*map(F.lit, ("camp", "college", "ymca", "church", "lead directory", "dorms"))), (F.col("p_size") % 6 + 1).cast("int"))
    text = F.concat_ws(" ", "p_name", "p_type", words)
    types = F.when(F.col("p_type") == "PROMO", F.array(F.lit("residential"))).otherwise(F.array(F.lit("day")))
    return t("part").select(
        "p_partkey", X.operator_type(words, F.concat_ws(" ", "p_name", "p_type")).alias("operator_type"), X.meta_record(text).alias("meta"),
        X.in_scope(F.col("p_retailprice") > 1500, F.array(F.lit("arts")), types, text).alias("in_scope"), F.array_join(X.overnight_signals(text), ",").alias("signals"),
    )


@query("""WITH d AS (SELECT doc_id, lower(text) AS x FROM documents) SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(x || ' ' || CASE WHEN doc_id % 3 = 0 THEN 'Cabins, Lodge' WHEN doc_id % 3 = 1 THEN 'campers  stay; BUNK dormant' ELSE '' END, '(?i)\\b(?:overnight|sleepaway|residential|cabin|cabins|dormitory|dorm|bunk|bunks|lodge|lodging|sleep-away|boarding|campers\\s+stay)\\b'), lambda v: lower(v)))), ',') AS signals FROM d""")
def overnight_words(t):
    """(TXT-18)"""
    key = F.col("doc_id") % 3
    extra = F.when(key == 0, "Cabins, Lodge").when(key == 1, "campers  stay; BUNK dormant").otherwise("")
    return t("documents").select("doc_id", F.array_join(X.overnight_signals(F.concat_ws(" ", "text", extra)), ",").alias("signals"))
