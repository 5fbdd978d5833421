"""Queries of catalog views: work sets, queues, details, samples, duplicate review, gap report, sinks read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake import rules as R
from leadlake.functions import values as V
from leadlake.operators import candidates as N
from leadlake.operators import catalog as C
from leadlake.operators import keyed as K
from leadlake.operators import queues as Q
from leadlake.plans.registry import query
from leadlake.sources import files as S
from leadlake.sources.catalog import Catalog
from leadlake.scratch import fresh_path, materialise

CATALOG_SQL = """WITH camps AS (SELECT c_custkey AS record_id, c_name AS name, n_name AS region, ['US', 'CA', 'MX'][1 + n_regionkey % 3] AS country, c_mktsegment AS family, CASE WHEN c_custkey % 3 <> 0 THEN 'https://e.org/' || c_custkey WHEN c_custkey % 9 = 0 THEN '' END AS website_url,
 CASE c_custkey % 4 WHEN 0 THEN 'likely_camp' WHEN 1 THEN 'likely_not_a_camp' WHEN 2 THEN 'unclear' END AS triage_verdict, CASE WHEN c_acctbal < 0 THEN true WHEN c_custkey % 2 = 0 THEN false END AS is_excluded, CASE WHEN c_custkey % 5 < 3 THEN c_acctbal END AS pricing_min, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 100 END AS pricing_max,
 c_custkey % 20 AS ages_min, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey % 20 + 4 END AS ages_max, CASE WHEN c_custkey % 8 < 3 THEN c_custkey % 8 = 0 END AS overnight_confirmed, CASE c_custkey % 7 WHEN 0 THEN 'multi_venue' WHEN 1 THEN 'candidate_pending' ELSE 'candidate' END AS draft_status
 FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


def camps(t):
    """A catalog made from customers."""
    k = F.col("c_custkey")
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        k.alias("record_id"), F.col("c_name").alias("name"), F.col("n_name").alias("region"), F.element_at(F.array(F.lit("US"), F.lit("CA"), F.lit("MX")), F.col("n_regionkey") % 3 + 1).alias("country"), F.col("c_mktsegment").alias("family"),
        F.when(k % 3 != 0, F.concat(F.lit("https://e.org/"), k.cast("string"))).when(k % 9 == 0, "").alias("website_url"), F.when(k % 4 == 0, "likely_camp").when(k % 4 == 1, "likely_not_a_camp").when(k % 4 == 2, "unclear").alias("triage_verdict"),
        F.when(F.col("c_acctbal") < 0, True).when(k % 2 == 0, False).alias("is_excluded"), F.when(k % 5 < 3, F.col("c_acctbal")).alias("pricing_min"), F.when(k % 5 == 0, F.col("c_acctbal") + 100).alias("pricing_max"), (k % 20).alias("ages_min"),
        F.when(k % 6 != 0, k % 20 + 4).alias("ages_max"), F.when(k % 8 < 3, k % 8 == 0).alias("overnight_confirmed"), F.when(k % 7 == 0, "multi_venue").when(k % 7 == 1, "candidate_pending").otherwise("candidate").alias("draft_status"),
    )


@query(CATALOG_SQL + "SELECT record_id, name FROM camps WHERE coalesce(NOT is_excluded, true) AND draft_status IN ('candidate', 'candidate_pending') AND country IN ('US', 'CA') AND contains(lower(family), 'u') AND (ages_max IS NULL OR ages_max >= 8) AND (ages_min IS NULL OR ages_min <= 12) AND (pricing_min IS NULL OR pricing_min <= 6000) AND contains(lower(name), '1')")
def catalog_filters(t):
    """(FLT-01 to FLT-04, FLT-06, SRC-10)"""
    rows = C.matching(camps(t), "country", [" us", "CA "]).withColumn("tags", F.array(F.lower("family")))
    found = C.search(
        rows, C.visible(F.col("is_excluded")), F.col("draft_status").isin("candidate", "candidate_pending"), C.has_tag(F.col("tags"), "u"), C.at_least(F.col("ages_max"), 8), C.at_most(F.col("ages_min"), 12), C.at_most(F.col("pricing_min"), 6000),
        C.contains_any_case("1", F.col("name")), None,
    )
    return found.select("record_id", "name")


@query(CATALOG_SQL + "SELECT 'untriaged' AS work, record_id FROM camps WHERE coalesce(NOT is_excluded, true) AND triage_verdict IS NULL UNION ALL SELECT 'enrich', record_id FROM camps WHERE coalesce(NOT is_excluded, true) AND triage_verdict = 'likely_camp' AND coalesce(website_url, '') <> '' AND pricing_min IS NULL")
def work_sets(t):
    """(FLT-08, FLT-02)"""
    rows = camps(t)
    untriaged = C.work_set(rows).select(F.lit("untriaged").alias("work"), "record_id")
    return untriaged.union(C.work_set(rows, done=F.col("pricing_min").isNotNull(), want="likely_camp").select(F.lit("enrich"), "record_id"))


@query(CATALOG_SQL + "SELECT record_id, array_to_string(list_filter([CASE WHEN coalesce(trim(website_url), '') = '' THEN 'website_url' END, CASE WHEN triage_verdict IS NULL THEN 'triage_verdict' END], lambda v: v IS NOT NULL), ',') AS missing FROM camps WHERE coalesce(trim(website_url), '') = '' OR triage_verdict IS NULL")
def required_keys(t):
    """(FLT-09)"""
    return C.lacking(camps(t), ["name", "website_url", "triage_verdict"]).select("record_id", F.array_join("missing", ",").alias("missing"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P') ORDER BY o_orderdate, o_orderkey")
def review_queue(t):
    """(FLT-10, SRT-01)"""
    return C.review_queue(t("orders"), "o_orderstatus", "o_orderdate", "o_orderkey", ("O", "P")).select("o_orderkey", "o_orderstatus")


@query("SELECT user_id, event_id FROM events WHERE event_type = 'purchase' AND user_id = (SELECT max(user_id) FROM events) UNION ALL SELECT user_id, event_id FROM events WHERE user_id = (SELECT min(user_id) FROM events)")
def owned_rows(t):
    """The last user's purchases and all of the first user's events. (FLT-11, FLT-07)"""
    events = t("events")
    ends = events.agg(F.min("user_id").alias("_first"), F.max("user_id").alias("_last"))  # one row
    named = events.join(F.broadcast(ends), F.col("user_id").isin(F.col("_first"), F.col("_last")))
    last = C.owned(named, "user_id", F.col("_last"), event_type="purchase")
    return last.union(C.owned(named, "user_id", F.col("_first"), event_type=None)).select("user_id", "event_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_ids(t):
    """Documents that no label covers yet. (JON-04)"""
    return C.pending_ids(t("documents").select("doc_id"), "doc_id", t("labels"))


@query("SELECT o_custkey AS user, l_partkey AS p_partkey, p_name, last FROM (SELECT o_custkey, l_partkey, max(l_shipdate) AS last FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) JOIN part ON p_partkey = l_partkey")
def favourites(t):
    """Parts a customer has bought, the last shipped first. (JON-10, PIP-19)"""
    marks = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("p_partkey"), F.col("l_shipdate").alias("last"))
    return C.favourites(marks, t("part").select("p_partkey", "p_name"), "p_partkey", "user", "last").select("user", "p_partkey", "p_name", "last")


@query("""SELECT c_custkey, coalesce(o.n, 0) AS n_orders, coalesce(o.ids, '') AS orders, coalesce(s.n, 0) AS n_suppliers FROM customer LEFT JOIN (SELECT o_custkey, count(*)::INT AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS ids FROM orders GROUP BY 1) o ON o_custkey = c_custkey
LEFT JOIN (SELECT s_nationkey, count(*)::INT AS n FROM supplier GROUP BY 1) s ON s_nationkey = c_nationkey""")
def detail_join(t):
    """(JON-13, JSN-04)"""
    items = t("customer").select("c_custkey", "c_nationkey")
    orders = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    suppliers = t("supplier").select(F.col("s_nationkey").alias("c_nationkey"), "s_suppkey")
    both = C.detail(C.detail(items, "c_custkey", orders=orders), "c_nationkey", suppliers=suppliers)
    return both.select("c_custkey", F.size("orders").alias("n_orders"), F.array_join(F.transform("orders", lambda o: o["o_orderkey"].cast("string")), ",").alias("orders"), F.size("suppliers").alias("n_suppliers"))


@query("SELECT o_orderkey, to_json({'id': o_orderkey, 'answers': map_from_entries([{'k': 'status', 'v': o_orderstatus}, {'k': 'priority', 'v': o_orderpriority}]), 'provenance': {'customer': o_custkey}}) AS j FROM orders")
def nested_json(t):
    """(JSN-04, JSN-05)"""
    entries = F.array(*(F.struct(F.lit(k).alias("k"), F.col(c).alias("v")) for k, c in (("status", "o_orderstatus"), ("priority", "o_orderpriority"))))
    return t("orders").select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.map_from_entries(entries).alias("answers"), F.struct(F.col("o_custkey").alias("customer")).alias("provenance"))).alias("j"))


@query(CATALOG_SQL + "SELECT country, region, count(*)::BIGINT AS n, count(*) FILTER (triage_verdict IS NULL)::BIGINT AS untriaged FROM camps GROUP BY ALL")
def region_counts(t):
    """(AGG-04)"""
    rows = camps(t)
    return C.counts_by(rows, "country", "region").join(C.counts_by(rows, "country", "region", where=F.col("triage_verdict").isNull()).withColumnRenamed("n", "u"), ["country", "region"], "left").select("country", "region", "n", F.coalesce("u", F.lit(0)).alias("untriaged"))


@query(CATALOG_SQL + "SELECT region, count(*)::BIGINT AS n FROM camps WHERE country = 'US' AND coalesce(NOT is_excluded, true) GROUP BY region ORDER BY n, region LIMIT 5")
def smallest_regions(t):
    """A top-k report. (SRT-05)"""
    return C.smallest_groups(camps(t).filter(C.visible(F.col("is_excluded")) & (F.col("country") == "US")), ["region"], 5)


@query("SELECT value, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part) GROUP BY 1 ORDER BY n DESC, value LIMIT 6")
def top_facets(t):
    """A top-k report. (SRT-06)"""
    return C.top_facets(t("part").select(F.explode(F.split("p_name", " ")).alias("value")), "value", 6)


@query(CATALOG_SQL + "SELECT record_id, name, website_url FROM camps WHERE triage_verdict = 'likely_camp' AND pricing_min IS NULL AND pricing_max IS NULL AND website_url IS NOT NULL AND coalesce(NOT is_excluded, true) ORDER BY record_id LIMIT 10")
def sample_rows(t):
    """A sampling operator. (SRT-07)"""
    wanted = (F.col("triage_verdict") == "likely_camp") & F.col("pricing_min").isNull() & F.col("pricing_max").isNull() & F.col("website_url").isNotNull() & C.visible(F.col("is_excluded"))
    return C.sample_rows(camps(t), wanted, "record_id", 10).select("record_id", "name", "website_url")


@query(CATALOG_SQL + """SELECT 'country' AS section, country AS key, count(*)::BIGINT AS value FROM camps GROUP BY 2 UNION ALL SELECT 'likely', country, count(*) FILTER (triage_verdict = 'likely_camp') FROM camps GROUP BY 2 UNION ALL SELECT 'overnight', country, count(*) FILTER (overnight_confirmed) FROM camps GROUP BY 2
UNION ALL SELECT 'excluded', country, count(*) FILTER (is_excluded) FROM camps GROUP BY 2 UNION ALL (SELECT 'fewest', region, count(*) FROM camps WHERE coalesce(NOT is_excluded, true) GROUP BY 2 ORDER BY 3, 2 LIMIT 20) UNION ALL SELECT 'family', lower(family), count(*) FROM camps GROUP BY 2
UNION ALL SELECT 'draft_status', draft_status, count(*) FROM camps GROUP BY 2 UNION ALL SELECT 'verdict', coalesce(triage_verdict, 'NULL (untriaged)'), count(*) FROM camps GROUP BY 2
UNION ALL SELECT 'missing', 'no_url', count(*) FILTER (coalesce(website_url, '') = '') FROM camps UNION ALL SELECT 'missing', 'no_price', count(*) FILTER (triage_verdict = 'likely_camp' AND pricing_min IS NULL AND pricing_max IS NULL AND coalesce(NOT is_excluded, true)) FROM camps""")
def full_gap_report(t):
    """All sections of the gap report; fewest is a top-k one. (PIP-22, AGG-03 to AGG-06, SRT-05)"""
    rows = camps(t).withColumn("families", F.array(F.lower("family")))
    return C.gap_report(rows, 20)


@query("SELECT o_orderkey, CASE WHEN s THEN 'split_needed' WHEN v AND p THEN 'likely_duplicate' WHEN (u AND p) OR (v AND u) OR (o AND u) THEN 'needs_human_review' ELSE 'keep_both' END AS action, o AS same_operator, v AS same_venue, p AS same_place, u AS same_url FROM (SELECT a.o_orderkey, a.o_orderpriority = b.o_orderpriority AS o, a.o_orderdate = b.o_orderdate AS v, a.o_orderstatus = b.o_orderstatus AND a.o_custkey % 3 = b.o_custkey % 3 AS p, a.o_custkey % 5 = b.o_custkey % 5 AS u, a.o_totalprice > 400000 OR b.o_totalprice > 400000 AS s FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1)")
def pair_features(t):
    """Each order against the next as a pair under review. (PIP-20)"""
    k, big = F.col("o_custkey"), F.col("o_totalprice") > 400000
    records = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("operator"), F.col("o_orderdate").alias("venue"), F.col("o_orderstatus").alias("city"), (k % 3).alias("region"), F.concat(F.lit("http://e.org/"), (k % 5).cast("string")).alias("url"), F.when(big, "multi_venue_candidate").otherwise("venue_candidate").alias("basis"))
    pairs = t("orders").select(F.col("o_orderkey").alias("a_id"), (F.col("o_orderkey") + 1).alias("b_id"))
    return C.pair_features(pairs, records, "id", "operator", "venue", ["city", "region"], "url", "basis").select(F.col("a_id").alias("o_orderkey"), "action", "same_operator", "same_venue", "same_place", "same_url")


@query("""WITH a AS (SELECT p_partkey + 1000 AS id, 'e.org/' || (p_partkey % 977) AS url, p_name, p_brand, p_size FROM part), b AS (SELECT p_partkey AS id, 'e.org/' || p_partkey AS url, p_name, p_brand, p_size FROM part)
SELECT a.id AS new_id, b.id AS catalog_id, 'id' AS reason, NULL::INT AS distance FROM a JOIN b ON a.id = b.id UNION ALL SELECT a.id, b.id, 'url', NULL FROM a JOIN b ON a.url = b.url
UNION ALL SELECT a.id, b.id, 'name', levenshtein(a.p_name, b.p_name)::INT FROM a JOIN b ON a.p_brand = b.p_brand AND a.p_size = b.p_size WHERE levenshtein(a.p_name, b.p_name) <= 2""")
def duplicate_probe(t):
    """Parts with moved ids as new rows against the table. (PIP-21)"""
    k = F.col("p_partkey")
    rows = lambda key, tail: t("part").select(key.alias("id"), F.concat(F.lit("http://www.E.org/"), tail.cast("string"), F.lit("/?ref=x")).alias("url"), "p_name", "p_brand", "p_size")
    return C.duplicate_probe(rows(k + 1000, k % 977), rows(k, k), "id", "url", "p_name", ["p_brand", "p_size"], 2)


@query(CATALOG_SQL + """, i AS (SELECT c_custkey + 50 AS record_id, arg_min(c_name, {'s': src, 'k': c_custkey}) AS name, arg_min({'x': x}, {'s': src, 'k': c_custkey}).x AS url FROM (SELECT c_custkey - c_custkey % 2 AS c_custkey, c_name, c_custkey % 2 AS src, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS x FROM customer) GROUP BY 1)
SELECT coalesce(c.record_id, i.record_id) AS record_id, CASE WHEN i.record_id IS NULL THEN c.name ELSE i.name END AS name, CASE WHEN i.record_id IS NULL THEN c.website_url ELSE coalesce(i.url, c.website_url) END AS website_url, CASE WHEN c.record_id IS NULL THEN 'inserted' WHEN i.record_id IS NULL THEN 'kept' ELSE 'updated' END AS action
FROM camps c FULL JOIN i ON c.record_id = i.record_id""")
def catalog_upsert(t):
    """(SNK-04, SNK-05)"""
    k = F.col("c_custkey")
    incoming = t("customer").select((k - k % 2 + 50).alias("record_id"), F.col("c_name").alias("name"), F.when(k % 3 == 0, F.col("c_mktsegment")).alias("website_url"), (k % 2).alias("src"))
    return S.upserted(camps(t).select("record_id", "name", "website_url"), incoming, "record_id", F.col("src"), ["website_url"])


UPSERT_SQL = CATALOG_SQL + """, c0 AS (SELECT record_id, name, country, triage_verdict, website_url FROM camps),
i1 AS (SELECT c_custkey + 50 AS record_id, arg_min(c_name, {'s': src, 'k': c_custkey}) AS name, arg_min({'x': x}, {'s': src, 'k': c_custkey}).x AS url FROM (SELECT c_custkey - c_custkey % 2 AS c_custkey, c_name, c_custkey % 2 AS src, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS x FROM customer WHERE c_custkey % 7 = 3) GROUP BY 1),
c1 AS (SELECT coalesce(c.record_id, i.record_id) AS record_id, CASE WHEN i.record_id IS NULL THEN c.name ELSE i.name END AS name, CASE WHEN i.record_id IS NULL THEN c.country ELSE 'MX' END AS country, CASE WHEN i.record_id IS NULL THEN c.triage_verdict ELSE 'unclear' END AS triage_verdict,
  CASE WHEN i.record_id IS NULL THEN c.website_url ELSE coalesce(i.url, c.website_url) END AS website_url FROM c0 c FULL JOIN i1 i ON c.record_id = i.record_id),
i2 AS (SELECT c_custkey AS record_id, 'second' AS name, 'US' AS country, CASE WHEN c_custkey % 2 = 0 THEN 'likely_camp' END AS triage_verdict FROM customer WHERE c_custkey % 11 = 0),
c2 AS (SELECT coalesce(c.record_id, i.record_id) AS record_id, CASE WHEN i.record_id IS NULL THEN c.name ELSE i.name END AS name, CASE WHEN i.record_id IS NULL THEN c.country ELSE i.country END AS country,
  CASE WHEN i.record_id IS NULL THEN c.triage_verdict ELSE i.triage_verdict END AS triage_verdict, c.website_url FROM c1 c FULL JOIN i2 i ON c.record_id = i.record_id)
"""


def stored_catalog(t) -> Catalog:
    """The catalog on disk after its first rows and two upserts; the counts follow each."""
    first = camps(t).select("record_id", "name", "country", "triage_verdict", "website_url")
    spark, k = first.sparkSession, F.col("c_custkey")
    held = Catalog(spark, fresh_path(spark, "catalog"), first.schema)
    second = t("customer").filter("c_custkey % 7 = 3").select((k - k % 2 + 50).alias("record_id"), F.col("c_name").alias("name"), F.lit("MX").alias("country"), F.lit("unclear").alias("triage_verdict"), F.when(k % 3 == 0, F.col("c_mktsegment")).alias("website_url"), (k % 2).alias("src"))
    third = t("customer").filter("c_custkey % 11 = 0").select(k.alias("record_id"), F.lit("second").alias("name"), F.lit("US").alias("country"), F.when(k % 2 == 0, "likely_camp").alias("triage_verdict"), F.lit(None).cast("string").alias("website_url"), F.lit(0).alias("src"))
    for batch, rows, priority in (("1", first, F.lit(0)), ("2", second, F.col("src")), ("3", third, F.col("src"))):
        held.upsert(rows, batch, priority, ["website_url"])
        held.count_changes(batch, "verdicts", ["country", "triage_verdict"], {"no_url": F.coalesce("website_url", F.lit("")) == ""})
    return held


@query(UPSERT_SQL + "SELECT * FROM c2")
def catalog_stored(t):
    """The catalog as written and read back: touched partitions alone are rewritten. (SNK-04, SNK-05, SRC-10)"""
    return stored_catalog(t).read()


@query(UPSERT_SQL + "SELECT country, triage_verdict, count(*)::BIGINT AS total, count(*) FILTER (coalesce(website_url, '') = '')::BIGINT AS n_no_url FROM c2 GROUP BY ALL")
def catalog_counts(t):
    """Counts kept from the changes of three batches, with what they retract. (AGG-01, AGG-03, AGG-04)"""
    return stored_catalog(t).counts("verdicts")


@query("SELECT n_name, '# ' || n_name || chr(10) || string_agg('- ' || s_name, chr(10) ORDER BY s_name) AS text FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name UNION ALL SELECT '', string_agg(line, chr(10) ORDER BY line) FROM (SELECT '- ' || n_name || ' (' || count(*) || ')' AS line FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name)")
def index_texts(t):
    """(SNK-07)"""
    rows = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    groups = S.index_text(rows.select(F.col("n_name"), "s_name"), "n_name", "s_name")
    return groups.select("n_name", "text").union(S.root_index(rows, "n_name").select(F.lit(""), "text"))


@query("SELECT 'r' || s_suppkey AS record_id, s_name AS name, s_acctbal::VARCHAR AS balance, 'Body of ' || s_name AS body, s_nationkey AS country FROM supplier WHERE s_suppkey % 5 <> 0")
def document_sink(t):
    """Suppliers written as documents with front matter, without those written before, and read back. (SNK-03, SRC-07, UDF-05)"""
    rows = t("supplier").select(F.concat(F.lit("r"), F.col("s_suppkey").cast("string")).alias("record_id"), F.col("s_name").alias("name"), F.col("s_acctbal").cast("string").alias("balance"), F.concat(F.lit("Body of "), "s_name").alias("text"), F.col("s_nationkey").alias("country"))
    spark = rows.sparkSession
    path = fresh_path(spark, "documents")
    S.write_documents(rows, path, ["record_id", "name", "balance"], "text", ["country"], rows.filter(F.substring("record_id", 2, 20).cast("long") % 5 == 0))
    back = S.read_documents(spark, path, ["record_id", "name", "balance"])
    return back.select("record_id", "name", "balance", F.trim(F.regexp_replace("body", r"^\s+|\s+$", "")).alias("body"), "country")


@query("SELECT event_id, user_id, event_type FROM events")
def jsonl_sink(t):
    """Events written as JSON lines and read back strictly. (SNK-01, SNK-02, SRC-01)"""
    rows = t("events").select("event_id", "user_id", "event_type")
    path = fresh_path(rows.sparkSession, "jsonl")
    S.write_jsonl(rows.filter("user_id % 2 = 0"), path)
    S.write_jsonl(rows.filter("user_id % 2 = 1"), path, "append")
    return S.jsonl(rows.sparkSession, path, "event_id long, user_id long, event_type string")


@query("SELECT sum((user_id % 7 = 0)::INT)::BIGINT AS bad, sum((user_id % 7 <> 0)::INT)::BIGINT AS good FROM events")
def tolerant_scan(t):
    """A log with broken lines. (SRC-02, SRC-03, AGG-12)"""
    rows = t("events").select(F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("{broken "), F.col("event_id").cast("string"))).otherwise(F.to_json(F.struct(F.col("event_id").alias("id")))).alias("value"))
    path = fresh_path(rows.sparkSession, "log")
    rows.write.text(path)
    bad = F.col(S.CORRUPT).isNotNull()
    return materialise(S.jsonl_tolerant(rows.sparkSession, path, "id long"), "scanned").agg(F.count_if(bad).alias("bad"), F.count_if(~bad).alias("good"))


@query("""WITH d AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, url, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS body FROM pages)
SELECT page_id::VARCHAR AS capture_path, host AS resolved_host, left(body, 280) AS body_preview, sha256(body) AS body_sha256, length(body)::BIGINT AS body_length_chars, len(list_filter(string_split(body, ' '), lambda x: x <> ''))::BIGINT AS body_word_count, CASE WHEN body = '' THEN 0 ELSE 1 END::BIGINT AS body_line_count, CASE WHEN page_id % 2 = 0 THEN 'captured' ELSE 'indexed' END AS evidence_status FROM d""")
def evidence_index(t):
    """Pages' titles as bodies of captured documents. (TXT-20, STR-05, STR-13)"""
    title = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))
    docs = t("pages").select(F.col("page_id").cast("string").alias("path"), F.col("url").alias("source_url"), title.alias("body"), F.when(F.col("page_id") % 2 == 0, "captured").alias("capture_status"))
    return S.evidence_index(docs).select("capture_path", "resolved_host", "body_preview", "body_sha256", "body_length_chars", "body_word_count", "body_line_count", "evidence_status")


@query("""WITH h AS (SELECT page_id, replace(replace(replace(replace(lower(split_part(split_part(url, '#', 1), '?', 1)), 'https://', ''), 'http://', ''), 'www.', ''), 'WWW.', '') AS k FROM pages), u AS (SELECT page_id, rtrim(k, '/') AS k FROM h)
SELECT a.page_id, max(b.page_id) AS capture FROM u a JOIN u b ON a.k = b.k GROUP BY 1""")
def last_captures(t):
    """The last page of each page's URL without query. (JON-01)"""
    bare = t("pages").select("page_id", F.regexp_replace(F.lower(F.regexp_replace("url", r"[?#].*$", "")), "^https?://", "").alias("url"))
    return S.last_captures(bare, bare, "url", "page_id").select("page_id", F.col("capture.page_id").alias("capture"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'md ' || c_name WHEN c_custkey % 3 = 1 THEN 'html ' || c_name END AS evidence FROM customer")
def evidence_text(t):
    """(JON-09)"""
    rows, k = t("customer"), F.col("c_custkey")
    md = rows.select(k, F.when(k % 3 == 0, F.concat(F.lit("md "), "c_name")).otherwise("  ").alias("text"))
    html = rows.filter(k % 3 < 2).select(k, F.concat(F.lit("<p>html</p><script>x</script>"), "c_name").alias("text"))
    return S.evidence_text(rows.select("c_custkey"), "c_custkey", md, html).select("c_custkey", "evidence")


@query("""WITH h AS (SELECT event_id, 'q' || (user_id % 20) AS q, user_id % 30 AS host, value FROM events), a AS (SELECT *, 'https://h' || host || '.org/' || floor(value)::BIGINT AS url FROM h), f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id) AS rn FROM a WHERE host <> 7),
k AS (SELECT event_id, url, row_number() OVER (ORDER BY event_id) AS rank FROM f WHERE rn = 1) SELECT k.event_id, k.url AS normalized_url, k.rank FROM k""")
def accepted_hits(t):
    """Events as hits; accepted ones ranked over all queries. (PIP-03, WIN-03, WIN-07)"""
    return Q.ranked_hits(hits(t), "url", [F.col("event_id")], deny=["h7.org"]).select("event_id", "normalized_url", "rank")


def hits(t):
    url = F.concat(F.lit("HTTPS://www.h"), (F.col("user_id") % 30).cast("int").cast("string"), F.lit(".org/"), F.floor("value").cast("string"), F.lit("/?utm_id=1"))
    return t("events").select("event_id", F.concat(F.lit("q"), (F.col("user_id") % 20).cast("int").cast("string")).alias("query"), url.alias("url"))


@query("""WITH a AS (SELECT event_id, 'q' || (user_id % 20) AS query, user_id % 30 AS host, 'https://h' || (user_id % 30) || '.org/' || floor(value)::BIGINT AS url FROM events), f AS (SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id) AS rn FROM a WHERE host <> 7) WHERE rn = 1),
s AS (SELECT 'q' || i AS query FROM range(25) r(i)) SELECT s.query, count(a.event_id)::BIGINT AS raw_results, count(f.event_id)::BIGINT AS accepted_results FROM s LEFT JOIN a ON a.query = s.query LEFT JOIN f ON f.event_id = a.event_id GROUP BY 1""")
def query_log(t):
    """Raw and accepted hits of each query, also of those without hits. (AGG-11)"""
    specs = t("nation").select(F.concat(F.lit("q"), F.col("n_nationkey").cast("string")).alias("query"))
    return Q.query_log(specs, hits(t), "query", "url", [F.col("event_id")], deny=["h7.org"])


@query("SELECT o_orderkey, CASE WHEN v = 'no' AND strong THEN 'unclear' ELSE v END AS verdict, v = 'no' AND NOT strong AS excluded, v IS NULL AS missing FROM (SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'no' ELSE 'likely' END AS v, o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' AS strong FROM orders)".replace("v = 'no' AND NOT strong AS excluded", "coalesce(v = 'no' AND NOT strong, false) AS excluded"))
def triage_batches(t):
    """Batch replies, an array per customer, joined back to the orders; ids without an answer are reported. (PIP-15, JON-11, JSN-03)"""
    orders = t("orders").select("o_orderkey", "o_custkey", F.rlike("o_orderpriority", F.lit("^[12]")).alias("strong"), F.when(F.col("o_orderstatus") == "F", "no").otherwise("likely").alias("v"))
    answer = F.to_json(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.col("v").alias("verdict"), F.lit("high").alias("confidence"))))
    replies = orders.filter("o_custkey % 7 <> 0").groupBy((F.col("o_orderkey") % 1000).alias("batch"), "o_custkey").agg(F.concat(F.lit("Here: "), answer, F.lit(" done")).alias("reply"))
    return Q.triage_batch(orders, "o_orderkey", replies, "reply", F.col("strong"), "no").select("o_orderkey", "verdict", "excluded", F.col("skipped").isNotNull().alias("missing"))


DOSSIER_SQL = """WITH s AS (SELECT s_suppkey, s_name AS name, CASE WHEN s_suppkey % 4 <> 0 THEN 'Town' END AS city, CASE WHEN s_suppkey % 6 <> 0 THEN 'https://e.org/' || s_suppkey END AS url, s_suppkey % 2 = 0 AS long, CASE WHEN s_suppkey % 3 <> 0 THEN 'stay in a dorm' END AS night,
 CASE WHEN s_suppkey % 5 <> 0 THEN 'dates 2024' END AS recent, CASE WHEN s_suppkey % 7 < 4 THEN '$100, housing included' END AS price, CASE s_suppkey % 3 WHEN 0 THEN 'ages 8-12' WHEN 1 THEN 'grades 3 to 6' END AS who,
 CASE WHEN s_suppkey % 8 < 5 THEN ['pricing', 'contact_details'] WHEN s_suppkey % 8 = 5 THEN ['confirm_exact_venue'] ELSE [] END AS needs FROM supplier),
t AS (SELECT *, name || ' at Hall' AS title, coalesce(city, '') || ', BC' AS place, CASE WHEN long THEN '2-week' ELSE 'unknown' END AS label, night IS NOT NULL AS o, recent IS NOT NULL AS a FROM s)
SELECT s_suppkey, title, CASE WHEN list_contains(needs, 'confirm_exact_venue') THEN 'low' WHEN o AND a AND len(needs) <= 1 THEN 'high' WHEN o OR a THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN city IS NULL THEN 'unknown_city' ELSE '' END AS reasons,
 concat_ws(chr(10) || chr(10), '# ' || title, '## Quick Take' || chr(10) || chr(10) || name || ': ' || CASE WHEN long THEN '2-week ' ELSE '' END || 'stem program, ' || place || '.',
  '## Verified Facts' || chr(10) || chr(10) || concat_ws(chr(10), '- Operator: ' || name, '- Venue: Hall', '- Place: ' || place, '- Site: ' || url, '- Families: stem', '- Types: overnight', CASE WHEN long THEN '- Length: 2-week' END),
  '## Overnight Evidence' || chr(10) || chr(10) || night, '## Recent Activity Evidence' || chr(10) || chr(10) || recent, '## Ages and Grades' || chr(10) || chr(10) || who || CASE WHEN who LIKE 'ages%' THEN ' Ages 8-12.' ELSE ' Grades 3-6.' END,
  '## Session Length' || chr(10) || chr(10) || label || '.' || CASE WHEN long THEN ' 14 to 14 days.' ELSE '' END, '## Pricing' || chr(10) || chr(10) || price, '## Location' || chr(10) || chr(10) || 'Hall ' || place, '## Contact' || chr(10) || chr(10) || url,
  CASE WHEN len(needs) > 0 THEN '## Open Questions' || chr(10) || chr(10) || CASE WHEN len(needs) = 2 THEN '- Pricing' || chr(10) || '- Contact Details' ELSE '- Confirm Exact Venue' END END, '## Sources' || chr(10) || chr(10) || '- ' || url) AS dossier,
 CASE WHEN price IS NOT NULL THEN true END AS boarding, CASE WHEN o THEN url END AS overnight_url, CASE WHEN who LIKE 'grades%' THEN 6 END AS last_grade, 'CAD' AS currency, a AS active FROM t"""


@query(DOSSIER_SQL)
def dossiers(t):
    """Suppliers as candidates: the whole text, parts of the front matter, and the reasons that keep a row from being rendered. (PIP-16, R17)"""
    k, text, none = F.col("s_suppkey"), F.lit, F.array().cast("array<string>")
    rows = t("supplier").select(
        k, F.concat(text("c"), k.cast("string")).alias("candidate_id"), text("venue_candidate").alias("record_basis"), F.col("s_name").alias("name"), F.col("s_name").alias("operator_name"), text("Hall").alias("venue_name"),
        F.when(k % 4 != 0, "Town").alias("city"), text("BC").alias("region"), text("CA").alias("country"), F.when(k % 6 != 0, F.concat(text("https://e.org/"), k.cast("string"))).alias("canonical_url"), F.array(text("stem")).alias("program_family"), F.array(text("overnight")).alias("camp_types"),
        text("active_recent").alias("activity_status_guess"), F.when(k % 2 == 0, F.struct(text("2-week").alias("label"), text(14).alias("min_days"), text(14).alias("max_days"))).alias("duration_guess"), F.struct(text(False).alias("college_precollege"), text(True).alias("one_week_plus")).alias("priority_flags"),
        F.when(k % 8 < 5, F.array(text("pricing"), text("contact_details"))).when(k % 8 == 5, F.array(text("confirm_exact_venue"))).otherwise(none).alias("validation_needs"), F.when(k % 3 != 0, "stay in a dorm").alias("overnight_evidence_snippet"),
        F.when(k % 5 != 0, "dates 2024").alias("recent_activity_evidence_snippet"), none.alias("notes"), F.when(k % 3 == 0, "ages 8-12").when(k % 3 == 1, "grades 3 to 6").alias("eligibility_summary"), F.when(k % 7 < 4, "$100, housing included").alias("pricing_summary"),
    )
    made = Q.dossiers(rows)
    part = lambda path, kind="string": F.get_json_object("front_matter", f"$.{path}").cast(kind)
    return made.select(
        "s_suppkey", part("display_name").alias("title"), "confidence", F.array_join("reasons", ",").alias("reasons"), "dossier", part("pricing.boarding_included", "boolean").alias("boarding"), part("evidence.overnight_source_url").alias("overnight_url"),
        part("grades.max", "int").alias("last_grade"), part("pricing.currency").alias("currency"), part("verification.active_past_2_years_confirmed", "boolean").alias("active"),
    )
