"""Queries of scalar functions over columns of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake import rules as R
from leadlake.functions import extract as X
from leadlake.functions import text as S
from leadlake.functions import url as U
from leadlake.functions import values as V
from leadlake.operators import catalog as C
from leadlake.operators import keyed as K
from leadlake.plans.queries import SLUG_SQL
from leadlake.plans.registry import query
from leadlake.scratch import fresh_path
from leadlake.sources import files as Files
from leadlake.sources import html as H


@query(f"""SELECT doc_id, {SLUG_SQL.format("left(text, 60)")} AS slug, regexp_replace(regexp_replace(regexp_replace(lower(trim(source || '_' || lang || ' (x)!')), '[^a-z0-9_\\s-]', '', 'g'), '[\\s_-]+', '-', 'g'), '^-+|-+$', '', 'g') AS export_slug,
 left(trim(regexp_replace(text, '\\s+', ' ', 'g')), 40) AS head, trim(regexp_replace(source, '\\s+', ' ', 'g')) AS compacted FROM documents""")
def text_forms(t):
    """(STR-01, STR-02, STR-03, STR-05)"""
    text = F.col("text")
    return t("documents").select("doc_id", S.slug(F.left(text, F.lit(60))).alias("slug"), S.export_slug(F.concat("source", F.lit("_"), "lang", F.lit(" (x)!"))).alias("export_slug"), S.excerpt(text, 40).alias("head"), S.compact(F.col("source")).alias("compacted"))


@query("""SELECT doc_id, array_to_string(list_slice(list_distinct_ordered, 1, 3), '|') AS sentences FROM (SELECT doc_id, list_filter(l, (x, i) -> list_position(l, x) = i) AS list_distinct_ordered FROM (
 SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?\\n]+'), x -> trim(x, ' ')), x -> length(x) BETWEEN 15 AND 60 AND regexp_matches(x, '(?i)the|la|der')) AS l FROM documents))""".replace("x -> ", "lambda x: ").replace("(x, i) -> ", "lambda x, i: "))
def evidence_sentences(t):
    """(STR-11)"""
    return t("documents").select("doc_id", F.array_join(S.evidence_sentences(F.col("text"), "(?i)the|la|der", 15, 60, 3), "|").alias("sentences"))


@query("""WITH c AS (SELECT page_id, url, lower(regexp_replace(regexp_extract(url, '^[^:]+://([^/?#]*)', 1), '^www\\.', '')) AS h, regexp_replace(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS p FROM pages)
SELECT page_id, regexp_replace(h, '[^a-z0-9]+', '-', 'g') || '--' || coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_extract(p, '([^/]*)$', 1)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'root') AS stem, len(list_distinct([rtrim(url, '/'), rtrim(split_part(url, '?', 1), '/')]))::INT AS n_urls,
 'https://e.org/a?b=' || page_id AS target FROM c""")
def url_forms(t):
    """(URL-04, URL-05, URL-06)"""
    url = F.col("url")
    link = F.concat(F.lit("//r.example.com/l/?uddg=https%3A%2F%2Fe.org%2Fa%3Fb%3D"), F.col("page_id").cast("string"), F.lit("&rut=x"))
    stem = F.regexp_replace(U.capture_stem(url), r"--[0-9a-f]{10}$", "")
    return t("pages").select("page_id", stem.alias("stem"), F.size(U.distinct_urls(url, F.split_part(url, F.lit("?"), F.lit(1)), F.lit(" "), F.lit(None).cast("string"))).alias("n_urls"), U.unwrapped(link).alias("target"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice::INT BETWEEN 1000 AND 200000 THEN trunc(o_totalprice)::INT END AS n, CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '5-LOW' THEN false END AS flag, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso,
 CASE WHEN year(o_orderdate) BETWEEN 1996 AND 1998 OR o_orderstatus = 'P' THEN 'active_recent' ELSE 'unknown' END AS activity FROM orders""".replace("o_totalprice::INT BETWEEN", "trunc(o_totalprice)::INT BETWEEN"))
def value_forms(t):
    """(NUM-01, NUM-02, DAT-01, DAT-02)"""
    said = F.when(F.col("o_orderpriority") == "1-URGENT", " Yes ").when(F.col("o_orderpriority") == "5-LOW", "0").otherwise("perhaps")
    text = F.concat(F.year("o_orderdate").cast("string"), F.when(F.col("o_orderstatus") == "P", " Apply now!").otherwise(""))
    return t("orders").select("o_orderkey", V.safe_int(F.col("o_totalprice"), 1000, 200000).alias("n"), V.safe_bool(said).alias("flag"), V.iso_utc(F.col("o_orderdate")).alias("iso"), V.activity(text, 1998).alias("activity"))


WORDS = "string_split(p_name, ' ')"


@query(f"""SELECT p_partkey, array_to_string({WORDS}, ',') AS parsed, CASE WHEN p_size % 3 = 0 THEN NULL ELSE to_json({WORDS}) END AS written, array_to_string(list_sort(list_distinct(list_concat({WORDS}, [lower(p_type)]))), ',') AS merged, CASE WHEN p_size % 2 = 0 THEN split_part(p_name, ' ', 1) ELSE 'unknown' END AS kept,
 CASE WHEN p_size % 2 = 0 THEN array_to_string({WORDS}, ',') ELSE p_name END AS listed, array_to_string(list_sort(list_filter({WORDS}, lambda x: x IN ('red', 'bolt', 'gear'))), ',') AS known, array_to_string(list_sort(list_filter({WORDS}, lambda x: x NOT IN ('red', 'bolt', 'gear', 'old'))), ',') AS extra FROM part""")
def list_forms(t):
    """(JSN-01, JSN-02, ARR-01 to ARR-04, SET-04)"""
    words, even = F.split("p_name", " "), F.col("p_size") % 2 == 0
    shouted = F.to_json(F.concat(F.transform(words, lambda w: F.concat(F.lit(" "), F.upper(w))), F.array(F.lit(" "))))
    split = V.known_and_extra(words, ("red", "bolt", "gear"), ("old",))
    return t("part").select(
        "p_partkey", F.array_join(V.json_list(shouted), ",").alias("parsed"), V.list_json(F.when(F.col("p_size") % 3 == 0, F.array(F.lit(" "))).otherwise(F.concat(words, F.array(F.lit(""))))).alias("written"),
        F.array_join(F.array_sort(V.merged(words, F.array(F.lower("p_type"), F.lit(None)), F.array(F.lit("")))), ",").alias("merged"),
        F.array_join(V.without_sentinel(F.when(even, F.array(F.lit("unknown"), words[0])).otherwise(F.array(F.lit("unknown"))), "unknown"), ",").alias("kept"),
        F.array_join(V.scalar_or_list(F.when(even, F.to_json(words)).otherwise(F.concat(F.lit(" "), "p_name", F.lit("  ")))), ",").alias("listed"), F.array_join(split["known"], ",").alias("known"), F.array_join(split["extra"], ",").alias("extra"),
    )


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment) || '@mail.org' END AS email, CASE WHEN c_custkey % 3 <> 0 THEN '604 ' || (1000 + c_custkey) END AS phone, CASE WHEN c_custkey % 3 = 0 THEN 8 END AS low, CASE WHEN c_custkey % 3 = 0 THEN 12 END AS high, coalesce(CASE WHEN c_custkey % 5 = 0 THEN 'Canada' END, 'other') AS land FROM customer""")
def contact_forms(t):
    """(TXT-16, TXT-23, MAP-01)"""
    k = F.col("c_custkey")
    mail = F.concat(F.lit(" "), "c_mktsegment", F.when(k % 4 == 0, "@Mail.org ").otherwise(" at mail"))
    phone = F.when(k % 3 != 0, F.concat(F.lit("604  "), (k + 1000).cast("string"))).otherwise("12")
    span = X.labelled_range(F.when(k % 3 == 0, "Ages 8 to 12 and grade 3").otherwise("all"), "age")
    return t("customer").select("c_custkey", X.valid_email(mail).alias("email"), X.valid_phone(phone).alias("phone"), span["low"].alias("low"), span["high"].alias("high"), X.renamed(F.when(k % 5 == 0, " CA"), {"ca": "Canada", "us": "United States"}, F.lit("other")).alias("land"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '4-NOT SPECIFIED' OR o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN true ELSE false END AS placeholder, CASE WHEN o_orderstatus = 'P' THEN 'fixed' ELSE o_orderstatus END AS status, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS level FROM orders")
def placeholder_patch(t):
    """Placeholders, and a struct patched at both levels. (STR-09, STC-01)"""
    text = F.when(F.col("o_orderstatus") == "P", " TBD ").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "City to be  confirmed").when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"), "").otherwise("Town")
    record = F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.lit(0).alias("level")).alias("inner"))
    patched = F.when(F.col("o_orderstatus") == "P", V.patched(record, {"status": F.lit("fixed"), "inner.level": F.lit(1)})).otherwise(record)
    rows = t("orders").select("o_orderkey", S.is_placeholder(text).alias("placeholder"), patched.alias("r"))
    return rows.select("o_orderkey", "placeholder", "r.status", F.col("r.inner.level").alias("level"))


@query("SELECT doc_id, coalesce(l.quality, 9) AS quality, coalesce(l.toxic, d.n_chars::INT) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def last_writer(t):
    """(WIN-10)"""
    base = t("documents").select("doc_id", F.lit(9).alias("quality"), F.col("n_chars").cast("int").alias("toxic"))
    return K.update_merge(base, t("labels"), "doc_id", ["quality", "toxic"])


@query("SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY ALL")
def keyed_answers(t):
    """The last answer per user and question. (PIP-19, WIN-02)"""
    return K.keep_last(t("events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], [F.col("event_id")])


@query("SELECT user_id, count(*)::BIGINT AS total, count(*) FILTER (event_type = 'view')::BIGINT AS viewed, count(*) FILTER (value IS NULL OR value < 5)::BIGINT AS small FROM events GROUP BY 1")
def dashboard(t):
    """(AGG-06, AGG-12, AGG-13)"""
    return C.conditional_counts(t("events"), ["user_id"], {"viewed": F.col("event_type") == "view", "small": F.coalesce(F.col("value") < 5, F.lit(True))})


@query("SELECT 'orders' AS kind, o_orderkey AS id, o_orderstatus AS status, NULL AS note FROM orders UNION ALL SELECT 'parts', p_partkey, NULL, p_name FROM part")
def mixed_union(t):
    """(SET-01)"""
    parts = t("part").select(F.lit("parts").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("note"))
    return t("orders").select(F.lit("orders").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")).unionByName(parts, allowMissingColumns=True)


@query("SELECT event_id, 'related_topics' AS section, 1 + i AS rank, 'https://e.org/' || event_id || '/' || i AS url, 't' || i AS title FROM events, range(3) r(i) UNION ALL SELECT event_id, 'abstract', 1, 'https://a.org/' || event_id, CASE WHEN event_id % 2 = 0 THEN 'Head' ELSE 'https://a.org/' || event_id END FROM events WHERE event_id % 3 = 0")
def answer_hits(t):
    """Instant-answer payloads made of events, with topics in topics. (SRC-11)"""
    key = F.col("event_id")
    topic = lambda i: F.struct(F.concat(F.lit("https://e.org/"), key.cast("string"), F.lit(f"/{i}")).alias("FirstURL"), F.lit(f"t{i}").alias("Text"), F.lit(None).cast("array<struct<FirstURL: string, Text: string>>").alias("Topics"))
    inner = lambda i: F.struct(topic(i)["FirstURL"].alias("FirstURL"), topic(i)["Text"].alias("Text"))
    nested = F.struct(F.lit(None).cast("string").alias("FirstURL"), F.lit(None).cast("string").alias("Text"), F.array(inner(1), inner(2)).alias("Topics"))
    abstract = F.when(key % 3 == 0, F.concat(F.lit("https://a.org/"), key.cast("string")))
    payload = F.to_json(F.struct(abstract.alias("AbstractURL"), F.when(key % 2 == 0, "Head").alias("Heading"), F.array(topic(0), nested).alias("RelatedTopics")))
    return Files.answer_hits(t("events").select("event_id", payload.alias("payload")), "payload", "event_id").select("event_id", "section", "rank", "url", "title")


@query("SELECT event_id, 1 + i AS rank, 'https://e.org/' || event_id || '/' || i AS url, CASE WHEN i = 0 THEN 'top' ELSE 'deep' END AS title FROM events, range(1 + (event_id % 12)::BIGINT) r(i) WHERE i = 0 OR i = event_id % 12")
def deep_topics(t):
    """Topics nested up to eleven deep, the last rank being the number of topics there would be if each depth held one. (SRC-11)"""
    key, url = F.col("event_id"), lambda i: F.concat(F.lit('{"FirstURL":"https://e.org/'), F.col("event_id").cast("string"), F.lit("/"), i, F.lit('","Text":"'))
    depth = (key % 12).cast("int")
    blanks = F.array_join(F.array_repeat(F.lit('{"FirstURL":"","Text":"none"},'), F.greatest(depth - 1, F.lit(0))), "")
    inner = F.when(depth > 0, F.concat(F.lit(","), F.repeat(F.lit('{"Name":"n","Topics":['), depth), blanks, url(depth.cast("string")), F.lit('deep"}'), F.repeat(F.lit("]}"), depth))).otherwise("")
    payload = F.concat(F.lit('{"RelatedTopics":['), url(F.lit("0")), F.lit('top"}'), inner, F.lit("]}"))
    return Files.answer_hits(t("events").select(key, payload.alias("payload")), "payload", "event_id").select("event_id", "rank", "url", "title")


@query("SELECT event_id, 1 + i AS rank, CASE WHEN i = 0 THEN 'T' ELSE 'https://e.org/' || event_id || '/' || i END AS title, 'https://e.org/' || event_id || '/' || i AS url, CASE WHEN i = 0 THEN 'c' ELSE '' END AS snippet FROM events, range(2) r(i)")
def page_hits(t):
    """(SRC-12)"""
    url = lambda i: F.concat(F.lit(" https://e.org/"), F.col("event_id").cast("string"), F.lit(f"/{i} "))
    none = F.lit(None).cast("string")
    hits = F.array(F.struct(F.lit("T").alias("title"), url(0).alias("url"), F.lit("c").alias("content")), F.struct(F.lit("").alias("title"), url(1).alias("url"), none.alias("content")), F.struct(F.lit("x").alias("title"), F.lit(" ").alias("url"), none.alias("content")))
    return Files.page_hits(t("events").select("event_id", F.to_json(F.struct(hits.alias("results"))).alias("payload")), "payload", "event_id")


@query("SELECT page_id, 1 AS rank, 'Page ' || page_id AS title, 'https://e.org/p?id=' || page_id AS url, 'About ' || page_id AS snippet FROM pages")
def result_hits(t):
    """Result pages made of page ids; the second link is the provider's own. (SRC-13, URL-06, FLT-12)"""
    key = F.col("page_id").cast("string")
    html = F.concat(F.lit('<table><tr><td>1.</td><td><a rel="nofollow" href="//duckduckgo.com/l/?uddg=https%3A%2F%2Fe.org%2Fp%3Fid%3D'), key, F.lit('&amp;rut=t" class="result-link"> Page <b>'), key, F.lit('</b></a></td></tr><tr><td></td><td class="result-snippet">About\n '), key, F.lit('</td></tr><tr><td><a class="result-link" href="/html">Home</a></td></tr></table>'))
    return H.result_hits(t("pages").select("page_id", html.alias("html")), "html", "page_id").select("page_id", "rank", "title", "url", "snippet")


@query(f"""SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([{', '.join(f"CASE WHEN contains(lower(w), '{n}') THEN '{g}' END" for n, g in R.CAMP_TYPE_RULES)}], lambda x: x IS NOT NULL))), ',') AS tags FROM (SELECT p_partkey, ['Overnight dorms', 'live ON campus', 'Residential', 'day', 'residence hall', 'band'][1 + p_size % 6] AS w FROM part) WHERE w NOT IN ('day', 'band')
UNION ALL SELECT p_partkey, 'unknown' FROM part WHERE p_size % 6 IN (3, 5)""")
def camp_types(t):
    """(TXT-02, UDF-02)"""
    words = F.element_at(F.array(*map(F.lit, ("Overnight dorms", "live ON campus", "Residential", "day", "residence hall", "band"))), (F.col("p_size") % 6 + 1).cast("int"))
    pack = R.tag_rules(t("part").sparkSession.createDataFrame([(i, n, g) for i, (n, g) in enumerate(R.CAMP_TYPE_RULES)], "position int, needle string, tag string"), "unknown")
    return t("part").select("p_partkey", F.array_join(F.array_sort(X.tags(words, pack)), ",").alias("tags"))


@query("SELECT event_id, value FROM events WHERE value > 10")
def stored_catalog(t):
    """A table written and scanned by two of its columns. (SRC-10)"""
    rows = t("events")
    path = fresh_path(rows.sparkSession, "catalog")
    rows.write.parquet(path)
    return Files.catalog_table(rows.sparkSession, path, ["event_id", "value"]).filter("value > 10")


@query("SELECT s_suppkey, s_name || ' ff' AS folded FROM supplier")
def nfkd_names(t):
    """(UDF-03)"""
    return t("supplier").select("s_suppkey", S.ascii_nfkd(F.concat("s_name", F.lit("́ ﬀß"))).alias("folded"))
