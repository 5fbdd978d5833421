"""File scans and sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadlake.functions import text as S
from leadlake.functions import url as U

CORRUPT = "_corrupt_record"
#: Depths of topics that a round opens at once.
DEPTHS = 8


def jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Strict: a bad line fails the job; blank lines are skipped, a path that isn't there is an empty table. (SRC-01)"""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def jsonl_tolerant(spark: SparkSession, path: str, schema: str, pattern: str = "*") -> DataFrame:
    """Bad lines come back with _corrupt_record set and the rest null. (SRC-02, SRC-03)"""
    return spark.read.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", pattern).json(path)


def manifest_urls(spark: SparkSession, path: str) -> DataFrame:
    """source_url and resolved_url of all manifests of a folder; bad lines are dropped and other fields not parsed. (SRC-03)"""
    return spark.read.schema("source_url string, resolved_url string").option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.jsonl").json(path)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(SRC-04)"""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def exploded(envelopes: DataFrame, array_col: str, *carried: str) -> DataFrame:
    """One row per element with the envelope's fields; the element wins a clash of names. (SRC-05)"""
    rows = envelopes.select(*carried, F.explode(array_col).alias("_e"))
    inner = rows.select("_e.*").columns
    return rows.select(*(c for c in carried if c not in inner), "_e.*")


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines without blanks and # comments. (SRC-06)"""
    return spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> '' and not startswith(line, '#')")


def parsed_front_matter(docs: DataFrame, fields: list[str]) -> DataFrame:
    """``docs`` with its text column value parsed into the named YAML fields, as text, and body; a header that is no mapping counts as empty. (UDF-05)"""
    own = [(n, k) for n, k in docs.dtypes if n != "value"]
    split = docs.select(*(n for n, _ in own), F.regexp_extract("value", r"(?s)\A---\r?\n(.*?)\r?\n---\r?\n?", 1).alias("header"), F.regexp_replace("value", r"(?s)\A---\r?\n.*?\r?\n---\r?\n?", "").alias("body"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for pdf in frames:
            loaded = [yaml.safe_load(h) if h else None for h in pdf["header"]]
            rows = [x if isinstance(x, dict) else {} for x in loaded]
            yield pdf.drop(columns="header").assign(**{f: [None if r.get(f) is None else str(r[f]) for r in rows] for f in fields})

    return split.mapInPandas(read, ", ".join([*(f"`{n}` {k}" for n, k in own), "body string", *(f"`{f}` string" for f in fields)]))


def front_matter(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """path, the named YAML fields as text, and body of a folder of documents. (SRC-07)"""
    docs = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return parsed_front_matter(docs, fields)


def catalog_table(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """The catalog as Parquet, all columns or those named; filters on it reach the scan. (SRC-10)"""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def flattened_hits(payloads: DataFrame, payload: str, results: str, schema: str, *carried: str) -> DataFrame:
    """One row per search result of archived payloads, with its rank from 1; rows without URL are dropped. (SRC-11, SRC-12)"""
    rows = payloads.select(*carried, F.posexplode(F.from_json(payload, f"{results} array<{schema}>")[results]).alias("rank", "_r"))
    return rows.select(*carried, (F.col("rank") + 1).alias("rank"), "_r.*").filter("coalesce(url, '') <> ''")


def filled(*values: Column) -> Column:
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def page_hits(payloads: DataFrame, payload: str, *carried: str) -> DataFrame:
    """(carried, rank, title, url, snippet) of meta-search payloads; a result without a title takes its URL. (SRC-12)"""
    hits = F.from_json(payload, "results array<struct<title: string, url: string, content: string>>")["results"]
    rows = payloads.select(*carried, F.posexplode(hits).alias("rank", "_r")).withColumn("url", F.trim("_r.url"))
    rows = rows.filter("coalesce(url, '') <> ''")
    return rows.select(*carried, (F.col("rank") + 1).alias("rank"), filled(F.col("_r.title"), F.col("url")).alias("title"), "url", F.coalesce("_r.content", F.lit("")).alias("snippet"))


def topic_kind(depths: int) -> str:
    """The type of a topic with this many depths of topics in it; those below stay as they are."""
    return f"struct<FirstURL: string, Text: string, Topics: array<{topic_kind(depths - 1) if depths > 1 else 'variant'}>>"


def topic_entries(topics: Column, depths: int) -> Column:
    """(url, title, below) of typed topics, in order: the entries, and where a topic has topics deeper than ``depths``, these."""
    entry = lambda url, title, below: F.array(F.struct(url.alias("url"), title.alias("title"), below.cast("array<variant>").alias("below")))
    none = F.lit(None).cast("string")
    under = lambda e: topic_entries(e["Topics"], depths - 1) if depths > 1 else F.when(e["Topics"].isNotNull(), entry(none, none, e["Topics"]))
    return F.flatten(F.array_compact(F.transform(topics, lambda e: F.when(e["FirstURL"].isNotNull(), entry(e["FirstURL"], e["Text"], F.lit(None))).otherwise(under(e)))))


def related_topics(answer: Column, brackets: Column) -> Column:
    """(url, title, below) of a parsed answer's related topics in order, ``below`` being null. Rounds of ``DEPTHS`` depths put topics in their holder's
    place until none is left; the answer's text has ``brackets``, of which each depth takes one, so as many rounds suffice. Runs of rounds double,
    since each round copies the entries, also when none is open: a wide answer with few depths has few rounds."""
    state = lambda entries: S.bound(entries, lambda x: F.struct(x.alias("entries"), F.exists(x, lambda e: e["below"].isNotNull()).alias("open")))
    typed = lambda below: F.transform(below, lambda v: F.try_variant_get(v, "$", topic_kind(DEPTHS)))

    def deeper(now: Column, _: Column) -> Column:
        inside = F.transform(now["entries"], lambda e: F.when(e["below"].isNull(), F.array(e)).otherwise(topic_entries(typed(e["below"]), DEPTHS)))
        return F.when(now["open"], state(F.flatten(inside))).otherwise(now)

    run = lambda now, k: F.when(now["open"], F.aggregate(F.sequence(F.lit(1), F.least(F.pow(F.lit(2), k).cast("int"), brackets)), now, deeper)).otherwise(now)
    runs = F.sequence(F.lit(0), F.ceil(F.log2(brackets)).cast("int") + 1)
    first = state(topic_entries(F.try_variant_get(answer, "$.RelatedTopics", f"array<{topic_kind(DEPTHS)}>"), DEPTHS))
    return S.bound(first, lambda now: F.when(now["open"], F.aggregate(runs, now, run)).otherwise(now)["entries"])


def answer_hits(payloads: DataFrame, payload: str, *carried: str) -> DataFrame:
    """(carried, section, rank, title, url, snippet) of instant-answer payloads: the abstract, the results and the related topics, flattened in order, each section ranked from 1; entries without URL keep their rank and are dropped. (SRC-11)

    Topics hold topics, to any depth. A payload is parsed once and flattened inside its row; the hits are written once. A
    payload that is no JSON has no hits.
    """
    from leadlake.operators.keyed import spread
    from leadlake.scratch import materialise

    text = lambda v, path: F.try_variant_get(v, f"$.{path}", "string")
    brackets = F.length(payload) - F.length(F.replace(F.col(payload), F.lit("[")))
    hit = lambda section, url, title, snippet: lambda e, i: F.struct(F.lit(section).alias("section"), (i + 1).alias("rank"), filled(e[title], e[url]).alias("title"), e[url].alias("url"), F.coalesce(e[snippet], F.lit("")).alias("snippet"))

    def every(v: Column) -> Column:
        abstract = F.array(F.struct(*(text(v, n).alias(n) for n in ("AbstractURL", "Heading", "AbstractText"))))
        results = F.try_variant_get(v, "$.Results", "array<struct<FirstURL: string, Text: string>>")
        sections = F.transform(abstract, hit("abstract", "AbstractURL", "Heading", "AbstractText")), F.transform(results, hit("results", "FirstURL", "Text", "Text")), F.transform(related_topics(v, brackets), hit("related_topics", "url", "title", "title"))
        return F.flatten(F.array_compact(F.array(*sections)))

    hits = F.filter(S.bound(F.try_parse_json(payload), every), lambda h: F.coalesce(h["url"], F.lit("")) != "")
    rows = spread(payloads).select(*carried, F.explode_outer(hits).alias("_hit")).filter("_hit IS NOT NULL")  # from an inner explode Catalyst infers a filter that makes the hits anew
    return materialise(rows.select(*carried, "_hit.*"), "opened-payloads")


def write_text_file(rows: DataFrame, path: str) -> None:
    """The text column value as one file with this very name, in the order of the rows; for reports, whose names tell what they are."""
    spark = rows.sparkSession
    rows.select("value").coalesce(1).write.mode("overwrite").text(f"{path}.parts")
    jvm = spark._jvm
    target, parts = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.parts")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(parts):
        if status.getPath().getName().startswith("part-"):
            fs.rename(status.getPath(), target)
    fs.delete(parts, True)


def evidence_index(documents: DataFrame) -> DataFrame:
    """One index row per captured document: what its header says (with fallbacks for the host), a preview, hash and counts of its body. ``documents`` as ``front_matter`` reads them. (TXT-20)"""
    c = lambda n: F.col(n) if n in documents.columns else F.lit(None).cast("string")
    body = F.coalesce("body", F.lit(""))
    host = filled(c("resolved_host"), c("source_host"), U.host(F.coalesce(c("source_url"), F.lit(""))))
    lines = F.regexp_count(F.regexp_replace(body, r"\r\n?", "\n"), F.lit("\n")) + F.when((body == "") | F.rlike(body, F.lit(r"[\r\n]\z")), 0).otherwise(1)
    words = S.compact(body)
    return documents.select(
        F.col("path").alias("capture_path"), c("source_url").alias("source_url"), c("resolved_url").alias("resolved_url"), filled(c("source_host"), host).alias("source_host"), host.alias("resolved_host"),
        c("title").alias("title"), c("description").alias("description"), c("capture_timestamp").alias("capture_timestamp"), c("capture_method").alias("capture_method"), F.coalesce(c("capture_status"), F.lit("indexed")).alias("evidence_status"),
        S.excerpt(body, 280).alias("body_preview"), F.sha2(body, 256).alias("body_sha256"), F.length(body).cast("long").alias("body_length_chars"),
        F.when(words == "", 0).otherwise(F.size(F.split(words, " "))).cast("long").alias("body_word_count"), lines.cast("long").alias("body_line_count"), F.lit("indexed").alias("status"),
    )


def last_captures(hits: DataFrame, captures: DataFrame, url: str, order: str) -> DataFrame:
    """Hits with the last capture of their canonical URL, if any. (JON-01)"""
    from leadlake.operators.keyed import keep_last

    last = keep_last(captures.withColumn("_key", U.canonical(F.col(url))), ["_key"], [F.col(order)]).select("_key", F.struct(*captures.columns).alias("capture"))
    return hits.withColumn("_key", U.canonical(F.col(url))).join(last, "_key", "left").drop("_key")


def evidence_text(items: DataFrame, stem: str, markdown: DataFrame, html: DataFrame) -> DataFrame:
    """Items with the text of their Markdown capture, else of their HTML capture; blank ones don't count. Both tables have ``stem`` and text. (JON-09)"""
    a = markdown.groupBy(stem).agg(F.min(F.nullif(F.trim("text"), F.lit(""))).alias("_md"))
    b = html.groupBy(stem).agg(F.min(F.nullif(S.strip_html(F.col("text")), F.lit(""))).alias("_html"))
    return items.join(a, stem, "left").join(b, stem, "left").withColumn("evidence", F.coalesce("_md", "_html")).drop("_md", "_html")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Columns in name order. (SNK-01, SNK-02)"""
    df.select(*sorted(df.columns)).write.mode(mode).json(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """The one JSON text of a run's summary. (SNK-06)"""
    summary.select("summary").coalesce(1).write.mode("overwrite").text(path)


def upserted(current: DataFrame, incoming: DataFrame, key: str, priority: Column, keep_old: Sequence[str] = ()) -> DataFrame:
    """``current`` after ``incoming``, whose best row per key replaces or joins it, with the action taken. Nulls overwrite,
    but for the columns ``keep_old``, where a null leaves the old value. (SNK-04, SNK-05)"""
    from leadlake.operators.keyed import keep_best

    best = keep_best(incoming, [key], [priority])
    joined = current.select(key, F.struct(*current.columns).alias("_old")).join(best.select(key, F.struct(*current.columns).alias("_new")), key, "full")
    action = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "kept").otherwise("updated")
    value = lambda c: F.coalesce(F.col(f"_new.{c}"), F.col(f"_old.{c}")) if c in keep_old else F.when(F.col("_new").isNull(), F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}"))
    return joined.select(key, *(value(c).alias(c) for c in current.columns if c != key), action.alias("action"))


def action_counts(upsert: DataFrame) -> DataFrame:
    """(SNK-04)"""
    return upsert.groupBy("action").agg(F.count("*").alias("n"))


def write_documents(df: DataFrame, path: str, header: Sequence[str], body: str, folders: Sequence[str], written: DataFrame | None = None) -> None:
    """Documents as text rows: a YAML header of the named columns, then the body, under one folder per value of ``folders``;
    each row is one document, parted by a form feed line. Rows whose record_id ``written`` has already are left out. (SNK-03)"""
    todo = df if written is None else df.join(written.select("record_id").distinct(), "record_id", "left_anti")
    quoted = lambda c: F.to_json(F.struct(F.col(c).alias("v")))
    lines = [F.concat(F.lit(f"{c}: "), F.coalesce(F.regexp_extract(quoted(c), r'(?s)^\{"v":(.*)\}$', 1), F.lit("null"))) for c in header]
    value = lambda line: F.when(F.endswith(line, F.lit(": ")), F.concat(line, F.lit("null"))).otherwise(line)
    document = F.concat(F.lit("---\n"), F.concat_ws("\n", *map(value, lines)), F.lit("\n---\n\n"), F.coalesce(body, F.lit("")))
    todo.select(*folders, document.alias("value")).write.mode("append").partitionBy(*folders).option("lineSep", "\n\f\n").text(path)


def read_documents(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """What ``write_documents`` wrote: the folders, the named fields as text, and the body."""
    return parsed_front_matter(spark.read.option("lineSep", "\n\f\n").text(path), fields)


def document_path(country: Column, region: Column, camp: Column, venue: Column, record: Column) -> Column:
    """(SNK-03)"""
    return F.concat(S.slug(country), F.lit("/"), S.slug(region), F.lit("/"), F.concat_ws("--", S.slug(camp), S.slug(venue), S.slug(record)), F.lit(".md"))


def index_text(df: DataFrame, group: str, title: str) -> DataFrame:
    """A Markdown list of titles per group, in order. (SNK-07)"""
    titles = F.array_sort(F.collect_list(title))
    return df.groupBy(group).agg(F.concat_ws("\n", F.concat(F.lit("# "), F.first(group)), F.array_join(F.transform(titles, lambda x: F.concat(F.lit("- "), x)), "\n")).alias("text"))


def root_index(df: DataFrame, group: str) -> DataFrame:
    """One text that lists the groups with their numbers of rows, in order. (SNK-07)"""
    lines = df.groupBy(group).agg(F.count("*").alias("n")).select(F.concat(F.lit("- "), F.col(group), F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("line"))
    return lines.agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("text"))
