"""URL filters with DataFrame functions only: a blocked Bloom filter, then an exact hash join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm.session import materialise

BLOCK_BITS = 512
WORD_BITS = 64
HASHES = 6
BITS_PER_KEY = 16
#: Largest filter that is broadcast; beyond it candidate keys are joined with the filter's blocks by block number.
BROADCAST_FILTER_BYTES = 64 << 20
#: Rules are probed by at most so much of their path, then compared whole; the number of distinct probe lengths is bounded by it.
MAX_RULE_PATH = 4096

RULES_SCHEMA = "rule_host string, rule_path string, rule_verdict string"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty for null or without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def key_of(host: Column, path: Column) -> Column:
    return F.concat(host, path)  # a host has no slash and a path starts with one or is empty


def block_of(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def bits_of(key: Column) -> list[Column]:
    """Bit positions inside a block, from nine bits each of a second hash."""
    second = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(second, 9 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(HASHES)]


def masks_of(key: Column) -> list[Column]:
    """What each 64-bit word of the block must hold for the key."""
    bits = bits_of(key)
    words = []
    for w in range(BLOCK_BITS // WORD_BITS):
        mask = F.lit(0).cast("long")
        for b in bits:
            one = F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(F.lit(WORD_BITS - 1)))
            mask = mask.bitwiseOR(F.when(F.shiftright(b, 6) == w, one).otherwise(F.lit(0).cast("long")))
        words.append(mask)
    return words


def bloom(rules: DataFrame, n_blocks: int) -> DataFrame:
    """block, w0..w7: the filter's blocks that have a bit set."""
    key = key_of(F.col("rule_host"), F.col("probe"))
    masked = rules.select(block_of(key, n_blocks).alias("block"), *(m.alias(f"w{i}") for i, m in enumerate(masks_of(key))))
    return masked.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(BLOCK_BITS // WORD_BITS)))


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` plus host, path, rule (host and path of the rule, else null) and verdict, replacing columns of those names.

    ``rules`` has rule_host, rule_path (empty or starting with /) and rule_verdict; a rule fits its host and all
    subdomains if the path starts with its path. The longest fitting rule wins (host and path counted together; a url's
    fitting rules of one length differ only in host, of which the longer wins). Rules with a null part are ignored; of
    rules with the same host and path "block" outweighs "allow". A null url or one without :// has empty host and path
    and no rule. Repeated rows get a result each; extra columns pass through; an empty table gives an empty table.

    Every distinct (host, path) makes keys from its parent domains and its path prefixes of the lengths that rules have (of a path
    over MAX_RULE_PATH its start). The filter drops nearly all keys without a rule on the spot; only the rest meets the
    rules in an exact hash join, which compares whole paths, and only what has a rule is joined back to the pages.
    """
    new = ("host", "path", "rule", "verdict")
    usable = rules.select("rule_host", "rule_path", "rule_verdict").dropna().filter(F.col("rule_path").startswith("/") | (F.col("rule_path") == ""))
    usable = usable.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    usable = materialise(usable.withColumn("probe", F.substring("rule_path", 1, MAX_RULE_PATH)), "url-rules")
    n_rules = usable.count()
    lengths = sorted(r[0] for r in usable.select(F.length("probe")).distinct().collect())  # at most MAX_RULE_PATH + 1
    n_blocks = max(1, math.ceil(n_rules * BITS_PER_KEY / BLOCK_BITS))
    blocks = materialise(bloom(usable, n_blocks), "url-bloom")
    if n_blocks * BLOCK_BITS // 8 <= BROADCAST_FILTER_BYTES:
        blocks = F.broadcast(blocks)

    kept = [c for c in pages.columns if c not in new]
    url = pages[f"`{url_col}`"].cast("string")
    own = pages.select(F.struct(*(pages[f"`{c}`"] for c in kept)).alias("_row"), host_of(url).alias("_host"), path_of(url).alias("_path"))
    places = own.filter(F.col("_host") != "").select("_host", "_path").distinct()
    fitting = F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= F.length("_path"))
    keys = F.flatten(F.transform(suffixes(F.col("_host")), lambda h: F.transform(fitting, lambda n: F.struct(h.alias("h"), F.substring(F.col("_path"), F.lit(1), n).alias("p")))))
    keyed = places.withColumn("_key", F.explode(keys))
    key = key_of(F.col("_key.h"), F.col("_key.p"))
    hit = F.lit(True)
    for i, m in enumerate(masks_of(key)):
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) == m)
    possible = keyed.withColumn("_block", block_of(key, n_blocks)).join(blocks, F.col("_block") == F.col("block")).filter(hit).select("_host", "_path", "_key")
    exact = possible.join(usable, (F.col("_key.h") == F.col("rule_host")) & (F.col("_key.p") == F.col("probe")) & F.startswith("_path", "rule_path"))
    size = F.length("rule_host") + F.length("rule_path")
    best = F.max(F.struct(size.alias("n"), F.length("rule_host").alias("m"), F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")))
    judged = exact.groupBy(F.col("_host").alias("_h"), F.col("_path").alias("_p")).agg(best.alias("_best"))
    judged = materialise(judged, "url-judged")  # with a plain exchange on both sides a common url can be split; it grows with the pages, so it is not broadcast
    out = own.join(judged.hint("merge"), (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p")), "left")
    return out.select("_row.*", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_best.rule").alias("rule"), F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"))


#: The rules that every page is judged by.
PRODUCTION_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def production_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCTION_RULES, RULES_SCHEMA)


SQL = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
f AS (SELECT *, '.' || host AS h FROM p)
SELECT page_id, host, path,
  CASE WHEN ends_with(h, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
       WHEN ends_with(h, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
       WHEN ends_with(h, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
       WHEN ends_with(h, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
       WHEN ends_with(h, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
  CASE WHEN ends_with(h, '.www.example.com') AND starts_with(path, '/en/') THEN 'allow'
       WHEN ends_with(h, '.example.com') AND starts_with(path, '/en/') THEN 'block'
       WHEN ends_with(h, '.net') AND starts_with(path, '/es/') THEN 'block'
       WHEN ends_with(h, '.net') AND starts_with(path, '/fr/') THEN 'block'
       ELSE 'allow' END AS verdict FROM f
"""
