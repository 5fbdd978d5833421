"""URLs: canonical form, host, host lists, tokens, redirect unwrapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadlake.functions.text import bound, slug
from leadlake.rules import TRACKING_KEYS, TRACKING_PREFIXES

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def with_scheme(url: Column) -> Column:
    return bound(F.trim(F.coalesce(url, F.lit(""))), lambda t: F.when(F.rlike(t, F.lit(SCHEME)), t).when(t != "", F.concat(F.lit("https://"), F.regexp_replace(t, "^//", ""))).otherwise(""))


def decoded(part: Column) -> Column:
    plus = F.replace(part, F.lit("+"), F.lit(" "))
    return F.coalesce(F.try_url_decode(part), plus)


def encoded(part: Column) -> Column:
    return F.replace(F.replace(F.url_encode(part), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def canonical(url: Column, tracking: Sequence[str] = TRACKING_KEYS, prefixes: Sequence[str] = TRACKING_PREFIXES) -> Column:
    """https by default, lower scheme and host, no www. or default port, no trailing slash but the root's, no tracking
    parameters, the others sorted, no fragment; blank gives empty. (URL-01)"""
    part = lambda whole, pattern: F.regexp_extract(whole, pattern, 1)
    parts = lambda whole: F.struct(
        F.lower(part(whole, r"^([^:]+)://")).alias("scheme"), F.regexp_replace(F.lower(part(whole, r"^[^:]+://([^/?#]*)")), r"^www\.", "").alias("host"),
        part(whole, r"^[^:]+://[^/?#]*([^?#]*)").alias("path"), part(whole, r"^[^?#]*\?([^#]*)").alias("query"),
    )

    def text(x: Column) -> Column:
        host = F.when(x["scheme"] == "http", F.regexp_replace(x["host"], ":80$", "")).when(x["scheme"] == "https", F.regexp_replace(x["host"], ":443$", "")).otherwise(x["host"])
        path = F.when((x["path"] == "") | (x["path"] == "/"), "/").otherwise(F.regexp_replace(x["path"], "/+$", ""))
        pairs = F.transform(F.filter(F.split(x["query"], "&"), lambda p: p != ""), pair_of)
        kept = F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*tracking) & ~has_prefix(F.lower(p["k"]), prefixes))
        query = F.array_join(F.transform(F.sort_array(kept), lambda p: F.concat(encoded(p["k"]), F.lit("="), encoded(p["v"]))), "&")
        return F.regexp_replace(F.concat(x["scheme"], F.lit("://"), host, path, F.lit("?"), query), r"\?$", "")  # no query, no mark

    return bound(with_scheme(url), lambda whole: F.when(whole == "", "").otherwise(bound(parts(whole), text)))  # every part is matched once


def pair_of(parameter: Column) -> Column:
    key = F.substring_index(parameter, "=", 1)
    value = F.when(F.contains(parameter, F.lit("=")), F.substring(parameter, F.length(key) + 2, F.length(parameter))).otherwise("")
    return F.struct(decoded(key).alias("k"), decoded(value).alias("v"))


def has_prefix(v: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(v, F.lit(p))
    return out


def host(url: Column) -> Column:
    """Lower-case host with its port; empty if there is no scheme. (URL-02)"""
    return F.lower(F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def host_matches(hosts: Column, patterns: Sequence[str]) -> Column:
    """Whether the host is one of the patterns or below one. (URL-03)"""
    out = F.lit(False)
    for p in patterns:
        out = out | (hosts == p) | F.endswith(hosts, F.lit("." + p))
    return out


def allowed(hosts: Column, allow: Sequence[str] = (), deny: Sequence[str] = ()) -> Column:
    """Deny wins; an empty allow list allows every host; an empty host is denied. (FLT-05)"""
    return (hosts != "") & ~host_matches(hosts, deny) & (host_matches(hosts, allow) if allow else F.lit(True))


def token(url: Column, n: int = 10) -> Column:
    """First hash characters of the canonical form. (URL-04)"""
    return F.substring(F.sha2(canonical(url), 256), 1, n)


def capture_stem(url: Column) -> Column:
    """Host slug, slug of the last path part and token. (URL-04)"""
    clean = canonical(url)
    leaf = F.regexp_extract(F.regexp_extract(clean, r"^[^:]+://[^/?#]*([^?#]*)", 1), r"([^/]*)/*$", 1)
    return F.concat_ws("--", slug(host(clean)), slug(leaf, "root"), token(url))


def distinct_urls(*urls: Column) -> Column:
    """Distinct non-blank URLs in order, without trailing slashes. (URL-05)"""
    return F.array_distinct(F.filter(F.transform(F.array(*urls), lambda u: F.regexp_replace(F.trim(u), "/+$", "")), lambda u: u.isNotNull() & (u != "")))


def unwrapped(href: Column, parameter: str = "uddg") -> Column:
    """The decoded target of a redirect link, else the link itself. (URL-06)"""
    inner = F.regexp_extract(href, rf"[?&]{parameter}=([^&#]*)", 1)
    return F.when(inner != "", decoded(inner)).otherwise(href)
