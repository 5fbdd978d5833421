"""Parts of a text, URL or id that are made once per row, with the same results on odd values."""

import re

from pyspark.sql import functions as F

from leadlake.functions import extract as X
from leadlake.functions import url as U
from leadlake.functions.text import compact, slug


def patterns(df) -> int:
    """How many pattern searches a row of ``df`` may cost, as its plan tells."""
    return len(re.findall("regexp_replace\\(|regexp_extract\\(|rlike\\(", df._jdf.queryExecution().optimizedPlan().toString().lower()))


def test_url_and_candidate_id_make_their_parts_once(spark):
    df = spark.createDataFrame([("US", "R", "Town", "Name", "Hall", "https://e.org/a", False)], "country string, region string, city string, name string, venue string, url string, multi boolean")
    url = U.canonical(F.col("url"))
    assert patterns(df.select(url.alias("out"))) <= 12
    made = X.candidate_id(*(F.col(c) for c in ("country", "region", "city", "name", "venue")), U.host(url), F.col("multi"))
    assert patterns(df.select(made.alias("out"))) <= 40


def test_candidate_ids_of_missing_places(spark):
    rows = [
        ("US", "R x", None, "N", None, "e.org:80", False, "cand-us-r-x-unknown-city-n-pending-venue-e-org-80"), ("US", "R", "", "N", "", None, True, "cand-us-r-multi-site-n-multi-site"),
        ("US", "R", "Ünö--", "N", "Unknown", "h", False, "cand-us-r-uno-n-unknown-h"), ("US", "R", "!", "-", "??", "", False, "cand-us-r-unknown-unknown"), ("US", None, "C", "N", "pending venue", "日", False, "cand-us-c-n-pending-venue-unknown"),
        ("US", "R", "C", "N", "V", "h", None, "cand-us-r-c-n-v"),
    ]
    df = spark.createDataFrame(rows, "country string, region string, city string, name string, venue string, host string, multi boolean, expected string")
    got = df.withColumn("got", X.candidate_id(*(F.col(c) for c in ("country", "region", "city", "name", "venue", "host", "multi")))).collect()
    assert [r.got for r in got] == [r.expected for r in got]


def test_blanks_and_dashes_of_odd_texts(spark):
    texts = [None, "", " ", "\t", " a", "a  b", "a\tb", "a \n b\r\n", "\x0b\x0ca \x1c b   ", "--a--b-", "-", "a - b", "É-"]
    got = spark.createDataFrame([(t,) for t in texts], "v string").coalesce(1).select("v", compact(F.col("v")).alias("c"), slug(F.col("v")).alias("s")).collect()
    assert [r.c for r in got] == [re.sub("[ \t\n\x0b\f\r]+", " ", t or "").strip(" ") for t in texts]
    assert [r.s for r in got] == ["unknown"] * 4 + ["a", "a-b", "a-b", "a-b", "a-b", "a-b", "unknown", "a-b", "e"]


def test_durations_basis_and_urls_of_odd_texts(spark):
    texts = {None: "unknown", "": "unknown", "Week": "week-based", "one week or longer": "one-week-plus", "MULTI-WEEK": "multi-week", "10 weeks": "10-week", "99999999999-week": None, "six-week": "six-week", "tone week": "week-based", "3 day": "unknown"}
    got = spark.createDataFrame([(t,) for t in texts], "v string").coalesce(1).select(X.duration(F.col("v"))["label"]).collect()
    assert [r[0] for r in got] == list(texts.values())
    rows = [(None, None, None), ("Hall", None, "C"), ("Hall", "pending", "C"), ("Various halls", None, None), ("Hall", "Multi-Site", "C"), ("UNKNOWN ", "x", "C"), ("Hall", "", ""), ("to be", "confirmed", "C")]
    kinds = spark.createDataFrame(rows, "v string, u string, c string").coalesce(1).select(X.record_basis(*map(F.col, "vuc"))).collect()
    pending, many = "venue_candidate_pending_confirmation", "multi_venue_candidate"
    assert [r[0] for r in kinds] == [pending, "venue_candidate", pending, many, many, pending, pending, pending]
    urls = {None: "", " ": "", "//E.org//": "https://e.org", "e.org": "https://e.org/", "HTTP://www.e.org:80/a/?b=2&&a=%20&utm_x=1#f": "http://e.org/a?a=+&b=2", "https://e.org:443?REF=1": "https://e.org/"}
    made = spark.createDataFrame([(t,) for t in urls], "v string").coalesce(1).select(U.canonical(F.col("v"))).collect()
    assert [r[0] for r in made] == list(urls.values())
