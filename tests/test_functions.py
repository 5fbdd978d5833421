import unicodedata

from pyspark.sql import functions as F

from leadlake import rules as R
from leadlake.functions import extract as X
from leadlake.functions import text as S
from leadlake.functions import url as U
from leadlake.functions import values as V


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("r")).first()["r"]


def test_canonical_url(spark):
    cases = {
        "HTTP://WWW.Example.com:80/a/b/?utm_source=x&b=2&a=1#top": "http://example.com/a/b?a=1&b=2",
        "https://example.org:443": "https://example.org/",
        "example.net/path/": "https://example.net/path",
        "https://m.example.net/?ref=x&page=2": "https://m.example.net/?page=2",
        "https://e.com/?q=a+b&t=~*": "https://e.com/?q=a+b&t=~%2A",
        "": "",
        None: "",
    }
    for raw, expected in cases.items():
        assert one(spark, raw, U.canonical(F.col("v"))) == expected


def test_slug_and_texts(spark):
    assert one(spark, "Été à Nîmes — øß!", S.slug(F.col("v"))) == "ete-a-nimes"
    assert one(spark, None, S.slug(F.col("v"))) == "unknown"
    assert one(spark, " a \n b ", S.compact(F.col("v"))) == "a b"
    assert one(spark, "<p>x<script>y</script>&amp; z</p>", S.strip_html(F.col("v"))) == "x& z"
    assert one(spark, "Sleep here overnight, really. No. Stay overnight in a dorm!", S.evidence_sentences(F.col("v"), "overnight")) == ["Sleep here overnight, really", "Stay overnight in a dorm"]


def test_fold_equals_decomposition(spark):
    letters = [chr(c) for c in [*range(0x80, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]]
    plain = lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode()
    single = "".join(x for x in letters if len(plain(x)) < 2)
    assert one(spark, single, S.ascii_fold(F.col("v"))) == plain(single)
    assert one(spark, "".join(letters), S.ascii_nfkd(F.col("v"))) == plain("".join(letters))
    assert one(spark, "Šípková Őrült Łódź ąę", S.slug(F.col("v"))) == "sipkova-orult-odz-ae"


def test_provisional_tags(spark):
    tags = F.array(F.lit("STEM"), F.lit("other"), F.lit("Overnight"), F.lit("3-week"), F.lit("2-week"))
    p = one(spark, "", X.provisional(tags))
    assert (p.families, p.types, tuple(p.duration)) == (["stem"], ["overnight"], ("3-week", 21, 21))
    assert one(spark, "", X.provisional(F.lit(None).cast("array<string>"))).duration is None


def test_texts_without_a_value(spark):
    c = one(spark, None, X.contact(F.col("v")))
    assert (c.email, c.phone, c.status) == (None, None, "missing")
    assert one(spark, None, X.pricing(F.col("v"))) is None
    p = one(spark, None, X.page_profile(F.col("v")))
    assert p is None or (p.contact.email is None and not p.signals)


def test_duration_chain(spark):
    for text, expected in {"one-week-plus": ("one-week-plus", 7, None), "A 3-week stay": ("3-week", 21, 21), "two week": ("two-week", 14, 14), "a week": ("week-based", 7, None), "": ("unknown", None, None)}.items():
        assert tuple(one(spark, text, X.duration(F.col("v")))) == expected


def test_tags_keep_order_and_default(spark):
    assert one(spark, "Music and robotics band", X.tags(F.col("v"), R.FAMILIES)) == ["stem", "music"]
    assert one(spark, None, X.tags(F.col("v"), R.FAMILIES)) == ["unspecified"]
    whole = R.TagRules((("band", "music"),), None, True)
    assert one(spark, "husband", X.tags(F.col("v"), whole)) == []


def test_prices_ages_contacts(spark):
    p = one(spark, "Tuition: CA$1,200 to CA$ 2,500 in 2026, meals included", X.pricing(F.col("v")))
    assert (p.currency, p.amount_min, p.amount_max, p.boarding_included) == ("CAD", 1200.0, 2500.0, True)
    assert one(spark, "costs nothing", X.pricing(F.col("v"))) is None
    a = one(spark, "Ages 8-12 and ages 14 to 17; 3rd through 9th grade", X.ages_and_grades(F.col("v")))
    assert tuple(a) == (8, 17, 3, 9)
    c = one(spark, "noreply@x.org info@camp.org call (555) 123-4567", X.contact(F.col("v")))
    assert (c.email, c.phone, c.status) == ("info@camp.org", "(555) 123-4567", "found")


def test_json_and_lists(spark):
    assert one(spark, '[" A ", "", "b"]', V.json_list(F.col("v"))) == ["a", "b"]
    assert one(spark, "not json", V.json_list(F.col("v"))) == []
    assert one(spark, 'x {"a": {"b": 1}} y', V.embedded_object(F.col("v"))) == '{"a": {"b": 1}}'
    assert one(spark, "12.7", V.safe_int(F.col("v"), 0, 20)) == 12
    assert one(spark, "99", V.safe_int(F.col("v"), 0, 20)) is None
