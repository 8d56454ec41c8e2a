"""Text, URL, date and score functions on hand-written rows."""

import datetime as dt

from pyspark.sql import functions as F

from broadsheet.functions import rules as ru
from broadsheet.functions import text as tx
from broadsheet.functions import urls
from broadsheet.operators import dedup as dd


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def value(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t")).alias("x")).first()[0]


def test_clean_text(spark):
    assert value(spark, " one\n\n two three ", tx.clean_text) == "one two three"
    assert value(spark, "a &amp;lt; b &copy;", tx.clean_text) == "a &lt; b ©"
    assert value(spark, "x" * 100, lambda c: tx.clean_text(c, 12)) == "x" * 12
    words = " ".join(f"w{n}" for n in range(18))
    assert value(spark, f"{words} {words} tail", tx.clean_text) == f"{words} tail"
    assert value(spark, "a a a", tx.clean_text) == "a a a"


def test_fingerprint_ignores_spacing(spark):
    a = one(spark, tx.fingerprint(F.lit("A title"), F.lit("one two")))
    assert a == one(spark, tx.fingerprint(F.lit(" A   title "), F.lit("one  two")))


def test_language(spark):
    assert value(spark, "A detailed English report. " * 30 + "中文导航", tx.detect_language) == "en"
    assert value(spark, "这是中文人工智能新闻正文。" * 30 + "AI API", tx.detect_language) == "zh"


def test_dates(spark):
    cases = {
        "Sun, 14 Sep 2026 10:00:00 +0800": dt.datetime(2026, 9, 14, 2), "2026-09-14": dt.datetime(2026, 9, 14),
        "2026-09-14T01:02:03Z": dt.datetime(2026, 9, 14, 1, 2, 3), "Sep 5, 2026": dt.datetime(2026, 9, 5),
        "September 5, 2026": dt.datetime(2026, 9, 5), "5 September 2026": dt.datetime(2026, 9, 5), "soon": None, "junk 12": None}
    for text, want in cases.items():
        got = value(spark, text, lambda c: F.date_format(ru.parse_published(c), "yyyy-MM-dd HH:mm:ss"))
        assert got == (want.strftime("%Y-%m-%d %H:%M:%S") if want else None), text
    got = value(spark, "News September 10, 2026 Introducing", lambda c: ru.index_title_date(c).cast("string"))
    assert got.startswith("2026-09-10")


def test_urls(spark):
    assert value(spark, "https://a:b@Ex.com:80/p?q#f", urls.host) == "ex.com"
    assert not value(spark, "https://a:b@example.com/", urls.safe_url)
    assert not value(spark, "https://x.github.com/", urls.safe_url)
    assert value(spark, "https://sub.example.com/x", lambda c: urls.safe_url(c, ("example.com",)))
    assert not value(spark, "https://notexample.com/x", lambda c: urls.safe_url(c, ("example.com",)))
    assert value(spark, "https://e.com/a/#x", urls.normalized_url) == "https://e.com/a"
    df = spark.createDataFrame([("http://e.com/n/", "../a//b/./")], "base string, href string")
    assert urls.normalize_index_url(df, "base", "href", ("e.com",)).first()["url"] == "https://e.com/a/b/"


def test_topic_and_category(spark):
    for text in ("battery energy storage", "biotech materials research", "量子计算", "生物医疗"):
        assert value(spark, text, ru.on_topic)
    assert not value(spark, "AI新闻无关", lambda c: tx.matches(c, tx.bounded("ai")))
    cats = F.array(*[F.lit(c) for c in ("policy", "economy", "industry", "education", "employment", "opportunities")])
    chans = F.array(F.lit("policy_economy"), F.lit("future_opportunities"))
    for title, want in (("高校毕业生就业支持政策", ("employment", "future_opportunities")), ("制造业投资增长规划", ("policy", "policy_economy"))):
        category = value(spark, title, lambda c: ru.category_of(c, cats))
        assert (category, one(spark, ru.channel_of(F.lit(category), chans))) == want


def test_redaction(spark):
    assert value(spark, "https://user:pw@h.com/x?token=abc", tx.redact) == "https://[REDACTED]@h.com/x?token=[REDACTED]"
    assert value(spark, "Authorization: Bearer abc", tx.redact) == "Authorization: [REDACTED]"
    assert "ghp_" not in value(spark, "see ghp_abcDEF123", tx.redact)


def test_release_burst_keeps_newest(spark):
    rows = [("a", "Release v1.2.3", "official_changelog", "SDK", dt.datetime(2026, 9, 14, 1)),
            ("b", "Release v1.2.4", "official_changelog", "SDK", dt.datetime(2026, 9, 14, 2)),
            ("c", "Release v1.3.0", "official_changelog", "SDK", dt.datetime(2026, 9, 14, 1)),
            ("d", "Release v1.2.3", "official_blog", "SDK", dt.datetime(2026, 9, 14, 1))]
    df = spark.createDataFrame(rows, "id string, title string, source_type string, source string, published_at timestamp")
    assert sorted(r.id for r in dd.collapse_release_bursts(df).collect()) == ["b", "c", "d"]


def test_levels(spark):
    now = F.lit("2026-09-20 00:00:00").cast("timestamp")
    for hours, tier, deep, want in ((1, 1, False, 1), (1, 3, False, 2), (48, 1, False, 3), (120, 1, True, 4), (120, 1, False, None),
                                    (169, 1, True, None), (-2, 1, False, None)):
        ts = now - F.make_dt_interval(hours=F.lit(hours))
        assert one(spark, ru.supply_level(ts, F.lit(tier), F.lit(deep), now)) == want


def test_deep_evidence(spark):
    body = "This explains the underlying mechanism and implementation details with a step-by-step method. " * 25
    assert set(value(spark, body, lambda c: ru.deep_evidence(c, F.lit(1)))) == {"mechanism", "method"}
    assert value(spark, body, lambda c: ru.deep_evidence(c, F.lit(3))) == {}
    assert value(spark, "research " * 1000, lambda c: ru.deep_evidence(c, F.lit(1))) == {}


def test_unique_urls_last_value_first_place(spark):
    df = spark.createDataFrame([("u", 1, "old"), ("w", 2, "x"), ("u", 3, "new")], "url string, seq long, v string")
    got = {r.url: (r.v, r.first_seq) for r in dd.unique_urls(df, "url", "seq").collect()}
    assert got == {"u": ("new", 1), "w": ("x", 2)}
