"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.functions import text as tx
from broadsheet.functions import urls
from broadsheet.plans import views as v
from broadsheet.plans.catalog import query

EDGE_L, EDGE_R = r"(^|[^\p{L}\p{N}_])", r"([^\p{L}\p{N}_]|$)"
HOST = r"lower(regexp_extract(regexp_replace(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), '^([^:]*)', 1))"
SCHEME = r"lower(regexp_extract({0}, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1))"
USERINFO = r"regexp_matches(regexp_extract(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^(.*)@', 1), '[^:]')"
PATH = r"regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1)"


@query("clean_text", v.sql(v.V_ARTICLES, select="SELECT doc_id, clean_text, CAST(length(clean_text) AS BIGINT) AS clean_chars FROM v_articles"))
def clean_text(spark, sf):
    return v.articles(spark, sf, labels=False).select("doc_id", "clean_text", F.length("clean_text").cast("bigint").alias("clean_chars"))


@query("fingerprint", v.sql(v.V_ARTICLES, select="SELECT doc_id, fingerprint FROM v_articles"))
def fingerprint(spark, sf):
    return v.articles(spark, sf, labels=False).select("doc_id", "fingerprint")


@query("article_id", "SELECT page_id, sha256(url) AS article_id FROM pages")
def article_id(spark, sf):
    return v.pages(spark, sf).select("page_id", tx.article_id(F.col("url")).alias("article_id"))


@query("normalized_url", "SELECT page_id, rtrim(split_part(url, '#', 1), '/') AS normalized_url FROM pages")
def normalized_url(spark, sf):
    return v.pages(spark, sf).select("page_id", urls.normalized_url(F.col("url")).alias("normalized_url"))


@query("favorite_key", "SELECT page_id, sha256(split_part(url, '#', 1)) AS favorite_key FROM pages")
def favorite_key(spark, sf):
    return v.pages(spark, sf).select("page_id", urls.favorite_key(F.col("url")).alias("favorite_key"))


@query("detect_language", r"""
SELECT doc_id, CASE WHEN han >= 20 AND han * 5 >= latin THEN 'zh' ELSE 'en' END AS detected FROM (
  SELECT doc_id, length(regexp_replace(text, '[^\x{4E00}-\x{9FFF}]', '', 'g')) AS han,
         length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS latin FROM documents)""")
def detect_language(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", tx.detect_language(F.col("text")).alias("detected"))


CLASSES = ("ai", "employment", "education", "policy", "economy", "industry", "opportunities", "society", "infrastructure")


@query("classify", v.sql(v.V_BASE, select=
    "SELECT doc_id, category, CASE WHEN category IN ('employment','education','opportunities') THEN 'future_opportunities' "
    "WHEN category IN ('policy','economy','industry') THEN 'policy_economy' ELSE 'technology' END AS channel FROM ("
    "SELECT doc_id, CASE " + " ".join(
        f"WHEN regexp_matches(head, '(?i)({pattern})') THEN '{name}'" for name, pattern in fv.CATEGORY_RULES)
    + " ELSE 'ai' END AS category FROM (SELECT doc_id, title || ' ' || substr(raw_text, 1, 600) AS head FROM v_base))"))
def classify(spark, sf):
    head = F.concat("title", F.lit(" "), F.substring("raw_text", 1, 600))
    cats = F.array(*[F.lit(c) for c in CLASSES])
    chans = F.array(*[F.lit(c) for c in ("technology", "policy_economy", "future_opportunities")])
    df = v.articles(spark, sf, labels=False).select("doc_id", ru.category_of(head, cats).alias("category"))
    return df.select("*", ru.channel_of(F.col("category"), chans).alias("channel"))


# The SQL engine's word border only knows ASCII, so borders are spelled out over doubled separators.
VERSION_SQL = r"""
SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(
  regexp_replace(lower(text), '([^\p{L}\p{M}\p{N}_])', '\1\1', 'g'),
  '(?:^|[^\p{L}\p{M}\p{N}_])v?(\d+\.\.\d+)(?:\.\.\d+)?(?:$|[^\p{L}\p{M}\p{N}_])', 1), lambda x: replace(x, '..', '.')))), ',') AS versions
FROM documents"""


@query("version_set", VERSION_SQL)
def version_set(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", F.array_join(tx.version_set(F.col("text")), ",").alias("versions"))


@query("title_key", v.sql(v.V_BASE, select=r"SELECT doc_id, regexp_replace(replace(lower(title), 'ß', 'ss'), '[^\p{L}\p{N}_]', '', 'g') AS title_key FROM v_base"))
def title_key(spark, sf):
    return v.articles(spark, sf, labels=False).select("doc_id", tx.title_key(F.col("title")).alias("title_key"))


@query("release_series", r"""
SELECT doc_id, regexp_replace(lower(t), '(v?\d+\.\d+)\.\d+', '\1', 'g') AS series
FROM (SELECT doc_id, text || ' v' || (doc_id % 7) || '.' || (doc_id % 11) || '.' || (doc_id % 3) AS t FROM documents)""")
def release_series(spark, sf):
    doc = F.col("doc_id")
    title = F.concat(F.col("text"), F.lit(" v"), doc % 7, F.lit("."), doc % 11, F.lit("."), doc % 3)
    return v.table(spark, sf, "documents").select("doc_id", tx.release_series(title).alias("series"))


@query("redact", r"""
SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
  '(?i)(https?://)[^\s/@]+(?::[^\s/@]*)?@', '\1[REDACTED]@', 'g'),
  '(?i)(authorization\s*[:=]\s*)(?:bearer|basic)?\s*[^\r\n]+', '\1[REDACTED]', 'g'),
  '(?i)((?:access[_-]?token|token|username|password|passwd|secret|api[_-]?key)\s*[=:]\s*)[^\s&"'']+', '\1[REDACTED]', 'g'),
  '\b(?:gh[pousr]_[A-Za-z0-9_]+|github_pat_[A-Za-z0-9_]+)\b', '[REDACTED]', 'g')) AS redacted_hash FROM documents""")
def redact(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", F.sha2(tx.redact(F.col("text")), 256).alias("redacted_hash"))


# --- dates, scores, budget ------------------------------------------------------------
@query("parse_published", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso, strftime(CAST(ts AS DATE), '%Y-%m-%d %H:%M:%S') AS written FROM events")
def parse_published(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    written = F.date_format("ts", "MMMM d, yyyy")
    return v.table(spark, sf, "events").select(
        "event_id", F.date_format(ru.parse_published(iso), "yyyy-MM-dd HH:mm:ss").alias("iso"),
        F.date_format(ru.parse_published(written), "yyyy-MM-dd HH:mm:ss").alias("written"))


NOW_SQL = "TIMESTAMP '2024-01-20 06:00:00'"


def _now():
    return F.lit("2024-01-20 06:00:00").cast("timestamp")


@query("age", f"""
SELECT event_id, (epoch_us({NOW_SQL}) - epoch_us(ts)) / 3600000000::DOUBLE AS age_hours,
       (epoch_us({NOW_SQL}) - epoch_us(ts)) / 86400000000::DOUBLE AS age_days FROM events""")
def age(spark, sf):
    ts = F.col("ts")
    return v.table(spark, sf, "events").select("event_id", ru.age_hours(ts, _now()).alias("age_hours"),
                                               ru.age_days(ts, _now()).alias("age_days"))


DEEP_SQL = f"(regexp_matches(title, '(?i)({v.DEEP})') AND length(clean_text) >= 1500 AND source_tier <= 2)"
LEVEL_SQL = """CASE WHEN epoch_us({now}) - epoch_us(published_at) < -600000000 THEN NULL
  WHEN epoch_us({now}) - epoch_us(published_at) <= 86400000000 THEN CASE WHEN source_tier <= 2 THEN 1 ELSE 2 END
  WHEN epoch_us({now}) - epoch_us(published_at) <= 259200000000 THEN 3
  WHEN epoch_us({now}) - epoch_us(published_at) <= 604800000000 AND deep THEN 4 END"""


@query("deep_read", v.sql(v.V_ARTICLES, select=f"SELECT doc_id, {DEEP_SQL} AS deep FROM v_articles"))
def deep_read(spark, sf):
    return v.articles(spark, sf, labels=False).select("doc_id", ru.deep_read(
        F.col("title"), F.col("clean_text"), F.col("source_tier"), v.DEEP).alias("deep"))


@query("supply_level", v.sql(v.V_ARTICLES, select=f"""
SELECT doc_id, CAST({LEVEL_SQL.format(now=NOW_SQL)} AS INTEGER) AS supply_level FROM (SELECT *, {DEEP_SQL} AS deep FROM v_articles)"""))
def supply_level(spark, sf):
    deep = ru.deep_read(F.col("title"), F.col("clean_text"), F.col("source_tier"), v.DEEP)
    return v.articles(spark, sf, labels=False).select("doc_id", ru.supply_level(
        F.col("published_at"), F.col("source_tier"), deep, _now()).alias("supply_level"))


IMPORTANCE_SQL = f"COALESCE(importance, 60 + CASE WHEN regexp_matches(title, '(?i)({v.IMPACT})') THEN 15 ELSE 0 END)"
RANK_SQL = ("0.6::DOUBLE * imp + 0.2::DOUBLE * CASE source_tier WHEN 1 THEN 100 WHEN 2 THEN 85 WHEN 3 THEN 65 END + 10 "
            "+ 0.1::DOUBLE * CASE WHEN category IN ('ai','robotics') THEN 100 ELSE 0 END")


@query("importance", v.sql(v.V_BASE, select=f"SELECT doc_id, CAST({IMPORTANCE_SQL} AS INTEGER) AS imp FROM v_base"))
def importance(spark, sf):
    return v.articles(spark, sf).select("doc_id", ru.importance(F.col("importance"), F.col("title"), v.IMPACT).alias("imp"))


@query("rank_score", v.sql(v.V_BASE, select=f"SELECT doc_id, round({RANK_SQL}, 6) AS rank_score FROM (SELECT *, {IMPORTANCE_SQL} AS imp FROM v_base) WHERE source_tier <= 3"))
def rank_score(spark, sf):
    imp = ru.importance(F.col("importance"), F.col("title"), v.IMPACT)
    return v.articles(spark, sf).filter("source_tier <= 3").select("doc_id", F.round(ru.rank_score(
        imp, F.col("source_tier"), F.col("category")), 6).alias("rank_score"))


@query("local_report_date", "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_date FROM events")
def local_report_date(spark, sf):
    return v.table(spark, sf, "events").select("event_id", ru.local_date(F.col("ts")).cast("string").alias("local_date"))


@query("daily_mode", """
SELECT user_id, n, CASE WHEN n >= 10 THEN 'normal' WHEN n >= 5 THEN 'graceful_degraded' WHEN n >= 1 THEN 'minimal_daily' ELSE 'true_failure' END AS daily_mode
FROM (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY user_id)""")
def daily_mode(spark, sf):
    counts = v.table(spark, sf, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("n"))
    return counts.select("user_id", "n", ru.daily_mode(F.col("n")).alias("daily_mode"))


@query("estimate_tokens", """
SELECT doc_id, CAST(inp + out + greatest(256, ceil(inp * 0.1::DOUBLE)) AS BIGINT) AS required FROM (
  SELECT doc_id, greatest((n_chars + 2) // 3, CAST(ceil(n_chars / 2) AS BIGINT), CAST(ceil(n_chars * 0.3::DOUBLE) AS BIGINT)) AS inp,
         least(7200, greatest(1800, (7200 * (1 + doc_id % 12) + 11) // 12)) AS out FROM documents)""")
def estimate_tokens(spark, sf):
    members = 1 + F.col("doc_id") % 12
    return v.table(spark, sf, "documents").select("doc_id", ru.estimate_tokens(
        F.col("n_chars"), ru.output_allocation(members), F.lit(0.3)).alias("required"))


@query("output_allocation", "SELECT doc_id, CAST(least(7200, greatest(1800, (7200 * (1 + doc_id % 12) + 11) // 12)) AS BIGINT) AS output_tokens FROM documents")
def output_allocation(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", ru.output_allocation(1 + F.col("doc_id") % 12).alias("output_tokens"))


@query("validity_expired", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN TRUE ELSE o_orderdate + INTERVAL 10 YEAR <= TIMESTAMP '2010-06-01' END AS expired FROM orders""")
def validity_expired(spark, sf):
    end = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 10 YEARS"), "yyyy-MM-dd'T'HH:mm:ss")
    end = F.when(F.col("o_orderkey") % 3 == 0, end).otherwise(F.concat(end, F.lit("+00:00")))
    now = F.lit("2010-06-01 00:00:00").cast("timestamp")
    return v.table(spark, sf, "orders").select("o_orderkey", ru.validity_expired(end, now).alias("expired"))


@query("policy_evidence", r"""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN FALSE WHEN 1 THEN o_custkey % 3 <> 0 AND date_diff('second', o_orderdate, TIMESTAMP '1998-01-01') BETWEEN 0 AND 604800
  ELSE o_custkey % 3 <> 0 AND date_diff('second', o_orderdate, TIMESTAMP '1998-01-01') BETWEEN 0 AND 604800 AND o_orderkey % 4 <> 3 END AS evidence_ok FROM orders""")
def policy_evidence(spark, sf):
    kind = F.col("o_orderkey") % 4
    prior = {
        "policy_evidence_url": F.when(kind == 0, "http://example.com/x").when(kind == 1, "https://www.moe.gov.cn/x")
        .when(kind == 2, "https://example.com/y").otherwise("https://elsewhere.org/y"),
        "policy_checked_at": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
        "validity_start": F.lit(None).cast("string"),
        "policy_validity_evidence": F.when(F.col("o_custkey") % 3 == 0, "").otherwise("reviewed"),
    }
    now = F.lit("1998-01-01 00:00:00").cast("timestamp")
    ok = ru.policy_evidence_ok(prior, F.lit("https://example.com/item"), now)
    return v.table(spark, sf, "orders").select("o_orderkey", ok.alias("evidence_ok"))


@query("age_band", f"""
SELECT doc_id, CASE WHEN d <= 3 THEN '1-3d' WHEN d <= 7 THEN '3-7d' WHEN d <= 30 THEN '7-30d' ELSE '30-365d' END AS band
FROM (SELECT doc_id, (epoch_us(TIMESTAMP '2024-02-05') - epoch_us(published_at)) / 86400000000.0 AS d FROM v_base)""".replace("SELECT doc_id, CASE", "WITH " + v.V_BASE + " SELECT doc_id, CASE", 1))
def age_band(spark, sf):
    now = F.lit("2024-02-05 00:00:00").cast("timestamp")
    return v.articles(spark, sf, labels=False).select("doc_id", ru.age_band(ru.age_days(F.col("published_at"), now)).alias("band"))




@query("deep_evidence", r"""
SELECT doc_id, CASE WHEN len(kinds) >= 2 THEN array_to_string(list_sort(kinds), ',') ELSE '' END AS kinds FROM (
SELECT doc_id, CASE WHEN length(text) >= 1500 AND doc_id % 4 <= 1 THEN list_filter([
  CASE WHEN regexp_matches(text, '(?i)(works by|underlying mechanism|principles? of|工作原理|作用机制|推导过程)') THEN 'mechanism' END,
  CASE WHEN regexp_matches(text, '(?i)(methodology|implementation details|step.by.step|工程实践|实现步骤|具体方法)') THEN 'method' END,
  CASE WHEN regexp_matches(text, '(?i)(```|\bdef \w+\(|\bfunction \w+\(|pip install|代码示例)') THEN 'code' END,
  CASE WHEN regexp_matches(text, '(?i)(comparative analysis|experimental results|systematic review|实验结果|系统综述|对比分析)') THEN 'comparative_evidence' END,
  CASE WHEN len(list_distinct(regexp_extract_all(text, '(?i)(?:step|步骤)\s*(\d+|[一二三四])', 1))) >= 2 THEN 'procedural_steps' END],
  lambda k: k IS NOT NULL) ELSE [] END AS kinds FROM documents)""")
def deep_evidence(spark, sf):
    found = ru.deep_evidence(F.col("text"), 1 + F.col("doc_id") % 4)
    return v.table(spark, sf, "documents").select("doc_id", F.array_join(F.array_sort(F.map_keys(found)), ",").alias("kinds"))
