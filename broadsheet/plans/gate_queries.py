"""Predicates, gates and constraint checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.functions import urls
from broadsheet.operators import admission as ad
from broadsheet.plans import views as v
from broadsheet.plans.catalog import query
from broadsheet.plans.text_queries import HOST, NOW_SQL, PATH, SCHEME, USERINFO, _now

WORD_L, WORD_R = r"(^|[^\p{L}\p{N}_])", r"([^\p{L}\p{N}_]|$)"


def word_sql(expr: str, words: str) -> str:
    return f"regexp_matches({expr}, '(?i){WORD_L}({words}){WORD_R}')"


def topic_sql(expr: str) -> str:
    return f"({word_sql(expr, fv.TOPIC_WORDS)} OR regexp_matches({expr}, '(?i)({fv.TOPIC_STEMS}|{fv.WIDE_TOPIC_STEMS})'))"


@query("in_window", f"SELECT event_id, ts BETWEEN {NOW_SQL} - INTERVAL 72 HOUR AND {NOW_SQL} + INTERVAL 10 MINUTE AS inside FROM events")
def in_window(spark, sf):
    return v.table(spark, sf, "events").select("event_id", ru.in_window(F.col("ts"), _now(), 72).alias("inside"))


@query("topic_filter", f"SELECT doc_id FROM documents WHERE {topic_sql('text')}")
def topic_filter(spark, sf):
    return v.table(spark, sf, "documents").filter(ru.on_topic(F.col("text"))).select("doc_id")


@query("topic_filter_terms", f"SELECT doc_id FROM documents WHERE {word_sql('text', v.TOPIC)}")
def topic_filter_terms(spark, sf):
    return v.table(spark, sf, "documents").filter(ru.on_topic(F.col("text"), v.TOPIC, "")).select("doc_id")


@query("blocked_terms", f"SELECT doc_id, {word_sql('text', fv.BLOCKED_WORDS)} AS blocked FROM documents")
def blocked_terms(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", ru.blocked_terms(F.col("text")).alias("blocked"))


PAGE_HOSTS = ("example.com", "example.org")


@query("blocked_host", f"""
SELECT page_id, host, host = 'github.com' OR ends_with(host, '.github.com') OR host = 'openai.com' OR ends_with(host, '.openai.com') AS blocked,
       host = 'example.com' OR ends_with(host, '.example.com') OR host = 'example.org' OR ends_with(host, '.example.org') AS allowed
FROM (SELECT page_id, {HOST.format('url')} AS host FROM pages)""")
def blocked_host(spark, sf):
    host = urls.host(F.col("url"))
    return v.pages(spark, sf).select("page_id", host.alias("host"), urls.blocked_host(host).alias("blocked"),
                                     urls.host_in(host, PAGE_HOSTS).alias("allowed"))


@query("safe_url", f"""
SELECT page_id, {SCHEME.format('url')} = 'https' AND host <> '' AND NOT {USERINFO.format('url')}
  AND (host = 'example.com' OR ends_with(host, '.example.com') OR host = 'example.org' OR ends_with(host, '.example.org')) AS safe
FROM (SELECT page_id, url, {HOST.format('url')} AS host FROM pages)""")
def safe_url(spark, sf):
    return v.pages(spark, sf).select("page_id", urls.safe_url(F.col("url"), PAGE_HOSTS).alias("safe"))


SCAN_SQL = "title || ' ' || substr(clean_text, 1, 3000)"


@query("admit_article", v.sql(v.V_ARTICLES, select=f"""
SELECT doc_id, CASE WHEN source_role = 'discovery' THEN 'discovery_source' WHEN published_at IS NULL THEN 'missing_publish_time'
  WHEN clean_text = '' THEN 'missing_content' WHEN length(clean_text) < 120 THEN 'content_shorter_than_120'
  WHEN {word_sql(SCAN_SQL, fv.BLOCKED_WORDS)} THEN 'blocked_content_terms'
  WHEN NOT {word_sql(SCAN_SQL, 'the|est')} THEN 'radar_terms_absent' END AS reject_reason FROM v_articles"""))
def admit_article(spark, sf):
    topic = ru.on_topic(ru.scan_text(F.col("title"), F.col("clean_text")), "the|est", "")
    return ad.admit_article(v.articles(spark, sf, labels=False), topic).select("doc_id", "reject_reason")


GATE_SQL = f"""CASE WHEN verification_status <> 'source_verified' THEN 'source_not_verified'
  WHEN category NOT IN ({','.join(f"'{c}'" for c in fv.CATEGORIES)}) THEN 'category_not_supported'
  WHEN source_tier > 3 THEN 'tier_above_3' WHEN source_role = 'discovery' THEN 'discovery_source'
  WHEN {SCHEME.format('original_url')} <> 'https' OR {HOST.format('original_url')} = '' THEN 'non_https_or_host_missing'
  WHEN lower(rtrim({PATH.format('original_url')}, '/')) IN ('', '/research', '/news', '/about', '/newsroom', '/en/news') THEN 'index_page'
  WHEN {word_sql(SCAN_SQL, fv.BLOCKED_WORDS)} THEN 'blocked_content_terms' END"""


@query("content_gate", v.sql(v.V_ARTICLES, select=f"SELECT doc_id, {GATE_SQL} AS gate_reason FROM v_articles"))
def content_gate(spark, sf):
    return ad.content_gate(v.articles(spark, sf, labels=False)).select("doc_id", "gate_reason")


@query("index_page_gate", f"""
SELECT page_id, CASE WHEN {SCHEME.format('url')} <> 'https' OR {HOST.format('url')} = '' THEN 'non_https_or_host_missing'
  WHEN lower(rtrim({PATH.format('url')}, '/')) IN ('', '/research', '/news', '/about', '/newsroom', '/en/news') THEN 'index_page' END AS gate_reason FROM pages""")
def index_page_gate(spark, sf):
    page = v.pages(spark, sf).select(
        "page_id", F.col("url").alias("original_url"), F.lit("source_verified").alias("verification_status"),
        F.lit("ai").alias("category"), F.lit(1).alias("source_tier"), F.lit("primary").alias("source_role"),
        F.lit("").alias("title"), F.lit("").alias("clean_text"))
    return ad.content_gate(page).select("page_id", "gate_reason")


@query("editorial_candidate", v.sql(v.V_BASE, select=f"SELECT doc_id FROM v_base WHERE NOT regexp_matches(title, '(?i)({fv.LOW_VALUE_TITLE})')"))
def editorial_candidate(spark, sf):
    return v.articles(spark, sf, labels=False).filter(ru.editorial_candidate(F.col("title"))).select("doc_id")


@query("importance_floor", v.sql(v.V_BASE, select="SELECT doc_id, importance FROM v_base WHERE importance IS NULL OR importance >= 60"))
def importance_floor(spark, sf):
    return ad.cap_enriched_importance(v.articles(spark, sf)).select("doc_id", "importance")


@query("short_lived", f"SELECT doc_id, regexp_matches(text, '(?i)({fv.SHORT_LIVED})') AS short_lived FROM documents")
def short_lived(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", ru.short_lived(F.col("text")).alias("short_lived"))


@query("purge_hosts", f"""
SELECT page_id, url FROM (SELECT page_id, url, {HOST.format('url')} AS host FROM pages)
WHERE NOT (host = 'example.net' OR ends_with(host, '.example.net'))""")
def purge_hosts(spark, sf):
    return ad.purge_hosts(v.pages(spark, sf), ("example.net",), "url").select("page_id", "url")


@query("registry_violations", v.sql(v.V_SOURCES, select="""
SELECT source_id, unnest(list_filter([CASE WHEN tier = 4 THEN 'tier_1_to_3' END, CASE WHEN region IN ('CHINA','JAPAN') THEN 'region_allowed' END,
  CASE WHEN NOT regexp_matches(name, '^Supplier') THEN 'name_pattern' END], lambda r: r IS NOT NULL)) AS rule FROM v_sources"""))
def registry_violations(spark, sf):
    return ad.violations(v.sources(spark, sf), ["source_id"], [
        ("tier_1_to_3", F.col("tier").between(1, 3)), ("region_allowed", ~F.col("region").isin("CHINA", "JAPAN")),
        ("name_pattern", F.col("name").rlike("^Supplier"))])


@query("duplicate_keys", "SELECT l_orderkey, 'unique_key' AS rule FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return ad.unique_violations(v.table(spark, sf, "lineitem"), "l_orderkey")


ITEM_TEXTS = ("title_cn", "title_en", "title_original", "what_happened", "what_happened_en", "why_it_matters", "why_it_matters_en")


@query("edition_item_checks", v.sql(v.V_BASE, v.V_ENRICHMENTS, select=f"""
SELECT doc_id, unnest(list_filter([
  {', '.join(f"CASE WHEN length(trim({c})) = 0 THEN 'missing_{c}' END" for c in ('title_cn', 'title_original', 'source', 'category', 'what_happened', 'why_it_matters', 'title_en', 'what_happened_en', 'why_it_matters_en'))},
  CASE WHEN doc_id % 2 = 1 THEN 'published_at_zone' END,
  CASE WHEN importance_score + doc_id % 20 > 100 THEN 'importance_score' END,
  CASE WHEN doc_id % 9 = 0 THEN 'original_language' END,
  CASE WHEN {word_sql("concat_ws(chr(10), " + ', '.join(ITEM_TEXTS) + ", source, category, original_url)", fv.BLOCKED_WORDS)} THEN 'blocked_terms' END],
  lambda r: r IS NOT NULL)) AS rule FROM v_enrichments"""))
def edition_item_checks(spark, sf):
    doc = F.col("doc_id")
    stamp = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss")
    items = v.enrichments(spark, sf).select(
        "doc_id", *ITEM_TEXTS, "source", "category", "original_url",
        F.when(doc % 2 == 1, stamp).otherwise(F.concat(stamp, F.lit("+00:00"))).alias("published_at"),
        F.when(doc % 9 == 0, "fr").otherwise("en").alias("original_language"),
        (F.col("importance_score") + doc % 20).cast("int").alias("importance_score"))
    return ad.violations(items, ["doc_id"], ad.edition_item_rules(3, items.columns))


@query("rules_check", """
SELECT feed_id, unnest(list_filter([CASE WHEN lo < 10 THEN 'minimum_at_least_10' END, CASE WHEN lo > mid THEN 'minimum_to_target' END,
  CASE WHEN mid > hi THEN 'target_to_maximum' END, CASE WHEN hi > 18 THEN 'maximum_at_most_18' END], lambda r: r IS NOT NULL)) AS rule
FROM (SELECT s_suppkey AS feed_id, CASE WHEN s_suppkey % 3 = 0 THEN 10 ELSE 5 + s_suppkey % 12 END AS lo,
  CASE WHEN s_suppkey % 5 = 0 THEN 14 ELSE 9 + s_suppkey % 9 END AS mid, CASE WHEN s_suppkey % 7 = 0 THEN 18 ELSE 12 + s_suppkey % 9 END AS hi FROM supplier)""")
def rules_check(spark, sf):
    key = F.col("s_suppkey")
    rules = v.table(spark, sf, "supplier").select(
        key.alias("feed_id"), F.when(key % 3 != 0, 5 + key % 12).alias("minimum"),
        F.when(key % 5 != 0, 9 + key % 9).alias("target"), F.when(key % 7 != 0, 12 + key % 9).alias("maximum"))
    return ad.rules_check(rules, ["feed_id"])
