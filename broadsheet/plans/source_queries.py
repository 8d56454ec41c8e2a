"""Captured pages and payloads to items and articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.functions import rules as ru
from broadsheet.functions import urls
from broadsheet.plans import views as v
from broadsheet.plans.catalog import query
from broadsheet.sources import feeds, pages


def _captures(spark, sf):
    """Every page is one captured index of its own source."""
    return v.pages(spark, sf).select(F.col("page_id").cast("string").alias("source_id"), "url", F.col("html").alias("body"))


def _sources(spark, sf):
    return v.pages(spark, sf).select(
        F.col("page_id").cast("string").alias("source_id"), "url", F.array(F.lit("example.com"), F.lit("example.org")).alias("allow_hosts"),
        F.lit(r"^/[^/]*$").alias("article_path_pattern"))


def _topic(title):
    return ru.on_topic(title, v.TOPIC, "")


@query("index_links")
def index_links(spark, sf):
    out = feeds.index_links(_captures(spark, sf), _sources(spark, sf), _topic)
    return out.select("source_id", "idx", "title", "url", "status", "reason")


@query("extract_articles")
def extract_articles(spark, sf):
    return pages.extract_articles(v.pages(spark, sf), "page_id").select("page_id", "title", "clean_text", F.col("published_at").cast("string"), "error")


@query("page_titles", r"SELECT page_id, title FROM (SELECT page_id, trim(substr(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '\s+', ' ', 'g'), 1, 500)) AS title FROM pages)")
def page_titles(spark, sf):
    """Titles from the first-level heading (no page of the table names an og:title)."""
    return pages.extract_articles(v.pages(spark, sf), "page_id").select("page_id", "title")


def _feed_captures(spark, sf):
    """Documents of one source and day written as an RSS body: feeds derived from the tables."""
    doc = v.table(spark, sf, "documents")

    def safe(column):
        return F.replace(F.replace(F.regexp_replace(column, r"[^\x{20}-\x{D7FF}]", " "), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    item = F.concat(F.lit("<item><title>"), safe(F.col("text")), F.lit("</title><link>"),
                    F.when(F.col("doc_id") % 7 == 0, "http://example.com/").otherwise("https://example.com/"), F.col("doc_id"),
                    F.lit("</link><pubDate>"), F.lit("Mon, 01 Jan 2024 00:00:00 +0000"), F.lit("</pubDate></item>"))
    rows = doc.select((F.col("doc_id") / 50).cast("bigint").cast("string").alias("source_id"), F.struct("doc_id", item.alias("x")).alias("i"))
    return rows.groupBy("source_id").agg(F.sort_array(F.collect_list("i")).alias("items")).select(
        "source_id", F.lit("https://example.com/feed").alias("url"),
        F.concat(F.lit("<rss><channel>"), F.array_join(F.transform("items", lambda i: i["x"]), ""), F.lit("</channel></rss>")).alias("body"))


def _feed_sources(captures):
    return captures.select("source_id", "url", F.array(F.lit("example.com")).alias("allow_hosts"), F.lit(None).cast("string").alias("article_path_pattern"))


@query("feed_items", """
SELECT CAST(doc_id // 50 AS VARCHAR) AS source_id, 'https' || CASE WHEN doc_id % 7 = 0 THEN '-no' ELSE '' END AS kind, count(*) AS n
FROM documents GROUP BY 1, 2""")
def feed_items(spark, sf):
    caps = _feed_captures(spark, sf)
    out = feeds.feed_items(caps, _feed_sources(caps))
    kind = F.when(F.col("reason") == "parsed_feed_item", "https").when(F.col("reason") == "invalid_or_disallowed_url", "https-no").otherwise(F.col("reason"))
    return out.groupBy("source_id", kind.alias("kind")).agg(F.count("*").alias("n"))


def _json_captures(spark, sf):
    doc = v.table(spark, sf, "documents")
    row = F.struct(F.col("text").alias("title"), F.concat(F.lit("https://example.com/"), F.col("doc_id")).alias("URL"),
                   F.lit("2024-01-05").alias("published_at"))
    rows = doc.select((F.col("doc_id") / 160).cast("bigint").cast("string").alias("source_id"), F.struct("doc_id", row.alias("x")).alias("i"))
    return rows.groupBy("source_id").agg(F.sort_array(F.collect_list("i")).alias("items")).select(
        "source_id", F.lit("https://example.com/list").alias("url"),
        F.to_json(F.struct(F.transform("items", lambda i: i["x"]).alias("items"))).alias("body"))


@query("json_index_items", rf"""
SELECT source_id, reason, count(*) AS n FROM (SELECT CAST(doc_id // 160 AS VARCHAR) AS source_id, CASE WHEN doc_id % 160 >= 100 THEN 'index_cap_100'
 WHEN trim(text) = '' THEN 'missing_title' WHEN NOT regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])({v.TOPIC})([^\p{{L}}\p{{N}}_]|$)') THEN 'radar_terms_absent'
 ELSE 'parsed_json_item' END AS reason FROM documents) GROUP BY 1, 2""")
def json_index_items(spark, sf):
    caps = _json_captures(spark, sf)
    return feeds.json_index_items(caps, _feed_sources(caps), _topic).groupBy("source_id", "reason").agg(F.count("*").alias("n"))


@query("board_items")
def board_items(spark, sf):
    doc = v.table(spark, sf, "documents")
    row = F.struct(F.col("text").alias("word"), F.concat(F.lit("https://example.com/"), F.col("doc_id")).alias("rawUrl"))
    rows = doc.select((F.col("doc_id") / 100).cast("bigint").cast("string").alias("source_id"), F.struct("doc_id", row.alias("x")).alias("i"))
    caps = rows.groupBy("source_id").agg(F.sort_array(F.collect_list("i")).alias("items")).select(
        "source_id", F.lit("https://example.com/board").alias("url"),
        F.to_json(F.struct((F.col("source_id").cast("int") % 5 != 4).alias("success"), F.struct(F.array(F.struct(
            F.transform("items", lambda i: i["x"]).alias("content"))).alias("cards")).alias("data"))).alias("body"))
    return feeds.board_items(caps, _feed_sources(caps), _topic).groupBy("source_id", "reason").agg(F.count("*").alias("n"))


@query("normalize_index_url")
def normalize_index_url(spark, sf):
    href = F.concat(F.lit("../a//b/./"), F.col("page_id"), F.when(F.col("page_id") % 2 == 0, "/").otherwise(""))
    links = v.pages(spark, sf).select("page_id", F.col("url").alias("base"), href.alias("href"))
    return urls.normalize_index_url(links, "base", "href", ("example.com",)).select("page_id", "url")
