"""Deduplication, joins, windows and sets over articles and their history."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.operators import audit as au
from broadsheet.operators import dedup as dd
from broadsheet.operators import linkage as lk
from broadsheet.operators import ordered as od
from broadsheet.plans import views as v
from broadsheet.plans.catalog import query


def stamp(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def stamp_sql(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {alias or column}"


@query("unique_urls", v.sql(v.V_BASE, select="""
SELECT original_url, doc_id, title, CAST(first_seq AS BIGINT) AS first_seq FROM (SELECT original_url, doc_id, title,
  row_number() OVER (PARTITION BY original_url ORDER BY doc_id DESC) AS rn, min(doc_id) OVER (PARTITION BY original_url) AS first_seq FROM v_base) WHERE rn = 1"""))
def unique_urls(spark, sf):
    items = v.articles(spark, sf, labels=False).select("original_url", "doc_id", "title")
    return dd.unique_urls(items, "original_url", "doc_id")


@query("first_fingerprint", v.sql(v.V_ARTICLES, select="""
SELECT fingerprint, doc_id FROM (SELECT fingerprint, doc_id, row_number() OVER (PARTITION BY fingerprint ORDER BY published_at DESC, doc_id) AS rn FROM v_articles) WHERE rn = 1"""))
def first_fingerprint(spark, sf):
    return dd.first_fingerprint(v.articles(spark, sf, labels=False).select("fingerprint", "doc_id", "published_at"), "doc_id").select("fingerprint", "doc_id")


@query("source_cap", v.sql(v.V_BASE, select="""
SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY published_at DESC, source_tier, doc_id) AS rn FROM v_base) WHERE rn <= 20"""))
def source_cap(spark, sf):
    items = v.articles(spark, sf, labels=False).select("source", "doc_id", "published_at", F.col("source_tier").alias("priority"))
    return dd.source_cap(items, "doc_id", source="source").select("source", "doc_id")


@query("collapse_release_bursts", v.sql(v.V_BASE, select="""
SELECT doc_id FROM v_base WHERE source_type <> 'official_changelog'
UNION ALL SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source_tier, CAST(published_at AS DATE),
  regexp_replace(lower('Kit v1.' || (doc_id % 3) || '.' || doc_id), '(v?\\d+\\.\\d+)\\.\\d+', '\\1', 'g') ORDER BY published_at DESC, doc_id) AS rn
  FROM v_base WHERE source_type = 'official_changelog') WHERE rn = 1"""))
def collapse_release_bursts(spark, sf):
    doc = F.col("doc_id")
    kits = v.articles(spark, sf, labels=False).select(
        "doc_id", "source_type", "published_at", F.col("source_tier").alias("source"),
        F.concat(F.lit("Kit v1."), doc % 3, F.lit("."), doc).alias("title"))
    return dd.collapse_release_bursts(kits, "doc_id").select("doc_id")


BATCH, TABLE = "doc_id % 3 <> 0", "doc_id % 3 = 0"  # every article is in the batch or in the table


@query("exclude_known", v.sql(v.V_ARTICLES, select=f"""
SELECT doc_id FROM v_articles WHERE {BATCH} AND original_url NOT IN (SELECT original_url FROM v_articles WHERE {TABLE})
  AND fingerprint NOT IN (SELECT fingerprint FROM v_articles WHERE {TABLE})"""))
def exclude_known(spark, sf):
    art = v.articles(spark, sf, labels=False).select("doc_id", "original_url", "fingerprint")
    return dd.exclude_known(art.filter(BATCH), art.filter(TABLE)).select("doc_id")


# Rows admitted one by one in an order, unless their URL or fingerprint was admitted before.
ADMIT_SQL = """
, steps AS MATERIALIZED (SELECT doc_id, original_url, fingerprint, row_number() OVER (ORDER BY {order}) AS n FROM {rows}),
walk AS (
  SELECT 0::BIGINT AS n, NULL::BIGINT AS doc_id, {urls}::VARCHAR[] AS urls, {prints}::VARCHAR[] AS prints
  UNION ALL
  SELECT s.n, CASE WHEN fresh THEN s.doc_id END, CASE WHEN fresh THEN list_append(urls, s.original_url) ELSE urls END,
         CASE WHEN fresh THEN list_append(prints, s.fingerprint) ELSE prints END
  FROM (SELECT w.n AS last, urls, prints, s.*, NOT list_contains(urls, s.original_url) AND NOT list_contains(prints, s.fingerprint) AS fresh
        FROM walk w JOIN steps s ON s.n = w.n + 1) s)"""


@query("append_articles", v.sql(v.V_ARTICLES, select=f"""
, batch AS (SELECT * FROM v_articles WHERE {BATCH}), held AS (SELECT * FROM v_articles WHERE {TABLE})""" + ADMIT_SQL.format(
    order="published_at DESC, doc_id", rows="batch", urls="(SELECT list(original_url) FROM held)", prints="(SELECT list(fingerprint) FROM held)") + """
SELECT doc_id, strftime(published_date, '%Y-%m-%d') AS published_date FROM held
UNION ALL SELECT a.doc_id, strftime(published_date, '%Y-%m-%d') FROM walk JOIN v_articles a ON walk.doc_id = a.doc_id""").replace("WITH ", "WITH RECURSIVE ", 1))
def append_articles(spark, sf):
    """Write the stored half as a table, append the admissible part of the batch, read it back."""
    from broadsheet.session import new_folder
    from broadsheet.sources import tables as tb

    art = v.articles(spark, sf, labels=False).select("doc_id", "original_url", "fingerprint", "published_at", "published_date")
    path = new_folder(spark, "articles")
    tb.write_articles(art.filter(TABLE), path)
    tb.append_articles(art.filter(BATCH), path, seq="doc_id")
    return spark.read.parquet(path).select("doc_id", F.col("published_date").cast("string"))


@query("unenriched", v.sql(v.V_BASE, v.V_ENRICHMENTS, select=f"""
SELECT doc_id FROM v_ids WHERE verification_status = 'source_verified' AND published_at >= TIMESTAMP '2024-01-10'
  AND id NOT IN (SELECT article_id FROM v_enrichments WHERE task = '{fv.ENRICH_TASK}') ORDER BY published_at DESC, id LIMIT 200"""))
def unenriched(spark, sf):
    art = v.articles(spark, sf, labels=False).select("doc_id", "id", "published_at", "verification_status")
    after = F.lit("2024-01-10 00:00:00").cast("timestamp")
    return dd.unenriched(art, v.enrichments(spark, sf), fv.ENRICH_TASK, 200, after=after).select("doc_id")


@query("with_enrichment", v.sql(v.V_BASE, v.V_ENRICHMENTS, select="SELECT a.doc_id, e.doc_id AS enriched_doc, e.importance_score FROM v_ids a JOIN v_enrichments e ON a.id = e.article_id"))
def with_enrichment(spark, sf):
    art = v.articles(spark, sf, labels=False).select("doc_id", "id")
    enr = v.enrichments(spark, sf).select("article_id", F.col("doc_id").alias("enriched_doc"), "importance_score")
    return dd.with_enrichment(art, enr).select("doc_id", "enriched_doc", "importance_score")


@query("inventory_top", v.sql(v.V_BASE, v.V_ENRICHMENTS, select="SELECT doc_id FROM v_ids WHERE id IN (SELECT article_id FROM v_enrichments) ORDER BY published_at DESC, id, doc_id LIMIT 100"))
def inventory_top(spark, sf):
    art = v.articles(spark, sf, labels=False).select("doc_id", "id", "published_at")
    return dd.inventory_top(art, v.enrichments(spark, sf), 100).select("doc_id")


@query("collection_top", v.sql(v.V_BASE, select="SELECT doc_id FROM v_base ORDER BY published_at DESC, doc_id LIMIT 200"))
def collection_top(spark, sf):
    return v.articles(spark, sf, labels=False).orderBy(F.desc("published_at"), "doc_id").limit(fv.RUN_CAP).select("doc_id")


@query("order_candidates", v.sql(v.V_BASE, select="SELECT doc_id, source_tier AS priority FROM v_base ORDER BY published_at DESC, source_tier, doc_id"))
def order_candidates(spark, sf):
    items = v.articles(spark, sf, labels=False).select("doc_id", "published_at", F.col("source_tier").alias("priority"))
    return dd.order_candidates(items, "doc_id").select("doc_id", "priority")


@query("exclude_published", v.sql(v.V_HISTORY, select="""
, prints AS (SELECT DISTINCT feed_id, fingerprint FROM v_history),
links AS (SELECT feed_id, rtrim(split_part(original_url, '#', 1), '/') AS u, arg_max(id, doc_id) AS last_id FROM v_history GROUP BY 1, 2)
SELECT a.doc_id, CASE WHEN p.fingerprint IS NOT NULL THEN 'historical_fingerprint' WHEN l.u IS NOT NULL THEN 'historical_url' END AS history_reason,
  CASE WHEN p.fingerprint IS NULL THEN l.last_id END AS duplicate_of
FROM v_articles a LEFT JOIN prints p USING (feed_id, fingerprint) LEFT JOIN links l ON a.feed_id = l.feed_id AND rtrim(split_part(a.original_url, '#', 1), '/') = l.u"""))
def exclude_published(spark, sf):
    """Key gates of the publication history (fingerprint, URL)."""
    past = v.history(spark, sf).select("feed_id", F.col("id").alias("article_id"), "original_url", "fingerprint", "title", F.col("doc_id").alias("seq"))
    art = v.articles(spark, sf, labels=False).select("doc_id", "feed_id", "original_url", "fingerprint", "title")
    return lk.exclude_published(art, past, ["feed_id"], events=False).select("doc_id", "history_reason", "duplicate_of")


@query("exclude_published_events")
def exclude_published_events(spark, sf):
    """The same with the same-event gate: similarity against every published headline of the feed."""
    past = v.history(spark, sf).select("feed_id", F.col("id").alias("article_id"), "original_url", "fingerprint", "title", F.col("doc_id").alias("seq"))
    art = v.articles(spark, sf, labels=False).select("doc_id", "feed_id", "original_url", "fingerprint", "title")
    return lk.exclude_published(art, past, ["feed_id"]).select("doc_id", "history_reason", "duplicate_of")


@query("event_pairs")
def event_pairs(spark, sf):
    """Headlines of one feed and day that report the same event."""
    art = v.articles(spark, sf)
    keyed = art.select("feed_id", "published_date", *lk.event_key(F.col("title")))
    return lk.event_pairs(keyed, keyed, ["feed_id", "published_date"])


@query("sketched_pairs")
def sketched_pairs(spark, sf):
    """Headlines of one feed, on any day, that report the same event, by their sketches; the ratio of each pair."""
    keyed = v.articles(spark, sf, labels=False).select("feed_id", *lk.event_key(F.col("title")))
    return lk.sketched_pairs(keyed, keyed, ["feed_id"])


WINDOW_SQL = "a.published_at BETWEEN e.now_ts - INTERVAL 168 HOUR AND e.now_ts + INTERVAL 10 MINUTE"


@query("window_join", v.sql(v.V_BASE, v.V_EDITIONS, select=f"""
SELECT e.feed_id, strftime(e.report_date, '%Y-%m-%d') AS report_date, a.doc_id FROM v_base a JOIN v_editions e ON a.feed_id = e.feed_id AND {WINDOW_SQL}"""))
def window_join(spark, sf):
    from broadsheet.operators import selection as se

    art = v.articles(spark, sf, labels=False).select("doc_id", "feed_id", "published_at", "published_date")
    out = se.window_join(art, v.editions(spark, sf))
    return out.select("feed_id", F.col("report_date").cast("string"), "doc_id")


@query("cache_matches", v.sql(v.V_BASE, v.V_ENRICHMENTS, select=f"""
SELECT a.doc_id, e.doc_id AS cached_doc, CASE WHEN e.article_id IS NULL THEN 'cache_missing'
  WHEN e.task <> '{fv.ENRICH_TASK}' OR e.model = '' THEN 'cache_version_incompatible'
  WHEN a.original_url <> e.original_url OR a.published_at <> e.published_at OR a.source <> e.source OR a.title <> e.title_original THEN 'cache_metadata_mismatch' END AS cache_reason
FROM v_ids a LEFT JOIN v_enrichments e ON a.id = e.article_id"""))
def cache_matches(spark, sf):
    a = v.articles(spark, sf, labels=False).select("doc_id", "id", "original_url", "published_at", "source", F.col("title").alias("original_title")).alias("a")
    e = v.enrichments(spark, sf).alias("e")
    return a.join(e, F.col("a.id") == F.col("e.article_id"), "left").select(
        F.col("a.doc_id"), F.col("e.doc_id").alias("cached_doc"), dd.cache_reason().alias("cache_reason"))


@query("attach_metadata", v.sql(v.V_BASE, select="""
SELECT x.page_id, a.title, a.source FROM (SELECT page_id, sha256('https://example.com/' || page_id) AS article_id FROM pages) x LEFT JOIN v_ids a ON x.article_id = a.id"""))
def attach_metadata(spark, sf):
    from broadsheet.functions import text as tx

    ids = v.pages(spark, sf).select("page_id", tx.article_id(F.concat(F.lit("https://example.com/"), F.col("page_id"))).alias("article_id"))
    return au.attach_metadata(ids, v.articles(spark, sf, labels=False)).select("page_id", "title", "source")


@query("batches_of", v.sql(v.V_BATCHES, select="""
SELECT event_id, position, CAST((position - 1) // 6 AS BIGINT) AS batch FROM (SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS position FROM v_batches)"""))
def batches_of(spark, sf):
    out = od.in_batches(v.batches(spark, sf), ["user_id"], F.date_trunc("hour", "ts"), ["ts", "event_id"], 6)
    return out.select("event_id", "position", "batch")


@query("articles_desc", v.sql(v.V_BASE, select="SELECT id AS article_id, " + stamp_sql("published_at") + " FROM v_ids"))
def articles_desc(spark, sf):
    art = v.articles(spark, sf, labels=False).select(F.col("id").alias("article_id"), "published_at")
    return au.articles_desc(art).select("article_id", stamp("published_at"))


@query("union_inventory", v.sql(v.V_BASE, select="""
SELECT doc_id FROM v_base WHERE doc_id % 2 = 0 UNION ALL
SELECT doc_id FROM v_ids WHERE doc_id % 3 = 0 AND source_tier <= 2 AND id NOT IN (SELECT id FROM v_ids WHERE doc_id % 2 = 0)"""))
def union_inventory(spark, sf):
    art = v.articles(spark, sf, labels=False).select("doc_id", "id", F.when(F.col("source_tier") <= 2, "eligible").otherwise("rejected").alias("reserve_status"))
    return au.union_inventory(art.filter("doc_id % 2 = 0").select("id", "doc_id"), art.filter("doc_id % 3 = 0")).select("doc_id")


@query("origin_split", v.sql(v.V_BASE, select="""
SELECT article_id, CASE WHEN article_id IN (SELECT id FROM v_ids WHERE source_tier = 1) THEN 'current_run_inventory' ELSE 'historical_inventory' END AS origin
FROM (SELECT DISTINCT id AS article_id FROM v_ids WHERE doc_id % 3 = 0)"""))
def origin_split(spark, sf):
    art = v.articles(spark, sf, labels=False).select(F.col("id").alias("article_id"), "doc_id", "source_tier")
    return au.origin_split(art.filter("doc_id % 3 = 0"), art.filter("source_tier = 1"))


@query("lock_assertion", v.sql(v.V_BASE, select="""
SELECT DISTINCT doc_id FROM v_base WHERE source_tier = 1 AND doc_id NOT IN (SELECT doc_id FROM v_base WHERE doc_id % 16 <> 4)"""))
def lock_assertion(spark, sf):
    art = v.articles(spark, sf, labels=False).select("doc_id", "source_tier")
    return au.lock_violations(art.filter("source_tier = 1"), art.filter("doc_id % 16 <> 4"), ["doc_id"])


@query("history_extend", v.sql(v.V_BASE, select="""
SELECT doc_id, 'published' AS kind FROM v_base WHERE doc_id % 13 = 0 UNION ALL SELECT doc_id, 'attempted' FROM v_base WHERE doc_id % 11 = 0"""))
def history_extend(spark, sf):
    from broadsheet.operators import selection as se

    art = v.articles(spark, sf, labels=False).select("doc_id", "original_url", "title", "fingerprint")
    return se.history_extend(art.filter("doc_id % 13 = 0"), art.filter("doc_id % 11 = 0")).select("doc_id", "kind")


@query("upsert_by_key", """
SELECT user_id, CAST(coalesce(c.value, b.value) AS DOUBLE) AS value, coalesce(b.first_seen, c.first_seen) AS first_seen FROM
 (SELECT user_id, max(value) AS value, min(event_id) AS first_seen FROM events WHERE event_type IN ('view','click') GROUP BY user_id) b
 FULL JOIN (SELECT user_id, max(value) AS value, min(event_id) AS first_seen FROM events WHERE event_type = 'error' GROUP BY user_id) c USING (user_id)""")
def upsert_by_key(spark, sf):
    from broadsheet.sources import tables as tb

    ev = v.table(spark, sf, "events")
    agg = [F.max("value").alias("value"), F.min("event_id").alias("first_seen")]
    current = ev.filter(F.col("event_type").isin("view", "click")).groupBy("user_id").agg(*agg)
    changes = ev.filter(F.col("event_type") == "error").groupBy("user_id").agg(*agg)
    return tb.upsert_by_key(current, changes, ["user_id"], keep=["first_seen"])


@query("latest_capture", """
SELECT host, arg_max(page_id, page_id) AS page_id, arg_max(sha256(html), page_id) AS body_hash FROM
 (SELECT page_id, html, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM pages) GROUP BY host""")
def latest_capture(spark, sf):
    from broadsheet.sources import tables as tb

    caps = v.pages(spark, sf).select(F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)).alias("host"),
                                     "page_id", F.sha2("html", 256).alias("body_hash"))
    return tb.latest_capture(caps, ["host"], "page_id", ["body_hash"]).select("host", "page_id", "body_hash")


@query("normalize_schema", """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'unknown' ELSE source END AS source, CASE WHEN doc_id % 2 = 0 THEN 'technology' ELSE lang END AS channel,
 CAST(CASE WHEN doc_id % 2 = 0 THEN 3 ELSE doc_id % 4 END AS INTEGER) AS source_tier, CAST(NULL AS VARCHAR) AS region FROM documents""")
def normalize_schema(spark, sf):
    """A table of which older files lack columns that newer ones have, read under today's schema."""
    from pyspark.sql import types as T

    from broadsheet.session import new_folder
    from broadsheet.sources import tables as tb

    folder, doc = new_folder(spark, "evolved"), F.col("doc_id")
    rows = v.table(spark, sf, "documents")
    rows.filter(doc % 2 == 0).select("doc_id").write.parquet(f"{folder}/age=1")
    rows.filter(doc % 2 == 1).select("doc_id", "source", F.col("lang").alias("channel"), (doc % 4).alias("source_tier")).write.parquet(f"{folder}/age=2")
    target = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("source", "channel")],
                           T.StructField("source_tier", T.IntegerType()), T.StructField("region", T.StringType())])
    return tb.normalize_schema(spark.read.option("mergeSchema", True).parquet(folder), target, {"source": "unknown", "source_tier": 3, "channel": "technology"})


@query("index_title_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS dated FROM orders")
def index_title_date(spark, sf):
    """Dates written in the text of index links, one for each order; every other month is spelled out."""
    day = F.col("o_orderdate")
    written = F.when(F.month(day) % 2 == 0, F.date_format(day, "MMMM d, yyyy")).otherwise(F.date_format(day, "MMM  d, yyyy"))
    title = F.concat(F.lit("Order "), "o_orderkey", F.lit(" of "), "o_custkey", F.lit(" | "), written, F.lit(" | "), "o_orderpriority")
    return v.table(spark, sf, "orders").select("o_orderkey", F.date_format(ru.index_title_date(title), "yyyy-MM-dd").alias("dated"))


@query("merge_evidence", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'old' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS policy_checked_at, o_orderpriority AS policy_validity_evidence,
 CASE WHEN o_orderkey % 4 <> 1 THEN o_orderstatus = 'F' END AS current_applicability_verified, CAST(NULL AS VARCHAR) AS applicability_evidence FROM orders""")
def merge_evidence(spark, sf):
    """Reviews kept as JSON beside older columns, one for each order."""
    from broadsheet.operators import reserve as rs

    key = F.col("o_orderkey")
    review = F.to_json(F.struct(F.when(key % 3 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("policy_checked_at"), F.col("o_orderpriority").alias("policy_validity_evidence"),
                                F.when(key % 4 != 1, F.col("o_orderstatus") == "F").alias("current_applicability_verified")))
    prior = v.table(spark, sf, "orders").select("o_orderkey", review.alias("review_evidence_json"), F.lit("old").alias("policy_checked_at"), F.lit("older").alias("policy_validity_evidence"))
    return rs.merge_evidence(prior).drop("review_evidence_json")
