"""Edition selection, reserve, publication and replay."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.functions import text as tx
from broadsheet.operators import dedup as dd
from broadsheet.operators import linkage as lk
from broadsheet.operators import publishing as pb
from broadsheet.operators import reserve as rs
from broadsheet.operators import selection as se
from broadsheet.plans import views as v
from broadsheet.plans.catalog import query
from broadsheet.plans.gate_queries import GATE_SQL
from broadsheet.plans.text_queries import DEEP_SQL, IMPORTANCE_SQL, LEVEL_SQL, RANK_SQL

DAY_SQL = "strftime(report_date, '%Y-%m-%d') AS report_date"


def day():
    return F.col("report_date").cast("string").alias("report_date")


def unique_articles(spark, sf):
    """The article table as the collector would store it: one row per URL, then per fingerprint."""
    art = v.articles(spark, sf)
    return dd.first_fingerprint(dd.unique_urls(art, "original_url", "doc_id"), "doc_id")


def features(spark, sf):
    """Candidate rows, made narrow before they are deduplicated: no text is shuffled. Of the clean text only counts whether it is
    as long as a deep read."""
    articles = v.articles(spark, sf).withColumn("clean_text", tx.clean_head(F.col("raw_text"), fv.DEEP_CHARS))
    rows = se.candidate_features(articles, v.DEEP, v.IMPACT, extra=("original_url",))
    return dd.first_fingerprint(dd.unique_urls(rows, "original_url", "doc_id"), "doc_id").drop("original_url", "first_seq")


POOL_SQL = v.sql(v.V_HISTORY, v.V_EDITIONS, select=f"""
, u AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY original_url ORDER BY doc_id DESC) AS rn FROM v_articles) WHERE rn = 1),
f AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY published_at DESC, doc_id) AS rn FROM u) WHERE rn = 1),
c AS (SELECT *, {DEEP_SQL} AS deep, {IMPORTANCE_SQL} AS imp, NOT regexp_matches(title, '(?i)({fv.LOW_VALUE_TITLE})') AS editorial FROM f),
w AS (SELECT e.report_date, e.now_ts, c.* FROM c JOIN v_editions e ON c.feed_id = e.feed_id AND c.published_at BETWEEN e.now_ts - INTERVAL 168 HOUR AND e.now_ts + INTERVAL 10 MINUTE),
l AS (SELECT *, {LEVEL_SQL.format(now='now_ts')} AS level FROM w),
hp AS (SELECT feed_id, fingerprint, min(report_date) AS since FROM v_history GROUP BY 1, 2),
hu AS (SELECT feed_id, rtrim(split_part(original_url, '#', 1), '/') AS k, min(report_date) AS since FROM v_history GROUP BY 1, 2),
pool AS (SELECT l.*, {RANK_SQL} AS score, CASE WHEN NOT editorial THEN 'editorial_exclusion'
  WHEN level IS NULL THEN CASE WHEN epoch_us(now_ts) - epoch_us(published_at) < -600000000 THEN 'future_publication_time'
     WHEN epoch_us(now_ts) - epoch_us(published_at) > 604800000000 THEN 'outside_7_day_window' ELSE 'older_than_72h_not_deep_read' END
  WHEN source_tier > 3 THEN 'tier_above_3' WHEN source_role = 'discovery' THEN 'discovery_not_factual_source'
  WHEN verification_status <> 'source_verified' THEN 'source_not_verified'
  WHEN hp.since <= report_date THEN 'historical_fingerprint' WHEN hu.since <= report_date THEN 'historical_url'
  WHEN importance IS NOT NULL AND imp < 60 THEN 'enriched_importance_below_60' END AS gate
  FROM l LEFT JOIN hp ON hp.feed_id = l.feed_id AND hp.fingerprint = l.fingerprint
  LEFT JOIN hu ON hu.feed_id = l.feed_id AND hu.k = rtrim(split_part(l.original_url, '#', 1), '/'))""").strip()


def pool(spark, sf, events=False):
    return se.candidate_pool(features(spark, sf), v.editions(spark, sf), v.history(spark, sf), events=events)


@query("candidate_pool", POOL_SQL + f" SELECT feed_id, {DAY_SQL}, doc_id, CAST(level AS INTEGER) AS level, round(score, 4) AS score, gate FROM pool")
def candidate_pool(spark, sf):
    return pool(spark, sf).select("feed_id", day(), "doc_id", "level", F.round("score", 4).alias("score"), "gate")


def _ranked(spark, sf):
    """Native top list per edition: at most three rows of a source, then the best fourteen."""
    order = [F.desc("major"), F.desc("tens"), F.desc("score"), F.desc("published_at"), F.asc("doc_id")]
    rows = pool(spark, sf).filter("gate is null").withColumn("major", F.col("importance") >= 85).withColumn(
        "tens", F.floor(F.col("importance") / 10))
    capped = dd.first_per_key(rows, [*se.EDITION, "source"], order, 3)
    w = Window.partitionBy(*se.EDITION).orderBy(*order)
    return capped.withColumn("pick", F.row_number().over(w)).filter("pick <= 14")


RANKED_SQL = POOL_SQL + """
, r AS (SELECT *, imp >= 85 AS major, imp // 10 AS tens FROM pool WHERE gate IS NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY feed_id, report_date, source ORDER BY major DESC, tens DESC, score DESC, published_at DESC, doc_id) AS sr FROM r),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_id, report_date ORDER BY major DESC, tens DESC, score DESC, published_at DESC, doc_id) AS pick FROM s WHERE sr <= 3) WHERE pick <= 14)"""


@query("ranked_edition", RANKED_SQL + f" SELECT feed_id, {DAY_SQL}, CAST(pick AS INTEGER) AS pick, doc_id, id AS article_id, CAST(imp AS INTEGER) AS importance, round(score, 4) AS score FROM ranked")
def ranked_edition(spark, sf):
    return _ranked(spark, sf).select("feed_id", day(), "pick", "doc_id", F.col("id").alias("article_id"), "importance", F.round("score", 4).alias("score"))


META_SQL = RANKED_SQL + """
, meta AS (SELECT *, CASE WHEN deep THEN 'deep_read' WHEN imp >= 85 THEN 'major_tech' WHEN category IN ('ai','robotics') THEN 'for_you' ELSE 'explore' END AS section,
  CASE WHEN deep THEN 'deep_read' ELSE 'news' END AS content_type, level = 3 AS catch_up, CASE WHEN deep THEN 'deep_read' ELSE channel END AS shown_channel FROM ranked)"""


@query("selection_metadata", META_SQL + f" SELECT feed_id, {DAY_SQL}, doc_id, section, content_type, catch_up, shown_channel FROM meta")
def selection_metadata(spark, sf):
    return se.selection_metadata(_ranked(spark, sf)).select("feed_id", day(), "doc_id", "section", "content_type", "catch_up", "shown_channel")


@query("edition_profile", RANKED_SQL + f""" SELECT feed_id, {DAY_SQL}, count(*) AS selected, count(DISTINCT source) AS sources, count(DISTINCT category) AS categories,
 count(*) FILTER (category NOT IN ('ai','robotics')) AS explore_count, greatest(10 - count(*), 0) AS shortfall FROM ranked GROUP BY feed_id, report_date""".replace("strftime(report_date", "strftime(ranked.report_date"))
def edition_profile(spark, sf):
    return se.edition_profile(_ranked(spark, sf), se.EDITION).select("feed_id", day(), "selected", "sources", "categories", "explore_count", "shortfall")


@query("edition_profile_counts", RANKED_SQL + f"""
SELECT feed_id, strftime(d, '%Y-%m-%d') AS report_date, dimension, value, count(*) AS n FROM (
 SELECT feed_id, report_date AS d, 'category' AS dimension, category AS value FROM ranked UNION ALL SELECT feed_id, report_date, 'channel', channel FROM ranked
 UNION ALL SELECT feed_id, report_date, 'source', source FROM ranked) GROUP BY ALL""")
def edition_profile_counts(spark, sf):
    return se.profile_counts(_ranked(spark, sf), se.EDITION).select("feed_id", day(), "dimension", "value", "n")


# The pool with its decisions by the ranked lists: each of the dimensions, and the edition itself.
DIAGNOSTICS_SQL = RANKED_SQL + """
, dp AS (SELECT pool.*, CASE WHEN deep THEN 'deep_read' ELSE channel END AS shown, hit IS NOT NULL AS picked
  FROM pool LEFT JOIN (SELECT feed_id, report_date, id, true AS hit FROM ranked) USING (feed_id, report_date, id) WHERE pool.gate IS NULL),
db AS (SELECT feed_id, report_date, greatest(1, floor((CASE WHEN count(*) FILTER (imp >= 85 AND level <= 2) >= 10 THEN 18 ELSE 14 END) * 0.25))::INT AS source_limit FROM dp GROUP BY ALL),
ds AS (SELECT feed_id, report_date, count(*) AS sources, bool_or(n > source_limit) AS over
  FROM (SELECT feed_id, report_date, source, count(*) AS n FROM dp WHERE picked GROUP BY ALL) JOIN db USING (feed_id, report_date) GROUP BY ALL),
dc AS (
  SELECT feed_id, report_date, 'level' AS dimension, level::INT::VARCHAR AS value, count(*) AS eligible, count(*) FILTER (picked) AS selected FROM dp GROUP BY ALL
  UNION ALL SELECT feed_id, report_date, 'category', category, count(*), count(*) FILTER (picked) FROM dp GROUP BY ALL
  UNION ALL SELECT feed_id, report_date, 'channel', shown, count(*), count(*) FILTER (picked) FROM dp GROUP BY ALL
  UNION ALL SELECT feed_id, report_date, 'source', source, count(*), count(*) FILTER (picked) FROM dp GROUP BY ALL),
de AS (
  SELECT feed_id, report_date, count(*) AS eligible, count(*) FILTER (picked) AS selected, count(*) FILTER (deep) AS deep_read_candidates,
         count(*) FILTER (picked AND category NOT IN ('ai', 'robotics')) AS explore_count FROM dp GROUP BY ALL),
dd AS (
  SELECT feed_id, report_date, 'edition' AS dimension, NULL::VARCHAR AS value, eligible, selected, deep_read_candidates, explore_count,
         greatest(10 - selected, 0) AS shortfall, coalesce(sources, 0) AS sources, source_limit, coalesce(over, false) AS diversity_exception
  FROM de JOIN db USING (feed_id, report_date) LEFT JOIN ds USING (feed_id, report_date)
  UNION ALL SELECT *, NULL, NULL, NULL, NULL, NULL, NULL FROM dc)"""


@query("edition_diagnostics", DIAGNOSTICS_SQL + " SELECT * REPLACE (strftime(report_date, '%Y-%m-%d') AS report_date) FROM dd")
def edition_diagnostics(spark, sf):
    """The profile of every edition of the ranked lists, by one pass of grouping sets over their pools."""
    rows = pool(spark, sf).filter("gate is null")
    picked = _ranked(spark, sf).select(*se.EDITION, "id", F.lit("picked").alias("state"))
    decisions = rows.select(*se.EDITION, "id").join(picked, [*se.EDITION, "id"], "left").withColumns(
        {"state": F.coalesce("state", F.lit("dropped")), "filled": F.lit(False)})
    return se.edition_diagnostics(rows, decisions).withColumn("report_date", F.col("report_date").cast("string"))


@query("select_edition")
def select_edition(spark, sf):
    """Full greedy selection with diversity rules and the same-event gate, all feeds and days."""
    return se.select_edition(pool(spark, sf, events=True).filter("gate is null")).withColumn("report_date", F.col("report_date").cast("string"))


@query("selection_reasons")
def selection_reasons(spark, sf):
    """How many candidates of each edition were dropped for what, every row of the pool counted."""
    out = se.select_edition(pool(spark, sf, events=True).filter("gate is null")).filter("state = 'dropped'")
    return out.groupBy("feed_id", day(), "level", "reason").agg(F.count("*").alias("n"))


LAYER_SQL = """CASE WHEN level IN (1, 2) THEN 'today' WHEN doc_id % 6 = 0 THEN CASE WHEN doc_id % 12 = 0 AND days > 3 AND days <= 365 THEN 'evergreen' END
  WHEN level = 3 THEN 'catch_up' WHEN level = 4 THEN 'deep_read' END"""
LAYERS_NOW = "TIMESTAMP '2024-01-20'"


@query("supply_layer", v.sql(v.V_ARTICLES, select=f"""
SELECT doc_id, {LAYER_SQL} AS layer FROM (SELECT doc_id, {LEVEL_SQL.format(now=LAYERS_NOW)} AS level,
  (epoch_us({LAYERS_NOW}) - epoch_us(published_at)) / 86400000000::DOUBLE AS days FROM (SELECT *, {DEEP_SQL} AS deep FROM v_articles))"""))
def supply_layer(spark, sf):
    return _layered_rows(spark, sf, F.lit("2024-01-20 00:00:00").cast("timestamp"), v.articles(spark, sf)).select("doc_id", "layer")


def _reserve_marks():
    doc = F.col("doc_id")
    return {"reserve_status": F.when(doc % 6 == 0, F.when(doc % 12 == 0, "eligible").otherwise("rejected")),
            "supply_layer": F.lit("evergreen"), "cache_available": F.lit(True), "validation_status": F.lit("passed")}


def _layered_rows(spark, sf, now, rows):
    deep = F.col("deep") if "deep" in rows.columns else ru.deep_read(F.col("title"), F.col("clean_text"), F.col("source_tier"), v.DEEP)
    return rows.withColumn("layer", se.supply_layer(F.col("published_at"), F.col("source_tier"), deep, now, _reserve_marks()))


@query("select_layered")
def select_layered(spark, sf):
    """Today first and locked, then catch-up, deep reads and evergreens up to the target."""
    rows = _layered_rows(spark, sf, F.col("now_ts"), pool(spark, sf, events=True).filter("gate is null"))
    rows = rows.select("*", F.col("title_key").alias("key_cn"), F.col("versions").alias("versions_cn"),
                       F.col("title_key").alias("key_en"), F.col("versions").alias("versions_en"))
    return se.layer_metadata(se.select_layered(rows)).withColumn("report_date", F.col("report_date").cast("string"))


@query("event_dedup_first")
def event_dedup_first(spark, sf):
    rows = _layered_rows(spark, sf, F.col("now_ts"), _ranked(spark, sf))
    items = rows.select("feed_id", day(), "doc_id", F.col("layer").alias("supply_layer"), "importance", "pick",
                        F.col("title_key").alias("key_cn"), F.col("versions").alias("versions_cn"),
                        F.col("title_key").alias("key_en"), F.col("versions").alias("versions_en"))
    return se.event_dedup_first(items, se.EDITION).select("feed_id", "report_date", "doc_id")


@query("replay_editions")
def replay_editions(spark, sf):
    """All days of the editions in a row, after the published history; each day's picks are history for the next."""
    from broadsheet.session import new_folder, stored

    rows = stored(features(spark, sf), "features")
    span = v.editions(spark, sf).agg(F.min("report_date").alias("first"), F.max("report_date").alias("last")).first()
    days = [span["first"] + dt.timedelta(days=n) for n in range((span["last"] - span["first"]).days + 1)]
    out = se.replay_editions(rows, v.history(spark, sf), days, new_folder(spark, "replay"))
    return out.withColumn("report_date", F.col("report_date").cast("string"))


# --- reserve ---------------------------------------------------------------------------
RESERVE_NOW = "TIMESTAMP '2024-02-05'"


def _reserve_now():
    return F.lit("2024-02-05 00:00:00").cast("timestamp")


def _reserve_inputs(spark, sf):
    doc = F.col("doc_id")
    art = unique_articles(spark, sf)
    pair = art.select("id", "original_url", "published_at", "source", F.col("title").alias("original_title")).alias("a").join(
        v.enrichments(spark, sf).alias("e"), F.col("a.id") == F.col("e.article_id"))
    enr = pair.select("e.*", dd.cache_reason().alias("cache_reason"), F.sha2("e.title_en", 256).alias("enrichment_hash_now"))
    enr = dd.first_per_key(enr, ["article_id"], [F.desc("doc_id")])
    prior = art.filter(doc % 4 == 0).select(
        F.col("id").alias("article_id"), F.when(doc % 8 == 0, "valid").when(doc % 16 == 4, "expired").alias("policy_validity"),
        F.when(doc % 20 == 0, "2024-01-01").alias("validity_end"), (doc % 28 == 0).alias("used_in_daily"),
        F.lit("https://www.moe.gov.cn/x").alias("policy_evidence_url"), F.lit("2024-02-04T00:00:00+00:00").alias("policy_checked_at"),
        F.lit("reviewed").alias("policy_validity_evidence"),
        F.when(doc % 44 == 0, "other").alias("content_fingerprint"))
    past = v.history(spark, sf).select("feed_id", F.col("id").alias("article_id"), "original_url", "fingerprint", "title",
                                       F.col("doc_id").alias("seq"), F.col("report_date").alias("daily_published_at"))
    return rs.reserve_inputs(art, enr, prior, past, ["feed_id"], events=False)


RESERVE_SQL = v.sql(v.V_HISTORY, v.V_ENRICHMENTS, select=f"""
, u AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY original_url ORDER BY doc_id DESC) AS rn FROM v_articles) WHERE rn = 1),
f AS (SELECT * EXCLUDE (rn), {GATE_SQL} AS gate FROM (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY published_at DESC, doc_id) AS rn FROM u) WHERE rn = 1),
e AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY doc_id DESC) AS rn FROM v_enrichments) WHERE rn = 1),
j AS (SELECT f.*, (epoch_us({RESERVE_NOW}) - epoch_us(f.published_at)) / 86400000000::DOUBLE AS days, e.importance_score,
  CASE WHEN e.article_id IS NULL THEN 'cache_missing' WHEN e.task <> '{fv.ENRICH_TASK}' OR e.model = '' THEN 'cache_version_incompatible'
    WHEN f.published_at <> e.published_at OR f.source <> e.source OR f.title <> e.title_original THEN 'cache_metadata_mismatch' END AS cr,
  EXISTS (SELECT 1 FROM v_history h WHERE h.feed_id = f.feed_id AND (h.fingerprint = f.fingerprint OR h.original_url = f.original_url)) AS pub,
  f.category = 'policy' OR f.channel = 'policy_economy' AND f.source_role = 'primary' AS pol,
  regexp_matches(f.title || ' ' || coalesce(e.what_happened_en, '') || ' ' || coalesce(e.what_happened, ''), '(?i)({fv.SHORT_LIVED})') AS short,
  CASE WHEN f.doc_id % 4 = 0 THEN CASE WHEN f.doc_id % 8 = 0 THEN 'valid' WHEN f.doc_id % 16 = 4 THEN 'expired' END END AS val
  FROM f LEFT JOIN e ON f.id = e.article_id),
res AS (SELECT *, CASE WHEN pub OR doc_id % 28 = 0 THEN 'previously_published' WHEN days > 365 THEN 'outside_reserve_design_window'
  WHEN gate IS NOT NULL OR regexp_matches(title, '(?i)({fv.LOW_VALUE_TITLE})') THEN 'existing_quality_filter' WHEN cr IS NOT NULL THEN cr
  WHEN doc_id % 44 = 0 THEN 'content_fingerprint_changed' WHEN importance_score < 60 THEN 'importance_below_60'
  WHEN val = 'expired' THEN 'policy_expired_or_superseded' WHEN doc_id % 20 = 0 THEN 'policy_expired' WHEN days <= 3 THEN 'within_catchup_window'
  WHEN short THEN 'short_lived_content' WHEN pol AND val IS DISTINCT FROM 'valid' THEN 'policy_validity_unknown'
  WHEN pol AND NOT (source_role = 'primary' AND source_tier = 1) THEN 'policy_validity_evidence_missing_or_stale' WHEN pol THEN 'verified_valid_policy'
  ELSE 'long_term_value_not_proven' END AS reserve_reason FROM j WHERE days > 1),
fin AS (SELECT *, CASE WHEN reserve_reason IN ('within_catchup_window','verified_valid_policy') THEN 'eligible'
  WHEN reserve_reason LIKE 'cache%' OR reserve_reason IN ('content_fingerprint_changed','policy_validity_unknown','policy_validity_evidence_missing_or_stale','long_term_value_not_proven') THEN 'pending_review'
  ELSE 'rejected' END AS reserve_status FROM res)""")


@query("reserve_classify", RESERVE_SQL + " SELECT doc_id, reserve_status, reserve_reason, CASE WHEN pol THEN 'policy' ELSE 'catch_up' END AS reserve_type FROM fin")
def reserve_classify(spark, sf):
    return rs.reserve_classify(_reserve_inputs(spark, sf), _reserve_now()).select("doc_id", "reserve_status", "reserve_reason", "reserve_type")


@query("reserve_inputs", RESERVE_SQL + " SELECT doc_id, importance_score, cr AS cache_reason, pub AS published_before FROM j")
def reserve_inputs(spark, sf):
    missing = F.when(F.col("cache_available").isNull(), "cache_missing").otherwise(F.col("cache_reason"))
    return _reserve_inputs(spark, sf).select("doc_id", "importance_score", missing.alias("cache_reason"), "published_before")


@query("reserve_summary", RESERVE_SQL + """
SELECT feed_id, dimension, value, count(*) AS n FROM (
 SELECT feed_id, 'status' AS dimension, reserve_status AS value FROM fin UNION ALL
 SELECT feed_id, 'rejection_reason', reserve_reason FROM fin WHERE reserve_status <> 'eligible' UNION ALL
 SELECT feed_id, 'supply_layer', CASE WHEN days <= 3 THEN 'catch_up' ELSE 'evergreen' END FROM fin WHERE reserve_status = 'eligible' UNION ALL
 SELECT feed_id, 'source', source FROM fin WHERE reserve_status = 'eligible' UNION ALL
 SELECT feed_id, 'age', CASE WHEN days <= 3 THEN '1-3d' WHEN days <= 7 THEN '3-7d' WHEN days <= 30 THEN '7-30d' ELSE '30-365d' END FROM fin WHERE reserve_status = 'eligible') GROUP BY ALL""")
def reserve_summary(spark, sf):
    return rs.reserve_summary(rs.reserve_classify(_reserve_inputs(spark, sf), _reserve_now()), ["feed_id"])


# --- publication ------------------------------------------------------------------------
def _edition_items(spark, sf):
    art = v.articles(spark, sf).filter(F.col("importance").isNotNull())
    ranked = dd.first_per_key(art.select("feed_id", F.col("published_date").alias("report_date"), "id", "doc_id", "importance"),
                              se.EDITION, [F.desc("importance"), F.asc("doc_id")], 18)
    w = Window.partitionBy(*se.EDITION).orderBy(F.desc("importance"), "doc_id")
    return ranked.withColumn("pick", F.row_number().over(w))


def _editions(spark, sf):
    enr = dd.first_per_key(v.enrichments(spark, sf), ["article_id"], [F.desc("doc_id")])
    published = F.date_format("report_date", "yyyy-MM-dd'T'08:00:00+00:00")
    return pb.build_edition(_edition_items(spark, sf), enr, se.EDITION, published_at=published)


EDITION_SQL = v.sql(v.V_BASE, v.V_ENRICHMENTS, select="""
, sel AS (SELECT feed_id, published_date AS report_date, id, doc_id, row_number() OVER (PARTITION BY feed_id, published_date ORDER BY importance DESC, doc_id) AS pick FROM v_ids WHERE importance IS NOT NULL),
e AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY doc_id DESC) AS rn FROM v_enrichments) WHERE rn = 1),
it AS (SELECT sel.feed_id, sel.report_date, sel.pick, e.* FROM sel JOIN e ON sel.id = e.article_id WHERE pick <= 18),
ed AS (SELECT feed_id, report_date, count(*) AS article_count, greatest(5, least(10, CAST(ceil(sum(length(what_happened) + length(why_it_matters)) / 650) AS INTEGER))) AS minutes,
  array_to_string(list_slice(list(title_cn ORDER BY pick), 1, 3), '|') AS highlights FROM it GROUP BY 1, 2)""")


@query("build_edition", EDITION_SQL + f"""
 SELECT feed_id, {DAY_SQL}, article_count, CASE WHEN article_count >= 10 THEN 'normal' WHEN article_count >= 5 THEN 'graceful_degraded' ELSE 'minimal_daily' END AS daily_mode,
 minutes AS estimated_reading_minutes, highlights FROM ed""")
def build_edition(spark, sf):
    return _editions(spark, sf).select("feed_id", day(), "article_count", "daily_mode", "estimated_reading_minutes",
                                       F.array_join("highlights", "|").alias("highlights"))


@query("edition_history", EDITION_SQL + f" SELECT feed_id, {DAY_SQL}, article_id, title_cn FROM it WHERE report_date <= DATE '2024-01-20'")
def edition_history(spark, sf):
    """Editions written as JSON per date, read back up to a date and flattened to items."""
    from broadsheet.session import new_folder

    editions = _editions(spark, sf)
    path = new_folder(spark, "editions")
    pb.write_editions(editions, path)
    past = pb.read_history(spark, path, editions.schema, F.lit("2024-01-20").cast("date"))
    return past.select("feed_id", day(), "article_id", "title_cn")


@query("edition_index", EDITION_SQL + f"""
 SELECT feed_id, {DAY_SQL}, article_count, 'new' AS origin FROM ed WHERE report_date > DATE '2024-01-15'
 UNION ALL SELECT feed_id, {DAY_SQL}, article_count, 'old' FROM ed WHERE report_date <= DATE '2024-01-15'""")
def edition_index(spark, sf):
    listed = pb.edition_summaries(_editions(spark, sf), se.EDITION)
    old = listed.filter("report_date <= date '2024-01-20'").withColumn("origin", F.lit("old"))
    new = listed.filter("report_date > date '2024-01-15'").withColumn("origin", F.lit("new"))
    return pb.edition_index(old, new, se.EDITION).select("feed_id", day(), "article_count", "origin")


@query("report_checks", EDITION_SQL + f"""
, bad AS (SELECT feed_id, report_date, count(*) FILTER (length(trim(why_it_matters_en)) = 0 OR length(trim(why_it_matters)) = 0 OR length(trim(what_happened)) = 0 OR length(trim(title_cn)) = 0 OR length(trim(source)) = 0) AS holes FROM it GROUP BY 1, 2)
SELECT feed_id, {DAY_SQL.replace('report_date,', 'ed.report_date,')}, unnest(list_filter([CASE WHEN dayofmonth(ed.report_date) % 10 = 0 THEN 'report_missing_or_empty' END,
 CASE WHEN article_count % 4 = 0 THEN 'article_count' END, CASE WHEN holes > 0 THEN 'item_fields' END], lambda r: r IS NOT NULL)) AS rule FROM ed JOIN bad USING (feed_id, report_date)""")
def report_checks(spark, sf):
    from broadsheet.operators import admission as ad

    shown = _editions(spark, sf).withColumn("partition_date", F.when(F.dayofmonth("report_date") % 10 == 0, F.date_add("report_date", 1)).otherwise(F.col("report_date")))
    shown = shown.withColumn("article_count", F.when(F.col("article_count") % 4 == 0, F.col("article_count") + 1).otherwise(F.col("article_count")))
    return ad.report_checks(shown, se.EDITION).select("feed_id", day(), "rule")


@query("edition_digest")
def edition_digest(spark, sf):
    editions = _editions(spark, sf)
    return editions.select("feed_id", day(), pb.edition_digest(editions).alias("digest"))


@query("shortfall_reason", """
SELECT user_id, CASE WHEN p >= 10 THEN 'normal' WHEN p >= 5 THEN 'graceful_degraded' WHEN p >= 1 THEN 'minimal_daily' ELSE 'true_failure' END AS daily_mode,
 CASE WHEN p >= 10 THEN NULL WHEN user_id % 7 = 0 THEN 'enrichment_fill_stopped_after_model_failure' WHEN user_id % 5 = 0 THEN 'token_budget_insufficient_for_next_batch'
 WHEN c < 10 THEN 'eligible_candidate_shortage' WHEN r > 0 THEN 'validation_rejections' ELSE 'final_selection_shortfall' END AS degraded_reason
FROM (SELECT user_id, count(*) FILTER (event_type = 'purchase' AND value > 20) AS p, count(*) FILTER (event_type = 'purchase') AS c, count(*) FILTER (event_type = 'error' AND value > 80) AS r FROM events GROUP BY 1)""")
def shortfall_reason(spark, sf):
    kind, value = F.col("event_type"), F.col("value")
    runs = v.table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if((kind == "purchase") & (value > 20)).alias("publishable"), F.count_if(kind == "purchase").alias("chosen"),
        F.count_if((kind == "error") & (value > 80)).alias("rejected"))
    runs = runs.select("*", (F.col("user_id") % 7 == 0).alias("fill_stopped"), F.when(F.col("user_id") % 5 == 0, "graceful_stop").otherwise("normal").alias("budget_status"))
    return pb.shortfall_reason(runs).select("user_id", "daily_mode", "degraded_reason")


@query("merge_pairs", EDITION_SQL + f"""
 SELECT ed.feed_id, {DAY_SQL.replace('report_date,', 'ed.report_date,')}, article_count, arg_min(title_en || ' (en)', pick) AS first_title,
 CAST(count(*) AS INTEGER) AS n FROM ed JOIN it USING (feed_id, report_date)
 WHERE article_count % 3 <> 0 GROUP BY ed.feed_id, ed.report_date, article_count""")
def merge_pairs(spark, sf):
    """Renderings applied by position; editions whose size is divisible by three lack the first one and stay out."""
    editions = _editions(spark, sf)
    rows = editions.select(*se.EDITION, "article_count", F.posexplode("items").alias("pos", "i"))
    pairs = rows.filter("article_count % 3 <> 0 OR pos > 0").select(
        *se.EDITION, "pos", F.concat("i.title_en", F.lit(" (en)")).alias("title_en"), *[f"i.{c}" for c in pb.PAIR_FIELDS if c != "title_en"])
    merged = pb.merge_pairs_by_id(editions, pairs, se.EDITION)
    return merged.select("feed_id", day(), "article_count", F.col("items")[0]["title_en"].alias("first_title"), F.size("items").alias("n"))
