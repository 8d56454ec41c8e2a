"""Saved audits and streaming twins over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.plans import views as v
from broadsheet.plans.catalog import query
from broadsheet.plans.health_queries import STATES_SQL
from broadsheet.plans.join_queries import ADMIT_SQL
from broadsheet.sources import audits as sa


@query("sources_for_date", v.sql(v.V_SOURCES, select="""
, r AS (SELECT doc_id % 130 AS sid FROM documents), c AS (SELECT CASE WHEN sid IN (SELECT source_id FROM v_sources) THEN CAST(sid AS VARCHAR) ELSE 'unassigned' END AS source_id, count(*) AS n FROM r GROUP BY 1)
SELECT coalesce(CAST(s.source_id AS VARCHAR), c.source_id) AS source_id, s.region, coalesce(c.n, 0) AS visible_article_count,
 CASE WHEN s.source_id % 2 = 0 THEN 'ok' END AS status FROM v_sources s FULL JOIN c ON c.source_id = CAST(s.source_id AS VARCHAR)"""))
def sources_for_date(spark, sf):
    registry = v.sources(spark, sf)
    rows = v.table(spark, sf, "documents").select((F.col("doc_id") % 130).alias("source_id"), F.col("doc_id").alias("article_id"))
    checks = registry.filter("source_id % 2 = 0").select("source_id", F.lit("ok").alias("status"), F.lit(1).alias("items"))
    return sa.sources_for_date(rows, checks, registry).select("source_id", "region", "visible_article_count", "status")


@query("pick_run", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, arg_max(CAST(o_orderkey AS VARCHAR), (o_orderpriority, CAST(o_orderkey AS VARCHAR))) AS run_id FROM orders GROUP BY 1""")
def pick_run(spark, sf):
    runs = v.table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderpriority").alias("end_time"),
                                               F.col("o_orderkey").cast("string").alias("run_id"))
    return sa.pick_run(runs, ["date"])


def _saved_audits(spark, sf):
    """The decisions written as saved audits, a run for each thousand orders and a JSON file for each run; an article is an order's
    place in its thousand, so runs share articles. Files of every seventh run are cut off, those of some others have no date."""
    from broadsheet.session import new_folder

    run, article = F.floor(F.col("article_id") / 1000), F.col("article_id") % 1000
    dec = v.decisions(spark, sf).select(run.cast("string").alias("run_id"), article.cast("string").alias("article_id"), "seq", "stage", "status", "reason")
    event = F.struct("seq", F.struct("stage", "status", "reason").alias("e"))
    # Dealt by run once, which serves both groupings and the writing; a run stays in one task, and so in one file.
    rows = dec.repartition("run_id").groupBy("run_id", "article_id").agg(F.transform(F.sort_array(F.collect_list(event)), lambda x: x["e"]).alias("events"))
    runs = rows.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct("article_id", F.concat(F.lit("http://example.com/"), "article_id").alias("original_url"), "events"))).alias("articles"))
    n = F.col("run_id").cast("int")
    date = F.when(n % 11 == 5, "some day").otherwise(F.concat(F.lit("2024-02-"), F.lpad((1 + n % 28).cast("string"), 2, "0")))
    body = F.to_json(F.struct("run_id", date.alias("date"), F.concat(date, F.lit("T00:00:00")).alias("end_time"), "articles"))
    body = F.when(n % 7 == 3, F.substr(body, F.lit(1), F.length(body) - 40)).otherwise(body)
    folder = new_folder(spark, "saved-audits")
    runs.select(F.col("run_id").alias("run"), body.alias("body")).write.partitionBy("run").text(folder)
    return folder


SAVED_SQL = v.sql(v.V_DECISIONS, select=""", saved AS (
 SELECT * EXCLUDE (run_id, article_id), article_id // 1000 AS run, CAST(article_id // 1000 AS VARCHAR) AS run_id, CAST(article_id % 1000 AS VARCHAR) AS article_id FROM v_decisions)""")


@query("saved_audits", SAVED_SQL + f" SELECT run_id, article_id, {STATES_SQL} FROM saved WHERE run % 7 <> 3 AND run % 11 <> 5 GROUP BY run_id, article_id")
def saved_audits(spark, sf):
    """Stage states of every article of every run, read back from the saved audits."""
    from broadsheet import fixed_values as fv

    return sa.article_rows(sa.valid_audits(spark, _saved_audits(spark, sf))).select("run_id", "article_id", *fv.VIEW_STAGES)


@query("quarantined_audits", SAVED_SQL + " SELECT DISTINCT run_id, CASE WHEN run % 7 = 3 THEN 'unreadable' ELSE 'no_date' END AS fault FROM saved WHERE run % 7 = 3 OR run % 11 = 5")
def quarantined_audits(spark, sf):
    out = sa.quarantined_audits(spark, _saved_audits(spark, sf))
    return out.select(F.regexp_extract("file", r"run=(\d+)/", 1).alias("run_id"), "fault")


@query("retroactive_audit", """
SELECT doc_id AS article_id, CASE WHEN quality IS NOT NULL THEN CASE WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END WHEN doc_id % 5 = 0 THEN 'batch_not_submitted' ELSE 'not_requested' END AS enrichment,
 CASE WHEN quality = 1 AND doc_id % 2 = 0 THEN 'publishable_candidate' WHEN quality = 0 THEN 'validation_failed' WHEN quality = 1 THEN 'final_selector_excluded'
  WHEN doc_id % 5 = 0 THEN 'batch_not_submitted' ELSE 'not_reached' END AS screening_status,
 CASE WHEN quality = 1 AND doc_id % 2 = 0 THEN 'offline_selected' WHEN quality = 0 THEN 'hard_facts' WHEN quality = 1 THEN CASE WHEN doc_id % 3 = 0 THEN 'duplicate_event' END
  WHEN doc_id % 5 = 0 THEN 'token_budget_guard' ELSE 'not_processed_before_budget_stop' END AS screening_reason
FROM documents LEFT JOIN labels USING (doc_id)""")
def retroactive_audit(spark, sf):
    docs = v.table(spark, sf, "documents").select(F.col("doc_id").alias("article_id"))
    labels = v.table(spark, sf, "labels").select(F.col("doc_id").alias("article_id"), "quality")
    checked = labels.select("article_id", F.when(F.col("quality") == 1, "accepted").otherwise("rejected").alias("status"),
                            F.when(F.col("quality") == 0, "hard_facts").alias("reject_stage"))
    final = labels.filter("quality = 1 and article_id % 2 = 0")
    drops = docs.filter("article_id % 3 = 0").withColumn("reason", F.lit("duplicate_event"))
    return sa.retroactive_audit(docs, checked, docs.filter("article_id % 5 = 0"), final, drops).select(
        "article_id", "enrichment", "screening_status", "screening_reason")


@query("stream_health", v.sql(v.V_HEALTH, select="""
, fine AS (SELECT source_id, max(id) AS last_fine FROM v_health WHERE status <> 'error' GROUP BY 1)
SELECT h.source_id, count(*) AS sample_count, count(*) FILTER (status = 'ok') AS success_count, count(*) FILTER (status = 'empty') AS empty_count,
 count(*) FILTER (status = 'error') AS failure_count, count(*) FILTER (status = 'error' AND (last_fine IS NULL OR id > last_fine)) AS consecutive_failures
FROM v_health h LEFT JOIN fine USING (source_id) GROUP BY 1"""))
def stream_health(spark, sf):
    """The streaming job over the whole event table, closed by one later event, then folded."""
    from broadsheet.session import new_folder
    from broadsheet.streaming import health as sh

    folder = new_folder(spark, "health-stream")
    events = v.health_events(spark, sf).select("source_id", "id", "checked_at", "status")
    events.write.parquet(f"{folder}/in/part=0")
    # Moves the watermark past the last hour; its own hour stays open.
    events.agg(F.lit(-1).cast("bigint").alias("source_id"), F.lit(-1).cast("bigint").alias("id"),
               (F.max("checked_at") + F.expr("INTERVAL 2 DAYS")).alias("checked_at"), F.lit("ok").alias("status")).write.parquet(f"{folder}/in/part=1")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in/part=*")
    job = sh.stream_health(stream).writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    job.awaitTermination()
    out = sh.fold_hours(spark.read.schema(sh.PARTIAL).parquet(f"{folder}/out"))
    return out.select("source_id", "sample_count", "success_count", "empty_count", "failure_count", "consecutive_failures")


@query("stream_drop_reasons", """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS stage, 'r' || CAST(user_id % 7 AS VARCHAR) AS reason, count(*) AS drops FROM events WHERE event_id % 2 = 0 GROUP BY ALL""")
def stream_drop_reasons(spark, sf):
    from broadsheet.session import new_folder
    from broadsheet.streaming.articles import stream_drop_reasons as drops

    folder = new_folder(spark, "drops-stream")
    rows = v.table(spark, sf, "events").select(
        "ts", F.col("event_type").alias("stage"), F.when(F.col("event_id") % 2 == 0, "dropped").otherwise("kept").alias("status"),
        F.concat(F.lit("r"), (F.col("user_id") % 7).cast("string")).alias("reason"))
    rows.write.parquet(f"{folder}/in/part=0")
    rows.agg((F.max("ts") + F.expr("INTERVAL 5 DAYS")).alias("ts"), F.lit("closing").alias("stage"), F.lit("dropped").alias("status"),
             F.lit("closing").alias("reason")).write.parquet(f"{folder}/in/part=1")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in/part=*")
    job = drops(stream).writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    job.awaitTermination()
    return spark.read.schema("day date, stage string, reason string, drops long").parquet(f"{folder}/out").select(
        F.col("day").cast("string"), "stage", "reason", "drops")


@query("late_rows", """
, late AS (SELECT DISTINCT CAST(ts AS DATE) AS day, event_type, user_id % 7 AS r FROM events, (SELECT max(ts) AS newest FROM events), (
    SELECT max(ts) AS seen FROM events, (SELECT max(ts) - INTERVAL 3 DAY AS cut FROM events) WHERE ts >= cut AND event_id % 4 = 0)
  WHERE event_id % 2 = 0 AND ts < newest - INTERVAL 3 DAY AND CAST(ts AS DATE) + INTERVAL 1 DAY <= seen - INTERVAL 1 DAY)
SELECT sum(n)::BIGINT AS dropped FROM (SELECT count(*) AS n FROM late)""".replace(", late AS", "WITH late AS", 1))
def late_rows(spark, sf):
    """Drops of the newest days arrive in two files and those of all days before in a third, of which the watermark refuses all
    closed days: how many groups of the third file came too late."""
    from broadsheet.session import new_folder
    from broadsheet.streaming.articles import stream_drop_reasons as drops
    from broadsheet.streaming.progress import LateRows

    folder = new_folder(spark, "late")
    rows = v.table(spark, sf, "events").filter("event_id % 2 = 0").select(
        "event_id", "ts", F.col("event_type").alias("stage"), F.lit("dropped").alias("status"), F.concat(F.lit("r"), (F.col("user_id") % 7).cast("string")).alias("reason"))
    newest = v.table(spark, sf, "events").agg(F.max("ts").alias("ts")).first()["ts"]
    recent = F.col("ts") >= F.lit(newest) - F.expr("INTERVAL 3 DAYS")
    for part, test in enumerate((recent & (F.col("event_id") % 4 == 0), recent & (F.col("event_id") % 4 != 0), ~recent)):
        rows.filter(test).drop("event_id").coalesce(1).write.parquet(f"{folder}/in/part={part}")
    stream = spark.readStream.schema(rows.drop("event_id").schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/part=*")
    listener = LateRows(spark, f"{folder}/late")
    spark.streams.addListener(listener)
    try:
        job = drops(stream).writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        job.awaitTermination()
        if not listener.wait(str(job.id)):
            raise RuntimeError("the end of the query was not reported")
    finally:
        spark.streams.removeListener(listener)
    return spark.read.parquet(f"{folder}/late").agg(F.sum("dropped").alias("dropped"))


@query("stream_articles", v.sql(v.V_ARTICLES, select=ADMIT_SQL.format(order="doc_id % 3, published_at DESC, doc_id", rows="v_articles", urls="[]", prints="[]") + """
SELECT doc_id, doc_id % 3 AS batch_id FROM walk WHERE doc_id IS NOT NULL""").replace("WITH ", "WITH RECURSIVE ", 1))
def stream_articles(spark, sf):
    """All articles, copies of URLs and texts included, arriving as a stream of three deliveries, each taken in before the next."""
    from broadsheet.session import new_folder
    from broadsheet.streaming.articles import stream_articles as intake

    folder = new_folder(spark, "articles-stream")
    art = v.articles(spark, sf, labels=False).select("doc_id", "original_url", "fingerprint", "published_at", "published_date")
    for part in range(3):
        art.filter(F.col("doc_id") % 3 == part).write.parquet(f"{folder}/in/part={part}")
        stream = spark.readStream.schema(art.schema).parquet(f"{folder}/in/part=*")
        intake(stream, f"{folder}/table", f"{folder}/state", seq="doc_id").awaitTermination()
    return spark.read.parquet(f"{folder}/table").select("doc_id", F.col("batch_id").cast("long").alias("batch_id"))
