"""Bindings of the operators' inputs to the driver tables, in Spark and as SQL CTEs.

The text in the tables is synthetic, so the topical patterns take their terms
from here; everything else follows the operators' defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.functions import text as tx
from broadsheet.session import spread

TOPIC = "the|and|est|und|que"
IMPACT = "ing"
DEEP = "the|que|und"
EPOCH = 1_704_067_200  # 2024-01-01 00:00:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its zone-less timestamps are read as UTC instants, so filters still push down."""
    path = f"{sf_dir}/{name}.parquet"
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.TimestampType() if f.dataType == T.TimestampNTZType() else f.dataType)
              for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def articles(spark: SparkSession, sf_dir: str, labels: bool = True) -> DataFrame:
    """Documents as articles; cleaning and hashing cost nothing where they are not selected. Only `importance` needs the
    labels, whose join shuffles the texts; without `labels` there is neither."""
    doc = F.col("doc_id")
    df = spread(table(spark, sf_dir, "documents"))
    if labels:
        df = df.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    url_id = F.when(doc % 25 == 24, doc - 1).otherwise(doc)
    df = df.select(
        doc,
        (doc % 3).cast("int").alias("feed_id"),
        F.concat(F.lit("https://example.com/"), url_id.cast("string")).alias("original_url"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("raw_text"),
        F.timestamp_seconds(F.lit(EPOCH) + (doc * 37 % 720) * 3600).alias("published_at"),
        "source",
        F.col("lang").alias("language"),
        (1 + doc % 4).cast("int").alias("source_tier"),
        F.when(doc % 4 == 3, "discovery").when(doc % 7 < 3, "primary").otherwise("media").alias("source_role"),
        F.when(doc % 5 == 0, "official_changelog").otherwise("official_blog").alias("source_type"),
        _pick(("ai", "chips", "science", "software", "policy"), doc % 5).alias("category"),
        F.when(doc % 50 == 49, "unverified").otherwise("source_verified").alias("verification_status"),
        *[(40 + 45 * F.col("quality") + doc % 11).cast("int").alias("importance")] * labels,
    )
    return df.select(
        "*",
        F.to_date("published_at").alias("published_date"),
        F.when(F.col("category") == "policy", "policy_economy").otherwise("technology").alias("channel"),
        tx.article_id(F.col("original_url")).alias("id"),
        tx.clean_text(F.col("raw_text")).alias("clean_text"),
        tx.fingerprint(F.col("title"), F.col("raw_text")).alias("fingerprint"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = articles(spark, sf_dir, labels=False).filter(F.col("doc_id") % 13 == 0)
    return df.withColumn("report_date", F.date_add("published_date", 1))


def editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One edition per feed and day of the covered month, derived from the articles."""
    feeds = articles(spark, sf_dir, labels=False).select("feed_id").distinct()
    days = F.expr("explode(sequence(date '2024-01-02', date '2024-01-31', interval 1 day))")
    return feeds.select("feed_id", days.alias("report_date")).withColumn(
        "now_ts", F.col("report_date").cast("timestamp"))


def enrichments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cached rendering for every labelled, verified article; a few are stale or mismatched."""
    doc = F.col("doc_id")
    df = articles(spark, sf_dir).filter(F.col("importance").isNotNull())
    half = F.ceil(F.length("raw_text") / 2).cast("int")  # the halves of the whole text are its two renderings
    first, second = F.substr("raw_text", F.lit(1), half), F.substr("raw_text", half + 1)
    return df.select(
        doc, F.col("id").alias("article_id"),
        F.when(doc % 17 == 0, "old-task").otherwise(fv.ENRICH_TASK).alias("task"),
        F.when(doc % 19 == 0, "").otherwise("model-a").alias("model"),
        (F.col("published_at") + F.expr("INTERVAL 1 HOUR")).alias("generated_at"),
        F.col("title").alias("title_original"), F.col("title").alias("title_en"), F.col("title").alias("title_cn"),
        F.when(doc % 23 == 0, "elsewhere").otherwise(F.col("source")).alias("source"),
        "published_at", "original_url", "category",
        first.alias("what_happened_en"), first.alias("what_happened"),
        F.when(doc % 29 == 0, "").otherwise(second).alias("why_it_matters_en"), second.alias("why_it_matters"),
        F.col("importance").alias("importance_score"),
    )


def health_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("source_id"), F.col("ts").alias("checked_at"),
        F.col("value").alias("duration_ms"),
        F.when(kind == "signup", "empty").when(kind == "error", "error").otherwise("ok").alias("status"),
        F.when(kind == "error", F.when(F.col("value") < 10, "timeout").otherwise("network")).alias("error_kind"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts"), F.col("user_id"), F.to_date("ts").alias("day"),
        F.when(kind == "signup", 404).when(kind == "error", None).otherwise(200).cast("int").alias("http_status"),
        F.when(F.col("event_id") % 2 == 0, "h5").otherwise("json").alias("kind"),
    )


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.to_date("ts").alias("day"), "ts",
        F.floor(F.col("value") * 100).cast("bigint").alias("required"),
        F.floor(F.col("value") * 60).cast("bigint").alias("used"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = (F.col("l_quantity") * 100).cast("bigint")
    inputs = (F.col("l_quantity") * 70).cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("created_at"), F.col("l_returnflag").alias("task"),
        F.col("l_linestatus").alias("model"), total.alias("total_tokens"), inputs.alias("input_tokens"),
        (total - inputs).alias("output_tokens"),
        F.when(F.col("l_linenumber") % 2 == 0, inputs).alias("prompt_cache_hit_tokens"),
        F.when(F.col("l_linenumber") % 2 == 1, inputs).alias("prompt_cache_miss_tokens"),
    )


STAGE_NAMES = ("collection", "normalization", "initial_candidate_pool", "enrichment", "validation",
               "final_selection", "publishable")


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as audit events; `seq` is an order key inside an article, not a dense number."""
    df = table(spark, sf_dir, "lineitem")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    return df.select(
        (F.col("l_orderkey") % 50).alias("run_id"), F.col("l_orderkey").alias("article_id"), order.alias("seq"),
        _pick(STAGE_NAMES, F.col("l_linenumber") - 1).alias("stage"),
        F.when(F.col("l_linestatus") == "O", "kept").otherwise("dropped").alias("status"),
        F.concat(F.lit("r"), (F.col("l_suppkey") % 7).cast("string")).alias("reason"),
        F.col("l_quantity").cast("int").alias("importance_score"),
        F.when(F.col("l_tax") > 0.04, F.col("l_returnflag") == "R").alias("is_today"),
        F.when(F.col("l_discount") > 0.05, F.col("l_returnflag")).alias("supply_layer"),
    )


def dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("report_date"), F.col("o_custkey").alias("report_id"),
        F.lit("chat").alias("target_type"), (F.col("o_orderkey") % 5).alias("target_id"),
        F.element_at(F.create_map(F.lit("O"), F.lit("pending"), F.lit("F"), F.lit("sent"), F.lit("P"), F.lit("failed")),
                     F.col("o_orderstatus")).alias("status"),
        (F.col("o_orderpriority") == "1-URGENT").alias("force_resend"),
        F.col("o_orderdate").alias("updated_at"), F.col("o_orderkey").alias("attempt_id"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("name"), F.col("n_name").alias("region"),
        (1 + F.col("s_suppkey") % 4).cast("int").alias("tier"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"))


# --- The same bindings as SQL CTEs -------------------------------------------------
def clean_sql(source: str, columns: dict[str, tuple[str, str]], limit: int = 18000) -> str:
    """CTE chain adding cleaned columns: {new_column: (cte_suffix, expression)} over `source`."""
    chain, current = [], source
    for new, (tag, expression) in columns.items():
        chain.append(f"""
{tag}_w AS (SELECT *, string_split(trim(regexp_replace({expression}, '{tx.SPACES}', ' ', 'g')), ' ') AS {tag}_words FROM {current}),
{tag}_k AS (SELECT *, list_transform(range(1, len({tag}_words) + 1, 18),
    lambda i: array_to_string(list_slice({tag}_words, i, i + 17), ' ')) AS {tag}_chunks FROM {tag}_w),
{tag}_c AS (SELECT * EXCLUDE ({tag}_words, {tag}_chunks), trim(substr(CASE WHEN len({tag}_words) > 18
    THEN array_to_string(list_filter({tag}_chunks, lambda c, i: list_position({tag}_chunks, c) = i), ' ')
    ELSE array_to_string({tag}_words, ' ') END, 1, {limit})) AS {new} FROM {tag}_k)""")
        current = f"{tag}_c"
    return ",".join(chain)


V_BASE = """
v_base AS (
  SELECT doc_id, CAST(doc_id % 3 AS INTEGER) AS feed_id,
    'https://example.com/' || CAST(CASE WHEN doc_id % 25 = 24 THEN doc_id - 1 ELSE doc_id END AS VARCHAR) AS original_url,
    split_part(text, chr(10), 1) AS title, text AS raw_text,
    TIMESTAMP '2024-01-01' + to_hours(CAST((doc_id * 37) % 720 AS INTEGER)) AS published_at,
    CAST(TIMESTAMP '2024-01-01' + to_hours(CAST((doc_id * 37) % 720 AS INTEGER)) AS DATE) AS published_date,
    source, lang AS language, CAST(1 + doc_id % 4 AS INTEGER) AS source_tier,
    CASE WHEN doc_id % 4 = 3 THEN 'discovery' WHEN doc_id % 7 < 3 THEN 'primary' ELSE 'media' END AS source_role,
    CASE WHEN doc_id % 5 = 0 THEN 'official_changelog' ELSE 'official_blog' END AS source_type,
    ['ai','chips','science','software','policy'][CAST(doc_id % 5 AS INTEGER) + 1] AS category,
    CASE WHEN doc_id % 5 = 4 THEN 'policy_economy' ELSE 'technology' END AS channel,
    CASE WHEN doc_id % 50 = 49 THEN 'unverified' ELSE 'source_verified' END AS verification_status,
    CAST(40 + 45 * quality + doc_id % 11 AS INTEGER) AS importance
  FROM documents LEFT JOIN labels USING (doc_id)),
v_ids AS (SELECT *, sha256(original_url) AS id FROM v_base)"""

V_ARTICLES = V_BASE + "," + clean_sql("v_ids", {"clean_text": ("b", "raw_text"), "clean_title": ("t", "title")}) + """,
v_articles AS (SELECT *, sha256(lower(clean_title) || chr(10) || lower(substr(clean_text, 1, 1500))) AS fingerprint FROM t_c)"""

V_HISTORY = V_ARTICLES + """,
v_history AS (SELECT *, published_date + 1 AS report_date FROM v_articles WHERE doc_id % 13 = 0)"""

V_EDITIONS = """
v_editions AS (SELECT feed_id, CAST(d AS DATE) AS report_date, CAST(d AS TIMESTAMP) AS now_ts
  FROM (SELECT DISTINCT feed_id FROM v_base),
       (SELECT unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS d))"""

V_ENRICHMENTS = f"""
v_enrichments AS (SELECT doc_id, id AS article_id,
    CASE WHEN doc_id % 17 = 0 THEN 'old-task' ELSE '{fv.ENRICH_TASK}' END AS task,
    CASE WHEN doc_id % 19 = 0 THEN '' ELSE 'model-a' END AS model,
    published_at + INTERVAL 1 HOUR AS generated_at, title AS title_original, title AS title_en, title AS title_cn,
    CASE WHEN doc_id % 23 = 0 THEN 'elsewhere' ELSE source END AS source, published_at, original_url, category,
    substr(raw_text, 1, (length(raw_text) + 1) // 2) AS what_happened_en, substr(raw_text, 1, (length(raw_text) + 1) // 2) AS what_happened,
    CASE WHEN doc_id % 29 = 0 THEN '' ELSE substr(raw_text, (length(raw_text) + 1) // 2 + 1) END AS why_it_matters_en,
    substr(raw_text, (length(raw_text) + 1) // 2 + 1) AS why_it_matters, importance AS importance_score
  FROM v_ids WHERE importance IS NOT NULL)"""

V_HEALTH = """
v_health AS (SELECT event_id AS id, user_id AS source_id, ts AS checked_at, value AS duration_ms,
    CASE event_type WHEN 'signup' THEN 'empty' WHEN 'error' THEN 'error' ELSE 'ok' END AS status,
    CASE WHEN event_type = 'error' THEN CASE WHEN value < 10 THEN 'timeout' ELSE 'network' END END AS error_kind
  FROM events)"""

V_ATTEMPTS = """
v_attempts AS (SELECT event_id, ts, user_id, CAST(ts AS DATE) AS day,
    CASE event_type WHEN 'signup' THEN 404 WHEN 'error' THEN NULL ELSE 200 END AS http_status,
    CASE WHEN event_id % 2 = 0 THEN 'h5' ELSE 'json' END AS kind FROM events)"""

V_BATCHES = """
v_batches AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, ts,
    CAST(floor(value * 100) AS BIGINT) AS required, CAST(floor(value * 60) AS BIGINT) AS used FROM events)"""

V_LEDGER = """
v_ledger AS (SELECT l_shipdate AS created_at, l_returnflag AS task, l_linestatus AS model,
    CAST(l_quantity * 100 AS BIGINT) AS total_tokens, CAST(l_quantity * 70 AS BIGINT) AS input_tokens,
    CAST(l_quantity * 100 AS BIGINT) - CAST(l_quantity * 70 AS BIGINT) AS output_tokens,
    CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity * 70 AS BIGINT) END AS prompt_cache_hit_tokens,
    CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_quantity * 70 AS BIGINT) END AS prompt_cache_miss_tokens
  FROM lineitem)"""

V_DECISIONS = """
v_decisions AS (SELECT l_orderkey % 50 AS run_id, l_orderkey AS article_id,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS seq,
    ['collection','normalization','initial_candidate_pool','enrichment','validation','final_selection','publishable'][l_linenumber] AS stage,
    CASE WHEN l_linestatus = 'O' THEN 'kept' ELSE 'dropped' END AS status, 'r' || CAST(l_suppkey % 7 AS VARCHAR) AS reason,
    CAST(l_quantity AS INTEGER) AS importance_score,
    CASE WHEN l_tax > 0.04 THEN l_returnflag = 'R' END AS is_today,
    CASE WHEN l_discount > 0.05 THEN l_returnflag END AS supply_layer
  FROM lineitem)"""

V_DISPATCH = """
v_dispatch AS (SELECT CAST(o_orderdate AS DATE) AS report_date, o_custkey AS report_id, 'chat' AS target_type,
    o_orderkey % 5 AS target_id,
    CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'sent' WHEN 'P' THEN 'failed' END AS status,
    o_orderpriority = '1-URGENT' AS force_resend, o_orderdate AS updated_at, o_orderkey AS attempt_id FROM orders)"""

V_SOURCES = """
v_sources AS (SELECT s_suppkey AS source_id, s_name AS name, n_name AS region, CAST(1 + s_suppkey % 4 AS INTEGER) AS tier
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def sql(*views: str, select: str) -> str:
    return "WITH " + ",".join(views) + "\n" + select
