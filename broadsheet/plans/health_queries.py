"""Source health, token ledger, dispatch and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.operators import audit as au
from broadsheet.operators import health as he
from broadsheet.operators import ledger as le
from broadsheet.operators import ordered as od
from broadsheet.plans import views as v
from broadsheet.plans.catalog import query
from broadsheet.plans.join_queries import stamp, stamp_sql


def text_stamp(column: str, alias: str | None = None):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(alias or column)


def micro_sql(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {alias or column}"


@query("source_health_metrics", v.sql(v.V_HEALTH, select=f"""
, fine AS (SELECT source_id, max(id) AS last_fine FROM v_health WHERE status NOT IN ('error','timeout','failed') GROUP BY source_id),
streak AS (SELECT h.source_id, count(*) AS n FROM v_health h LEFT JOIN fine USING (source_id)
  WHERE h.status IN ('error','timeout','failed') AND (last_fine IS NULL OR h.id > last_fine) GROUP BY h.source_id)
SELECT h.source_id, count(*) FILTER (status = 'ok') AS success_count, count(*) FILTER (error_kind = 'timeout') AS timeout_count,
  count(*) FILTER (status = 'empty') AS empty_count, count(*) FILTER (status = 'error' AND error_kind <> 'timeout') AS failure_count,
  ((2 * CAST(sum(CAST(round(duration_ms * 1000000) AS BIGINT)) AS BIGINT) + count(*) * 10000) // (2 * count(*) * 10000)) / 100::DOUBLE AS average_duration_ms, count(*) AS sample_count, count(duration_ms) AS duration_sample_count,
  CASE WHEN count(duration_ms) >= 20 THEN list_sort(list(duration_ms))[CAST(ceil(0.95::DOUBLE * count(duration_ms)) AS BIGINT)] END AS p95_duration_ms,
  coalesce(any_value(s.n), 0) AS consecutive_failures,
  {micro_sql("max(checked_at) FILTER (status = 'ok')", 'last_success_at')}, {micro_sql('min(checked_at)', 'statistics_since')}
FROM v_health h LEFT JOIN streak s ON h.source_id = s.source_id GROUP BY h.source_id"""))
def source_health_metrics(spark, sf):
    events = v.health_events(spark, sf)
    out = he.source_health_metrics(events, he.health_snapshot(events))
    return out.select("source_id", "success_count", "timeout_count", "empty_count", "failure_count", "average_duration_ms",
                      "sample_count", "duration_sample_count", "p95_duration_ms", "consecutive_failures",
                      text_stamp("last_success_at"), text_stamp("statistics_since"))


@query("health_snapshot", v.sql(v.V_HEALTH, select=f"""
SELECT source_id, arg_max(status, id) AS status, {micro_sql('arg_max(checked_at, id)', 'checked_at')},
  {micro_sql("arg_max(checked_at, id) FILTER (status = 'ok')", 'latest_success_at')} FROM v_health GROUP BY source_id"""))
def health_snapshot(spark, sf):
    return he.health_snapshot(v.health_events(spark, sf)).select(
        "source_id", "status", text_stamp("checked_at"), text_stamp("latest_success_at"))


JOINED_SQL = """
, snap AS (SELECT source_id, arg_max(status, id) AS status FROM v_health GROUP BY source_id),
joined AS (SELECT s.source_id, s.region, s.tier, coalesce(n.status, 'not_checked') AS health_status FROM v_sources s LEFT JOIN snap n USING (source_id))"""


@query("sources_health_join", v.sql(v.V_HEALTH, v.V_SOURCES, select=JOINED_SQL + " SELECT * FROM joined"))
def sources_health_join(spark, sf):
    out = he.sources_health_join(v.sources(spark, sf), he.health_snapshot(v.health_events(spark, sf)))
    return out.select("source_id", "region", "tier", "health_status")


@query("health_summary", v.sql(v.V_HEALTH, v.V_SOURCES, select=JOINED_SQL + """
SELECT count(*) AS enabled, count(*) FILTER (health_status = 'ok') AS healthy, count(*) FILTER (health_status = 'error') AS failed,
  count(*) FILTER (health_status = 'empty') AS empty FROM joined"""))
def health_summary(spark, sf):
    return he.health_summary(he.sources_health_join(v.sources(spark, sf), he.health_snapshot(v.health_events(spark, sf))))


@query("run_source_counts", v.sql(v.V_HEALTH, select="""
SELECT strftime(checked_at, '%Y-%m-%d') AS run, count(*) AS sources_attempted, count(*) FILTER (status = 'ok') AS sources_ok,
  count(*) FILTER (status = 'empty') AS sources_empty, count(*) FILTER (status = 'error') AS sources_failed FROM v_health GROUP BY 1"""))
def run_source_counts(spark, sf):
    return he.run_source_counts(v.health_events(spark, sf), F.date_format("checked_at", "yyyy-MM-dd"))


@query("snapshot_of_date", v.sql(v.V_HEALTH, select="""
SELECT bucket, CASE WHEN min(d) = max(d) THEN strftime(min(d), '%Y-%m-%d') END AS snapshot_date
FROM (SELECT id // 5 AS bucket, CAST(checked_at + INTERVAL 8 HOUR AS DATE) AS d FROM v_health) GROUP BY bucket"""))
def snapshot_of_date(spark, sf):
    checks = v.health_events(spark, sf).withColumn("bucket", F.floor(F.col("id") / 5))
    return he.snapshot_of_date(checks, ["bucket"]).select("bucket", F.col("snapshot_date").cast("string"))


@query("unambiguous_source_lookup", v.sql(v.V_BASE, select="""
, names AS (SELECT n_name AS name, count(*) AS n, min(s_suppkey) AS sid FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT page_id, n_name AS source, CASE WHEN n = 1 THEN sid END AS inferred_source_id
FROM pages JOIN nation ON n_nationkey = page_id % 25 LEFT JOIN names ON names.name = n_name"""))
def unambiguous_source_lookup(spark, sf):
    nation = v.table(spark, sf, "nation")
    named = v.pages(spark, sf).join(nation, F.col("page_id") % 25 == F.col("n_nationkey")).select("page_id", F.col("n_name").alias("source"))
    registry = v.sources(spark, sf).select("source_id", F.col("region").alias("name"))
    return he.unambiguous_source_lookup(named, registry).select("page_id", "source", "inferred_source_id")


# --- ledger ------------------------------------------------------------------------------
@query("daily_tokens", v.sql(v.V_LEDGER, select="""
SELECT strftime(d, '%Y-%m-%d') AS day, CAST(coalesce(t.total, 0) AS BIGINT) AS total_tokens FROM
 (SELECT unnest(generate_series((SELECT min(created_at) FROM v_ledger), (SELECT max(created_at) FROM v_ledger), INTERVAL 1 DAY)) AS d)
 LEFT JOIN (SELECT CAST(created_at AS DATE) AS k, sum(total_tokens) AS total FROM v_ledger GROUP BY 1) t ON CAST(d AS DATE) = t.k"""))
def daily_tokens(spark, sf):
    return le.daily_tokens(v.ledger(spark, sf)).select(F.col("day").cast("string"), "total_tokens")


ROLLUP = """count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens, CAST(sum(coalesce(prompt_cache_hit_tokens, 0)) AS BIGINT) AS cache_hit_tokens,
  CAST(sum(coalesce(prompt_cache_miss_tokens, 0)) AS BIGINT) AS cache_miss_tokens"""


@query("usage_rollup", v.sql(v.V_LEDGER, select=f"SELECT strftime(created_at, '%Y-%m-%d') AS day, {ROLLUP} FROM v_ledger GROUP BY 1"))
def usage_rollup(spark, sf):
    return le.usage_rollup(v.ledger(spark, sf), [F.date_format("created_at", "yyyy-MM-dd").alias("day")])


@query("append_usage", """
SELECT event_id, CAST(user_id * 10 AS BIGINT) AS input_tokens, CAST(event_id % 97 AS BIGINT) AS output_tokens,
  CAST(user_id * 10 + event_id % 97 AS BIGINT) AS total_tokens,
  CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS BIGINT) END AS reasoning_tokens FROM events""")
def append_usage(spark, sf):
    ev = v.table(spark, sf, "events")
    usage = F.to_json(F.struct(
        (F.col("user_id") * 10).alias("prompt_tokens"), (F.col("event_id") % 97).alias("completion_tokens"),
        (F.col("user_id") * 10 + F.col("event_id") % 97).alias("total_tokens"), F.col("props").alias("vendor_field"),
        F.when(F.col("event_id") % 3 == 0, F.struct(F.col("user_id").alias("reasoning_tokens"))).alias("completion_tokens_details")))
    out = le.flatten_usage(ev.select("event_id", usage.alias("raw_usage_json")))
    return out.select("event_id", "input_tokens", "output_tokens", "total_tokens", "reasoning_tokens")


@query("budget_admission", v.sql(v.V_BATCHES, select="""
, run AS (SELECT *, CAST(coalesce(sum(used) OVER (PARTITION BY user_id, day ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS used_before,
  row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS pos FROM v_batches),
stop AS (SELECT user_id, day, min(pos) AS stop_pos FROM run WHERE used_before + required > 6000 GROUP BY 1, 2)
SELECT event_id, used_before, stop_pos IS NULL OR pos < stop_pos AS admitted,
  CASE WHEN stop_pos IS NULL OR pos < stop_pos THEN 'normal' WHEN used_before >= 1 THEN 'graceful_stop' ELSE 'exhausted_before_minimum' END AS budget_status
FROM run LEFT JOIN stop USING (user_id, day)"""))
def budget_admission(spark, sf):
    out = le.budget_admission(v.batches(spark, sf), ["user_id", "day"], F.date_trunc("hour", "ts"), ["ts", "event_id"],
                              F.struct("ts", "event_id"), budget=6000)
    return out.select("event_id", F.col("used_before").cast("bigint"), "admitted", "budget_status")


NEED_SQL = "(greatest((c{0} + 2) // 3, CAST(ceil(c{0} / 2) AS BIGINT)) + least(7200, greatest(1800, (7200 * members + 11) // 12)) + greatest(256, CAST(ceil(greatest((c{0} + 2) // 3, CAST(ceil(c{0} / 2) AS BIGINT)) * 0.1::DOUBLE) AS BIGINT)))"
GRID = list(range(4000, 1199, -200))


@query("char_limit_plan", v.sql(v.V_BASE, select=f"""
, b AS (SELECT feed_id, CAST(floor(epoch(published_at) / 86400) AS BIGINT) AS day_no, count(*) AS members, {', '.join(f'CAST(sum(least(length(raw_text), {g})) AS BIGINT) AS c{g}' for g in GRID)} FROM v_base GROUP BY 1, 2),
own AS (SELECT *, CASE {' '.join(f'WHEN {NEED_SQL.format(g)} <= 20000 THEN {g}' for g in GRID)} ELSE 1200 END AS own_limit FROM b),
lim AS (SELECT *, min(own_limit) OVER (PARTITION BY feed_id ORDER BY day_no) AS char_limit FROM own)
SELECT feed_id, day_no, members, CAST(char_limit AS INTEGER) AS char_limit, need AS required_tokens, need <= 20000 AS fits
FROM (SELECT *, CASE {' '.join(f'WHEN char_limit = {g} THEN {NEED_SQL.format(g)}' for g in GRID)} END AS need FROM lim)"""))
def char_limit_plan(spark, sf):
    art = v.articles(spark, sf).select("feed_id", F.floor(F.unix_seconds("published_at") / 86400).cast("bigint").alias("day_no"),
                                       F.length("raw_text").alias("chars"))
    return le.char_limit_plan(art, ["feed_id", "day_no"], ["feed_id"], F.lit(20000))


@query("observed_ratio", v.sql(v.V_BATCHES, select="""
SELECT event_id, round(coalesce(max(CASE WHEN used > 0 AND required > 0 THEN used::DOUBLE / required END) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS observed_ratio FROM v_batches"""))
def observed_ratio(spark, sf):
    batches = v.batches(spark, sf).select("event_id", "user_id", "ts", F.col("used").alias("prompt_tokens"), F.col("required").alias("chars"))
    out = le.observed_ratio(batches, ["user_id"], F.date_trunc("day", "ts"), ["ts", "event_id"])
    return out.select("event_id", F.round("observed_ratio", 6).alias("observed_ratio"))


@query("batch_rollup", """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, CAST(sum(CASE WHEN event_type <> 'error' THEN floor(value * 40) END) AS BIGINT) AS prompt_tokens,
  CAST(sum(CASE WHEN event_type <> 'error' THEN floor(value * 20) END) AS BIGINT) AS completion_tokens,
  CAST(sum(CASE WHEN event_type <> 'error' THEN floor(value * 60) END) AS BIGINT) AS total_tokens,
  count(*) - 1 AS retry_count, arg_max(event_type, event_id) AS finish_reason FROM events GROUP BY 1, 2""")
def batch_rollup(spark, sf):
    def tokens(factor):
        return F.when(F.col("event_type") != "error", F.floor(F.col("value") * factor).cast("bigint"))

    ev = v.table(spark, sf, "events").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", F.col("event_type").alias("finish_reason"),
        tokens(40).alias("prompt_tokens"), tokens(20).alias("completion_tokens"), tokens(60).alias("total_tokens"))
    return le.batch_rollup(ev, ["user_id", "day"], F.col("event_id"))


@query("readiness_summary", v.sql(v.V_ATTEMPTS, select=f"""
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, {micro_sql('h5', 'h5_first_200_at')}, {micro_sql('js', 'json_first_200_at')},
  ((epoch_us(CASE WHEN h5 IS NOT NULL AND js IS NOT NULL THEN greatest(h5, js) ELSE hi END) - epoch_us(lo) + 5) // 10) / 100::DOUBLE AS readiness_total_ms,
  CASE WHEN h5 IS NOT NULL AND js IS NOT NULL THEN 'ready' ELSE 'publish_verification_failed' END AS readiness_result
FROM (SELECT user_id, day, min(ts) AS lo, max(ts) AS hi, min(ts) FILTER (kind = 'h5' AND http_status = 200) AS h5,
  min(ts) FILTER (kind = 'json' AND http_status = 200) AS js FROM v_attempts GROUP BY 1, 2)"""))
def readiness_summary(spark, sf):
    out = le.readiness_summary(v.attempts(spark, sf), ["user_id", "day"])
    return out.select("user_id", F.col("day").cast("string"), text_stamp("h5_first_200_at"), text_stamp("json_first_200_at"),
                      "readiness_total_ms", "readiness_result")


@query("retry_counts", v.sql(v.V_ATTEMPTS, select="SELECT user_id, strftime(day, '%Y-%m-%d') AS day, count(*) - 1 AS retry_count FROM v_attempts GROUP BY 1, 2"))
def retry_counts(spark, sf):
    return le.retry_counts(v.attempts(spark, sf), ["user_id", "day"]).select("user_id", F.col("day").cast("string"), "retry_count")


@query("dispatch_pending", v.sql(v.V_DISPATCH, select="""
SELECT attempt_id FROM v_dispatch d WHERE force_resend AND NOT EXISTS (SELECT 1 FROM v_dispatch l WHERE NOT l.force_resend
  AND l.report_date = d.report_date AND l.report_id = d.report_id AND l.target_id = d.target_id)"""))
def dispatch_pending(spark, sf):
    ledger = v.dispatch(spark, sf)
    return le.dispatch_pending(ledger.filter("force_resend"), ledger).select("attempt_id")


@query("dispatch_state", v.sql(v.V_DISPATCH, select=f"""
SELECT report_id, target_id, arg_max(status, attempt_id) AS status, count(*) - 1 AS retry_count,
  CASE WHEN arg_max(status, attempt_id) = 'sent' THEN {micro_sql('arg_max(updated_at, attempt_id)', 'x').replace(' AS x', '')} END AS sent_at
FROM v_dispatch GROUP BY 1, 2"""))
def dispatch_state(spark, sf):
    out = le.dispatch_state(v.dispatch(spark, sf), ["report_id", "target_id"], F.col("attempt_id"))
    return out.select("report_id", "target_id", "status", "retry_count", text_stamp("sent_at"))


@query("illegal_dispatch", "SELECT o_orderkey AS attempt_id, o_orderstatus AS illegal_status FROM orders WHERE o_orderstatus <> 'P'")
def illegal_dispatch(spark, sf):
    raw = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("attempt_id"),
                                              F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.col("o_orderstatus")).alias("status"))
    return le.illegal_dispatch(raw)


# --- audit -----------------------------------------------------------------------------------
@query("drop_reasons", v.sql(v.V_DECISIONS, select="SELECT stage, reason, count(*) AS drops FROM v_decisions WHERE status = 'dropped' GROUP BY 1, 2"))
def drop_reasons(spark, sf):
    return au.drop_reasons(v.decisions(spark, sf))


@query("stage_stats", v.sql(v.V_DECISIONS, select="""
SELECT stage, CAST(sum(n) AS BIGINT) AS occurrences, CAST(sum(k) AS BIGINT) AS kept, CAST(sum(d) AS BIGINT) AS dropped, 0 AS other,
  string_agg(reason || '=' || d, ',' ORDER BY reason) FILTER (d > 0) AS reasons FROM (
  SELECT stage, reason, count(*) AS n, count(*) FILTER (status = 'kept') AS k, count(*) FILTER (status = 'dropped') AS d FROM v_decisions GROUP BY 1, 2) GROUP BY stage"""))
def stage_stats(spark, sf):
    entries = F.transform(F.array_sort(F.map_entries("reasons")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return au.stage_stats(v.decisions(spark, sf)).select("stage", "occurrences", "kept", "dropped", "other", F.array_join(entries, ",").alias("reasons"))


@query("adapter_reason_counts", v.sql(v.V_DECISIONS, select="SELECT run_id, reason, count(*) AS n FROM v_decisions WHERE stage = 'collection' GROUP BY 1, 2"))
def adapter_reason_counts(spark, sf):
    return au.stage_ids(v.decisions(spark, sf), "collection").groupBy("run_id", "reason").agg(F.count("*").alias("n"))


@query("parser_accounting", v.sql(v.V_DECISIONS, select="""
SELECT run_id, raw_seen, CASE WHEN run_id % 2 = 0 THEN raw_dropped + post END AS dropped FROM (SELECT run_id,
  count(*) FILTER (stage = 'collection') AS raw_seen, count(*) FILTER (stage = 'collection' AND status = 'dropped') AS raw_dropped,
  count(*) FILTER (stage = 'normalization' AND status = 'dropped') AS post FROM v_decisions GROUP BY run_id)"""))
def parser_accounting(spark, sf):
    dec = v.decisions(spark, sf)
    raw, post = F.col("stage") == "collection", F.col("stage") == "normalization"
    kept, dropped = F.col("status") == "kept", F.col("status") == "dropped"
    returned = dec.groupBy("run_id").agg(
        (F.count_if(raw & kept) - F.count_if(post & dropped) + F.col("run_id") % 2).alias("returned"))
    return au.parser_accounting(dec, returned, "run_id", raw, post).select("run_id", "raw_seen", "dropped")


@query("latest_event_per_stage", v.sql(v.V_DECISIONS, select="SELECT article_id, stage, arg_max(status, seq) AS status, arg_max(reason, seq) AS reason FROM v_decisions GROUP BY 1, 2"))
def latest_event_per_stage(spark, sf):
    return au.latest_event_per_stage(v.decisions(spark, sf))


@query("last_known_fields", v.sql(v.V_DECISIONS, select="""
SELECT article_id, arg_max(is_today, seq) FILTER (is_today IS NOT NULL) AS is_today, arg_max(supply_layer, seq) FILTER (supply_layer IS NOT NULL) AS supply_layer
FROM v_decisions GROUP BY 1"""))
def last_known_fields(spark, sf):
    return au.last_known_fields(v.decisions(spark, sf), ["is_today", "supply_layer"])


PUBLISHED = "article_id % 3 = 0"


@query("trace_status", v.sql(v.V_DECISIONS, select=f"""
SELECT article_id, CASE WHEN st = 'dropped' THEN 'dropped' WHEN sg = 'publishable' AND {PUBLISHED} THEN 'published' WHEN sg = 'publishable' THEN 'not_published' ELSE 'not_selected_or_not_reached' END AS final_status,
  CASE WHEN st = 'dropped' THEN rs WHEN sg = 'publishable' AND {PUBLISHED} THEN NULL WHEN sg = 'publishable' THEN 'run_ended_before_publication' ELSE 'run_ended_before_later_stages' END AS final_reason
FROM (SELECT article_id, arg_max(status, seq) AS st, arg_max(stage, seq) AS sg, arg_max(reason, seq) AS rs FROM v_decisions GROUP BY 1)"""))
def trace_status(spark, sf):
    dec = v.decisions(spark, sf)
    return au.trace_status(dec, dec.filter(PUBLISHED).select("article_id"))


def _state_sql(stage: str, stages: tuple, blocked: tuple) -> str:
    names = ",".join(f"'{s}'" for s in stages)
    hit = ",".join(f"'{s}'" for s in blocked) or "''"
    return (f"CASE WHEN count(*) FILTER (stage IN ({names})) > 0 THEN arg_max(status, seq) FILTER (stage IN ({names})) "
            f"WHEN count(*) FILTER (status = 'dropped' AND stage IN ({hit})) > 0 THEN 'not_reached' END AS {stage}")


STATES_SQL = ", ".join([
    _state_sql("collected", ("collection",), ()), _state_sql("normalized", ("normalization",), ()),
    _state_sql("candidate", ("initial_candidate_pool",), ("normalization",)),
    _state_sql("enrichment", ("enrichment",), ("normalization",)),
    _state_sql("validation", ("validation",), ("normalization", "enrichment")),
    _state_sql("publishable", ("publishable",), ("normalization", "enrichment", "validation"))])


@query("stage_states", v.sql(v.V_DECISIONS, select="SELECT article_id, " + STATES_SQL + " FROM v_decisions GROUP BY article_id"))
def stage_states(spark, sf):
    return au.stage_states(v.decisions(spark, sf))


@query("article_outcomes", v.sql(v.V_DECISIONS, select=f"""
, a AS (SELECT article_id, bool_or(stage = 'initial_candidate_pool') AS selected, bool_or(stage = 'enrichment' AND status = 'kept') AS submitted, {PUBLISHED} AS published,
  arg_max(status, seq) FILTER (stage = 'validation') AS validation, arg_max(status, seq) FILTER (stage = 'publishable') AS publishable,
  arg_max(reason, seq) FILTER (stage = 'publishable') AS pr, arg_max(reason, seq) FILTER (stage = 'enrichment') AS er,
  arg_max(reason, seq) FILTER (status = 'dropped') AS dr, arg_max(reason, seq) FILTER (status = 'dropped' AND stage <> 'validation') AS xr,
  arg_max(importance_score, seq) FILTER (stage IN ('final_selection', 'validation')) AS importance_score FROM v_decisions GROUP BY article_id)
SELECT article_id, CAST(NULL AS BOOLEAN) AS current_run, CAST(NULL AS VARCHAR) AS origin, CAST(NULL AS VARCHAR) AS cache, CAST(NULL AS BOOLEAN) AS cache_reused, selected, submitted,
  validation, CAST(NULL AS VARCHAR) AS repair, CASE WHEN validation = 'kept' THEN 'accepted' WHEN validation = 'dropped' THEN 'validation_rejected' ELSE er END AS model_result,
  importance_score, publishable, published, CASE WHEN published THEN pr WHEN publishable = 'kept' THEN NULL WHEN publishable = 'dropped' THEN pr WHEN validation = 'kept' THEN xr ELSE dr END AS final_reason FROM a"""))
def article_outcomes(spark, sf):
    dec = v.decisions(spark, sf)
    members = dec.groupBy("article_id").agg(
        F.bool_or(F.col("stage") == "initial_candidate_pool").alias("selected"), F.bool_or(F.col("stage") == "enrichment").alias("requested"),
        F.bool_or((F.col("stage") == "enrichment") & (F.col("status") == "kept")).alias("submitted"),
        F.bool_or(F.expr(PUBLISHED)).alias("published"))
    return au.article_outcomes(dec, members)


def _sets(dec):
    return {name: au.stage_ids(dec, stage) for name, stage in (
        ("raw", "collection"), ("items", "normalization"), ("pool", "initial_candidate_pool"), ("final", "final_selection"))}


@query("funnel_boundary", v.sql(v.V_DECISIONS, select="""
, a AS (SELECT DISTINCT run_id, article_id FROM v_decisions WHERE stage = 'collection' OR article_id % 3 = 1),
b AS (SELECT DISTINCT run_id, article_id FROM v_decisions WHERE stage = 'collection' AND (status = 'kept' OR run_id % 2 = 0))
SELECT run_id, count(a.article_id) AS before, count(b.article_id) AS after,
  CASE WHEN count(*) FILTER (a.article_id IS NULL) = 0 THEN count(a.article_id) - count(b.article_id) END AS dropped
FROM a FULL JOIN b USING (run_id, article_id) GROUP BY run_id"""))
def funnel_boundary(spark, sf):
    dec = v.decisions(spark, sf)
    left = dec.filter("stage = 'collection' or article_id % 3 = 1")
    right = dec.filter("stage = 'collection' and (status = 'kept' or run_id % 2 = 0)")
    return au.funnel_boundary(left, right, ["run_id"])


@query("collection_funnel", v.sql(v.V_DECISIONS, select="""
, raw AS (SELECT run_id, count(*) AS raw_entries FROM v_decisions GROUP BY 1),
it AS (SELECT run_id, article_id, count(*) AS n FROM v_decisions WHERE status = 'kept' GROUP BY 1, 2),
ar AS (SELECT DISTINCT run_id, article_id FROM v_decisions WHERE status = 'kept' AND stage = 'enrichment'),
ne AS (SELECT DISTINCT run_id, article_id FROM ar WHERE article_id % 2 = 0)
SELECT raw.run_id, raw_entries, (SELECT CAST(sum(n) AS BIGINT) FROM it WHERE it.run_id = raw.run_id) AS source_items,
 (SELECT count(*) FROM it WHERE it.run_id = raw.run_id) AS distinct_items, (SELECT count(*) FROM ar WHERE ar.run_id = raw.run_id) AS articles,
 (SELECT count(*) FROM it WHERE it.run_id = raw.run_id) - (SELECT count(*) FROM ar WHERE ar.run_id = raw.run_id) AS distinct_dropped,
 (SELECT count(*) FROM ne WHERE ne.run_id = raw.run_id) AS inserted,
 (SELECT count(*) FROM ar WHERE ar.run_id = raw.run_id) - (SELECT count(*) FROM ne WHERE ne.run_id = raw.run_id) AS known_dropped FROM raw"""))
def collection_funnel(spark, sf):
    dec = v.decisions(spark, sf)
    items = dec.filter("status = 'kept'")
    art = items.filter("stage = 'enrichment'")
    out = au.collection_funnel(dec, items, art, art.filter("article_id % 2 = 0"), ["run_id"])
    return out.drop("object_dropped")


@query("inventory_funnel", v.sql(v.V_DECISIONS, select="""
, s AS (SELECT DISTINCT run_id, article_id, stage FROM v_decisions),
p AS (SELECT 'inventory_to_pool' AS boundary, 'normalization' AS l, 'initial_candidate_pool' AS r UNION ALL SELECT 'pool_to_selected', 'initial_candidate_pool', 'final_selection')
SELECT boundary, run_id, count(DISTINCT article_id) FILTER (stage = l) AS before, count(DISTINCT article_id) FILTER (stage = r) AS after,
  CASE WHEN count(DISTINCT article_id) FILTER (stage = r AND NOT inl) = 0 THEN count(DISTINCT article_id) FILTER (stage = l) - count(DISTINCT article_id) FILTER (stage = r) END AS dropped
FROM (SELECT p.boundary, p.l, p.r, s.*, EXISTS (SELECT 1 FROM s x WHERE x.article_id = s.article_id AND x.run_id = s.run_id AND x.stage = p.l) AS inl FROM s JOIN p ON s.stage IN (p.l, p.r)) GROUP BY 1, 2"""))
def inventory_funnel(spark, sf):
    sets = _sets(v.decisions(spark, sf))
    return au.funnel(v.decisions(spark, sf), ["run_id"], [
        ("inventory_to_pool", sets["items"], sets["pool"]), ("pool_to_selected", sets["pool"], sets["final"])])


@query("model_flow", v.sql(v.V_DECISIONS, select=f"""
, a AS (SELECT run_id, article_id, arg_max(status, seq) FILTER (stage = 'validation') AS va, arg_max(status, seq) FILTER (stage = 'publishable') AS pu,
  bool_or(stage = 'initial_candidate_pool') AS rq, bool_or(stage = 'enrichment') AS su, bool_or(stage LIKE 'final\\_%' ESCAPE '\\') AS fi FROM v_decisions GROUP BY 1, 2)
SELECT run_id, count(*) FILTER (rq) AS requested, count(*) FILTER (su) AS submitted, count(*) FILTER (va = 'kept') AS valid, count(*) FILTER (va = 'dropped') AS rejected,
  count(*) FILTER (su AND va IS NULL) AS not_reached, count(*) FILTER (fi) AS selector_input, count(*) FILTER (pu = 'kept') AS publishable,
  count(*) FILTER (fi AND pu IS DISTINCT FROM 'kept') AS not_publishable, count(*) FILTER ({PUBLISHED}) AS published,
  count(*) FILTER (pu = 'kept' AND NOT {PUBLISHED}) AS not_published FROM a GROUP BY run_id"""))
def model_flow(spark, sf):
    dec = v.decisions(spark, sf)
    out = au.model_flow(dec, au.stage_ids(dec, "initial_candidate_pool"), au.stage_ids(dec, "enrichment"), dec.filter(PUBLISHED), ["run_id"])
    return out.drop("repair_tried", "repaired", "repair_failed")


@query("distinct_set", v.sql(v.V_DECISIONS, select="""
SELECT run_id, article_id, count(*) OVER (PARTITION BY run_id) AS set_count FROM (SELECT DISTINCT run_id, article_id FROM v_decisions WHERE stage = 'enrichment')"""))
def distinct_set(spark, sf):
    return au.distinct_set(au.stage_ids(v.decisions(spark, sf), "enrichment"), ["run_id"])


RUN_REASONS = ("collection_failed", "token_budget_exhausted", "dry_run", "validation_failed", "unheard_of")


@query("run_outcome", f"""
SELECT o_orderkey, CASE WHEN reason = 'collection_failed' THEN 2 WHEN reason = 'token_budget_exhausted' THEN 4 WHEN reason = 'validation_failed' THEN 8
  WHEN status = 'sent' AND reason IS NULL THEN 0 WHEN status = 'skipped' AND reason = 'dry_run' THEN 0 WHEN status = 'uncertain' THEN 7 ELSE 1 END AS exit_code,
  CASE WHEN reason IN ('collection_failed','token_budget_exhausted','validation_failed') THEN reason WHEN status = 'sent' AND reason IS NULL THEN 'delivery_completed'
  WHEN status = 'skipped' AND reason = 'dry_run' THEN reason WHEN status = 'uncertain' THEN 'feishu_send_failed_or_uncertain' ELSE 'unclassified_delivery_failure' END AS exit_reason,
  CASE WHEN reason IN ('collection_failed','token_budget_exhausted','validation_failed') THEN 'daily_failed' WHEN status = 'sent' AND reason IS NULL THEN 'daily_success'
  WHEN status = 'skipped' AND reason = 'dry_run' THEN 'normal_skip' ELSE 'daily_failed' END AS final_status
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'sent' WHEN 'F' THEN 'skipped' ELSE 'uncertain' END AS status,
  CASE o_orderkey % 6 WHEN 0 THEN 'collection_failed' WHEN 1 THEN 'token_budget_exhausted' WHEN 2 THEN 'dry_run' WHEN 3 THEN 'validation_failed' WHEN 4 THEN 'unheard_of' END AS reason FROM orders)""")
def run_outcome(spark, sf):
    state = F.col("o_orderstatus")
    reason = F.get(F.array(*[F.lit(r) for r in RUN_REASONS]), (F.col("o_orderkey") % 6).cast("int"))
    runs = v.table(spark, sf, "orders").select("o_orderkey", F.when(state == "O", "sent").when(state == "F", "skipped").otherwise("uncertain").alias("status"), reason.alias("reason"))
    return au.run_outcome(runs).select("o_orderkey", "exit_code", "exit_reason", "final_status")


STAGES_SQL = "CASE WHEN o_orderpriority = '1-URGENT' THEN 'collection' WHEN o_orderpriority = '2-HIGH' THEN 'publish' WHEN o_orderpriority = '3-MEDIUM' THEN 'unheard' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'persistence' END"


@query("exception_outcome", f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 3 WHEN s = 'collection' THEN 2 WHEN s = 'publish' THEN 5 WHEN s = 'persistence' THEN 9 ELSE 1 END AS exit_code,
 CASE WHEN o_orderstatus = 'F' THEN 'model_request_failed' WHEN s IN ('collection', 'publish', 'persistence') THEN s || '_failed' ELSE 'unhandled_failure' END AS exit_reason
FROM (SELECT o_orderkey, o_orderstatus, {STAGES_SQL} AS s FROM orders)""")
def exception_outcome(spark, sf):
    runs = v.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", True).alias("model_request_failed"),
                                               F.expr(STAGES_SQL).alias("failure_stage"))
    return au.exception_outcome(runs).select("o_orderkey", "exit_code", "exit_reason")


@query("outcome_violations", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'invalid_final_status' ELSE 'inconsistent_exit_code' END AS rule FROM orders
WHERE o_orderstatus = 'P' OR length(o_orderpriority) % 2 = CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END""")
def outcome_violations(spark, sf):
    """Statuses as recorded in the orders against exit codes that come from another column."""
    state = F.col("o_orderstatus")
    status = F.when(state == "O", "daily_success").when(state == "F", "daily_failed").otherwise("pending")
    code = F.length("o_orderpriority") % 2
    runs = v.table(spark, sf, "orders").select("o_orderkey", status.alias("final_status"), code.cast("int").alias("exit_code"))
    return au.outcome_violations(runs, "o_orderkey").select("o_orderkey", "rule")


@query("error_kind", """
SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'http' WHEN 1 THEN 'timeout' WHEN 2 THEN 'ssl' WHEN 3 THEN 'network' WHEN 4 THEN 'parser' WHEN 5 THEN 'size_limit' ELSE 'other' END AS error_kind
FROM events WHERE event_type = 'error'""")
def error_kind(spark, sf):
    kinds = (("HTTPError", None, "HTTP 500"), ("URLError", "TimeoutError", ""), ("URLError", "SSLError", ""), ("URLError", "OSError", ""),
             ("JSONDecodeError", None, ""), ("ValueError", None, "Source response exceeds 2 MB"), ("KeyError", None, "x"))
    at = (F.col("event_id") % 7).cast("int")

    def pick(index):
        return F.get(F.array(*[F.lit(k[index]).cast("string") for k in kinds]), at)

    errors = v.table(spark, sf, "events").filter("event_type = 'error'").select(
        "event_id", pick(0).alias("error_type"), pick(1).alias("cause_type"), pick(2).alias("message"))
    return au.error_kind(errors).select("event_id", "error_kind")
