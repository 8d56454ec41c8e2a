"""Source health: counters, latency, streaks and snapshots over the check history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.operators.ordered import nearest_rank
from broadsheet.session import broadcast_if_small

FAILING = ("error", "timeout", "failed")
MIN_LATENCY_SAMPLES = 20


def health_snapshot(events: DataFrame) -> DataFrame:
    """Latest check per source; the last success survives later failures."""
    latest = F.max_by(F.struct("status", "checked_at"), "id")
    success = F.max_by("checked_at", F.when(F.col("status") == "ok", F.col("id")))
    out = events.groupBy("source_id").agg(latest.alias("_latest"), success.alias("latest_success_at"))
    return out.select("source_id", "_latest.*", "latest_success_at")


def _optional(events: DataFrame, name: str) -> Column:
    return F.col(name) if name in events.columns else F.lit(None).cast("string")


def source_health_metrics(events: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Disjoint outcome counts, average and p95 latency, and the current failure streak per source.

    Sources known only from the snapshot appear with zero samples and their old success time.
    """
    status, kind = F.col("status"), F.col("error_kind")
    timed_out = (status == "timeout") | ((status == "error") & F.coalesce(kind == "timeout", F.lit(False)))
    failed = status.isin("error", "failed") & F.coalesce(kind != "timeout", F.lit(True))
    totals = events.groupBy("source_id").agg(
        F.count_if(status == "ok").alias("success_count"), F.count_if(timed_out).alias("timeout_count"),
        F.count_if(status == "empty").alias("empty_count"), F.count_if(failed).alias("failure_count"),
        # Summed as decimals: the average does not depend on the order rows arrive in.
        F.round(F.avg(F.col("duration_ms").cast("decimal(18,6)")), 2).cast("double").alias("average_duration_ms"), F.count("*").alias("sample_count"),
        F.count("duration_ms").alias("duration_sample_count"), F.min_by("checked_at", "id").alias("statistics_since"),
        F.max_by(_optional(events, "network_route"), F.col("id")).alias("last_network_route"),
        F.max_by(_optional(events, "failure_class"), F.col("id")).alias("last_failure_class"),
        F.max(F.when(~status.isin(*FAILING), F.col("id"))).alias("_last_fine"))
    # Failures after the last good check: a narrow join against one row per source. A hot source is
    # split by AQE, as only the failing side can be large.
    failing = events.filter(status.isin(*FAILING)).select("source_id", "id")
    streak = failing.join(totals.select("source_id", "_last_fine"), "source_id").filter(
        F.col("_last_fine").isNull() | (F.col("id") > F.col("_last_fine"))).groupBy("source_id").agg(
        F.count("*").alias("consecutive_failures"))
    p95 = nearest_rank(events, "source_id", "duration_ms", 0.95, MIN_LATENCY_SAMPLES, F.floor("duration_ms")).select(
        "source_id", F.col("duration_ms").alias("p95_duration_ms"))
    out = snapshot.select("source_id", F.col("latest_success_at").alias("last_success_at"))
    out = out.join(totals.drop("_last_fine"), "source_id", "full").join(streak, "source_id", "left").join(p95, "source_id", "left")
    counters = ["success_count", "timeout_count", "empty_count", "failure_count", "sample_count",
                "duration_sample_count", "consecutive_failures"]
    return out.fillna(0, counters)


def sources_health_join(sources: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Every registered source with its latest health, or `not_checked`."""
    latest = snapshot.select("source_id", "status", F.col("checked_at").alias("latest_checked_at"), "latest_success_at")
    return sources.join(broadcast_if_small(latest), "source_id", "left").withColumn(
        "health_status", F.coalesce("status", F.lit("not_checked"))).drop("status")


def health_summary(joined: DataFrame) -> DataFrame:
    state = F.col("health_status")
    return joined.agg(F.count("*").alias("enabled"), F.count_if(state == "ok").alias("healthy"),
                      F.count_if(state == "error").alias("failed"), F.count_if(state == "empty").alias("empty"))


def run_source_counts(events: DataFrame, run: Column) -> DataFrame:
    state = F.col("status")
    return events.groupBy(run.alias("run")).agg(
        F.count("*").alias("sources_attempted"), F.count_if(state == "ok").alias("sources_ok"),
        F.count_if(state == "empty").alias("sources_empty"), F.count_if(state == "error").alias("sources_failed"))


def snapshot_of_date(health: DataFrame, group: list[str]) -> DataFrame:
    """A collection snapshot has a date only when every check falls on one local date."""
    from broadsheet.functions.rules import local_date

    day = local_date(F.col("checked_at"))
    out = health.groupBy(*group).agg(F.min(day).alias("_low"), F.max(day).alias("_high"),
                                     F.count_if(F.col("checked_at").isNull()).alias("_missing"))
    one = (F.col("_low") == F.col("_high")) & (F.col("_missing") == 0)
    return out.select(*group, F.when(one, F.col("_low")).alias("snapshot_date"))


def unambiguous_source_lookup(articles: DataFrame, sources: DataFrame, name: str = "source") -> DataFrame:
    """Source id inferred from the name, only where the registry has that name exactly once."""
    unique = sources.groupBy("name").agg(F.count("*").alias("_n"), F.min("source_id").alias("inferred_source_id"))
    unique = unique.filter("_n = 1").select(F.col("name").alias(name), "inferred_source_id")
    return articles.join(broadcast_if_small(unique), name, "left")
