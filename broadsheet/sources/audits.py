"""Saved run audits: reading, choosing a run for a date, and the per-source view of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import urls
from broadsheet.operators import audit as au
from broadsheet.session import broadcast_if_small

EVENT = ("struct<stage:string,status:string,reason:string,detail:struct<importance_score:int,is_today:boolean,locked_today:boolean,"
         "supply_layer:string,reserve_status:string,cache_reused:boolean>>")
AUDIT = (f"run_id string, date string, end_time string, mode string, sources array<struct<source_id:string,status:string,items:int>>, "
         f"articles array<struct<article_id:string,trace_id:string,source:string,source_id:string,title:string,original_url:string,"
         f"published_at:string,current_stage:string,final_status:string,final_reason:string,events:array<{EVENT}>>>, _corrupt_record string")
REAL_DATE = r"^\d{4}-\d{2}-\d{2}$"


def _audit_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file under `path` (one JSON document each, any depth), with `file` and `fault` (null: a valid audit)."""
    rows = spark.read.schema(AUDIT).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).json(path)
    fault = (F.when(F.col("_corrupt_record").isNotNull(), "unreadable").when(F.col("run_id").isNull(), "no_run_id")
             .when(~F.coalesce(F.col("date").rlike(REAL_DATE) & F.to_date(F.try_to_timestamp("date", F.lit("yyyy-MM-dd"))).isNotNull(), F.lit(False)), "no_date"))
    return rows.select("*", F.col("_metadata.file_path").alias("file"), fault.alias("fault"))


def quarantined_audits(spark: SparkSession, path: str) -> DataFrame:
    """(file, fault, body) of the files that hold no valid audit; the body of those that are no JSON, null for the others."""
    return _audit_files(spark, path).filter("fault is not null").select("file", "fault", F.col("_corrupt_record").alias("body"))


def valid_audits(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """Valid audits (one JSON document per file) in any order; `quarantined_audits` lists the other files."""
    rows = _audit_files(spark, path).filter("fault is null").drop("_corrupt_record", "file", "fault")
    return rows if date is None else rows.filter(F.col("date") == date)


def read_run_audits(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """`valid_audits`, newest first: sorting reads all files once more and moves every audit whole."""
    return valid_audits(spark, path, date).orderBy(F.coalesce("end_time", F.lit("")).desc(), F.desc("run_id"))


def available_dates(audits: DataFrame, snapshot_dates: DataFrame | None = None) -> DataFrame:
    days = audits.select("date")
    if snapshot_dates is not None:
        days = days.unionByName(snapshot_dates.select(F.col("snapshot_date").cast("string").alias("date")).filter("date is not null"))
    return days.distinct().orderBy(F.desc("date"))


def pick_run(runs: DataFrame, by: list[str]) -> DataFrame:
    """The latest run of each date, by end time and run id."""
    return runs.groupBy(*by).agg(F.max_by("run_id", F.struct(F.coalesce("end_time", F.lit("")), "run_id")).alias("run_id"))


def audit_decisions(audits: DataFrame) -> DataFrame:
    """Events of the audits as rows of the `decisions` table."""
    articles = audits.select("run_id", F.explode("articles").alias("a"))
    rows = articles.select("run_id", F.coalesce("a.article_id", "a.trace_id").alias("article_id"), F.posexplode("a.events").alias("seq", "e"))
    return rows.select("run_id", "article_id", "seq", "e.stage", "e.status", "e.reason", "e.detail.*")


def article_rows(audits: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Articles of the audits, gaps filled from the article table, with their stage states in the same run."""
    rows = audits.select("run_id", F.explode("articles").alias("a")).select("run_id", "a.*")
    rows = rows.withColumn("article_id", F.coalesce("article_id", "trace_id")).drop("events")
    if stored is not None:
        meta = au.attach_metadata(rows.select("article_id").distinct(), stored).select(
            "article_id", *[F.col(c).cast("string").alias(f"_{c}") for c in ("source", "title", "published_at", "original_url")])
        rows = rows.join(meta, "article_id", "left")
        for name in ("source", "title", "published_at", "original_url"):
            rows = rows.withColumn(name, F.coalesce(name, f"_{name}")).drop(f"_{name}")
    rows = rows.withColumn("original_url", F.when(urls.scheme(F.col("original_url")) == "https", F.col("original_url")))
    states = au.stage_states(audit_decisions(audits), ("run_id", "article_id"))
    return rows.join(states, ["run_id", "article_id"], "left")


def sources_for_date(rows: DataFrame, checks: DataFrame, sources: DataFrame) -> DataFrame:
    """Registry sources with their status and visible articles; unknown sources share one bucket.

    `rows` holds source_id and article_id of the chosen run, `checks` its source_id, status, items.
    """
    known = sources.select("source_id", F.lit(True).alias("_known"))
    marked = rows.select("source_id", "article_id").join(broadcast_if_small(known), "source_id", "left")
    bucket = F.when(F.col("_known"), F.col("source_id").cast("string")).otherwise("unassigned")
    counts = marked.groupBy(bucket.alias("source_id")).agg(F.count("*").alias("visible_article_count"))
    listed = sources.select(F.col("source_id").cast("string").alias("source_id"), *[c for c in ("name", "region", "tier") if c in sources.columns])
    status = checks.select(F.col("source_id").cast("string").alias("source_id"), "status", F.col("items").alias("article_count"))
    return listed.join(counts, "source_id", "full").join(status, "source_id", "left").fillna(0, ["visible_article_count"])


def retroactive_audit(collected: DataFrame, validations: DataFrame, guarded: DataFrame, final: DataFrame, drops: DataFrame) -> DataFrame:
    """Per-article outcome rebuilt from saved tables; what was not saved stays NULL.

    collected(article_id), validations(article_id, status, reject_stage), guarded(article_id),
    final(article_id), drops(article_id, reason) of the replayed final selection.
    """
    out = (collected.select("article_id").distinct()
           .join(validations.select("article_id", F.col("status").alias("_v"), "reject_stage"), "article_id", "left")
           .join(guarded.select("article_id", F.lit(True).alias("_g")).distinct(), "article_id", "left")
           .join(final.select("article_id", F.lit(True).alias("_f")).distinct(), "article_id", "left")
           .join(drops.groupBy("article_id").agg(F.min("reason").alias("_d")), "article_id", "left"))
    picked = F.coalesce(F.col("_f"), F.lit(False))
    accepted, rejected = F.col("_v") == "accepted", F.col("_v") == "rejected"
    held = F.coalesce(F.col("_g"), F.lit(False))

    def pick(selected: Column, failed: Column, excluded: Column, guarded_: Column, rest: Column) -> Column:
        return F.when(picked, selected).when(rejected, failed).when(accepted, excluded).when(held, guarded_).otherwise(rest)

    lit = F.lit
    return out.select(
        "article_id", lit("kept").alias("collection"),
        F.coalesce("_v", F.when(held, "batch_not_submitted").otherwise("not_requested")).alias("enrichment"),
        F.when(rejected, F.col("reject_stage")).when(accepted, "passed").otherwise("not_requested").alias("validation"),
        F.when(picked, "offline_selected").when(accepted, "offline_excluded").otherwise("not_reached").alias("publishable"),
        pick(lit("publishable_candidate"), lit("validation_failed"), lit("final_selector_excluded"), lit("batch_not_submitted"), lit("not_reached")).alias("screening_status"),
        pick(lit("offline_selected"), F.col("reject_stage"), F.col("_d"), lit("token_budget_guard"), lit("not_processed_before_budget_stop")).alias("screening_reason"))
