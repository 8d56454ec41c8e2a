"""Reserve review: which cached articles may fill a thin edition, and why others may not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.functions import urls
from broadsheet.operators import admission as ad
from broadsheet.operators import linkage as lk

PRIOR_FIELDS = {
    "policy_validity": "string", "validity_start": "string", "validity_end": "string", "superseded": "boolean",
    "replaced_by": "string", "policy_evidence_url": "string", "policy_checked_at": "string",
    "policy_validity_evidence": "string", "current_applicability_verified": "boolean", "applicability_evidence": "string",
    "content_fingerprint": "string", "enrichment_hash": "string", "used_in_daily": "boolean", "used_at": "string",
    "first_reserved_at": "timestamp",
}


def merge_evidence(prior: DataFrame, evidence: str = "review_evidence_json") -> DataFrame:
    """Review evidence kept as JSON becomes columns; evidence wins over an older column."""
    keys = ("policy_checked_at", "policy_validity_evidence", "current_applicability_verified", "applicability_evidence")
    out = prior
    for key in keys:
        kind = PRIOR_FIELDS[key]
        found = F.get_json_object(evidence, f"$.{key}").try_cast(kind)
        old = F.col(key) if key in prior.columns else F.lit(None).cast(kind)
        out = out.withColumn(key, F.coalesce(found, old))
    return out


def reserve_inputs(articles: DataFrame, enrichments: DataFrame, prior: DataFrame, history: DataFrame, scope: list[str],
                   events: bool = True) -> DataFrame:
    """Article with its cached rendering, earlier review and publication match (left joins throughout).

    `enrichments` also holds `cache_reason` (NULL = valid), `enrichment_hash_now`.
    """
    cached = enrichments.select(F.col("article_id").alias("id"), F.lit(True).alias("cache_available"), "cache_reason",
                                "enrichment_hash_now", "importance_score", "what_happened_en", "what_happened")
    reviewed = prior.select(F.col("article_id").alias("id"), *[
        (F.col(c) if c in prior.columns else F.lit(None)).cast(kind).alias(f"prior_{c}") for c, kind in PRIOR_FIELDS.items()])
    by_id = history.groupBy(*scope, F.col("article_id").alias("id")).agg(F.min_by("daily_published_at", "seq").alias("_used_id"), F.lit(True).alias("_by_id"))
    out = articles.join(cached, "id", "left").join(reviewed, "id", "left").join(by_id, [*scope, "id"], "left")
    out = lk.exclude_published(out, history, scope, events=events)
    return out.withColumn("published_before", F.coalesce(F.col("_by_id"), F.lit(False)) | F.col("history_reason").isNotNull())


def reserve_classify(inputs: DataFrame, now: Column) -> DataFrame:
    """Status, reason, layer and type of every article older than a day."""

    def prior(name: str) -> Column:
        return F.col(f"prior_{name}")

    def yes(column: Column) -> Column:
        return F.coalesce(column, F.lit(False))

    gated = ad.content_gate(inputs)
    days = ru.age_days(F.col("published_at"), now)
    policy = F.col("category").isin("policy", "education", "employment") | (
        (F.col("channel") == "policy_economy") & (F.col("source_role") == "primary"))
    evidence = ru.deep_evidence(F.col("clean_text"), F.col("source_tier"))
    out = gated.withColumns({"age_days": days, "policy_related": policy, "evidence": evidence}).filter("age_days > 1")
    has_evidence = F.size("evidence") > 0
    days = F.col("age_days")
    cache_reason = F.when(F.col("cache_available").isNull(), "cache_missing").otherwise(F.col("cache_reason"))
    validity = F.coalesce(prior("policy_validity"), F.lit("unknown"))
    rendered = F.concat_ws(" ", "title", "what_happened_en", "what_happened")
    official = (F.col("source_role") == "primary") & (F.col("source_tier") == 1)
    reviewed = {k: prior(k) for k in ("policy_evidence_url", "policy_checked_at", "validity_start", "policy_validity_evidence")}
    changed = lambda old, new: old.isNotNull() & (old != new)
    reason = ad.first_reason(
        (F.col("published_before") | yes(prior("used_in_daily")), "previously_published"),
        (days > 365, "outside_reserve_design_window"),
        (F.col("gate_reason").isNotNull() | ~ru.editorial_candidate(F.col("title")), "existing_quality_filter"),
        (cache_reason.isNotNull(), "cache"),
        (changed(prior("content_fingerprint"), F.col("fingerprint")), "content_fingerprint_changed"),
        (changed(prior("enrichment_hash"), F.col("enrichment_hash_now")), "cache_content_changed"),
        (F.col("importance_score") < 60, "importance_below_60"),
        (validity.isin("expired", "superseded") | yes(prior("superseded")) | yes(F.length(prior("replaced_by")) > 0), "policy_expired_or_superseded"),
        (yes(F.length(prior("validity_end")) > 0) & ru.validity_expired(prior("validity_end"), now), "policy_expired"),
        (days <= 3, "within_catchup_window"),
        (ru.short_lived(rendered), "short_lived_content"),
        (F.col("policy_related") & (validity != "valid"), "policy_validity_unknown"),
        (F.col("policy_related") & ~(official & ru.policy_evidence_ok(reviewed, F.col("original_url"), now)), "policy_validity_evidence_missing_or_stale"),
        (F.col("policy_related"), "verified_valid_policy"),
        (has_evidence & (days <= 30), "body_supported_long_read"),
        (has_evidence & yes(prior("current_applicability_verified")) & yes(F.length(prior("applicability_evidence")) > 0), "reviewed_long_term_read"),
        (F.lit(True), "long_term_value_not_proven"))
    out = out.withColumn("_reason", reason)
    reason = F.when(F.col("_reason") == "cache", cache_reason).otherwise(F.col("_reason"))
    eligible = F.col("_reason").isin("within_catchup_window", "verified_valid_policy", "body_supported_long_read", "reviewed_long_term_read")
    pending = F.col("_reason").isin("cache", "content_fingerprint_changed", "cache_content_changed", "policy_validity_unknown",
                                    "policy_validity_evidence_missing_or_stale", "long_term_value_not_proven")
    layer = (F.when(days <= 3, "catch_up")
             .when(F.col("_reason").isin("verified_valid_policy", "policy_validity_unknown", "policy_validity_evidence_missing_or_stale",
                                         "reviewed_long_term_read"), "evergreen")
             .when(F.col("_reason") == "body_supported_long_read", "deep_read"))
    kind = (F.when(F.col("policy_related"), "policy").when(F.col("_reason") == "reviewed_long_term_read", "long_term_read")
            .when(has_evidence, "deep_read").otherwise("catch_up"))
    validation = (F.when(cache_reason.isNull(), "passed").when(cache_reason == "cache_validation_failed", "failed")
                  .otherwise("unavailable"))
    return out.select(
        *[c for c in inputs.columns if not c.startswith(("prior_", "_"))], "age_days", "policy_related",
        F.when(eligible, "eligible").when(pending, "pending_review").otherwise("rejected").alias("reserve_status"),
        reason.alias("reserve_reason"), layer.alias("supply_layer"), kind.alias("reserve_type"), validity.alias("policy_validity"),
        F.to_json("evidence").alias("eligibility_evidence_json"), has_evidence.alias("deep_read"), validation.alias("validation_status"),
        (F.col("published_before") | yes(prior("used_in_daily"))).alias("used_in_daily"),
        F.coalesce(prior("first_reserved_at"), now).alias("first_reserved_at"), now.alias("last_checked_at"))


def reserve_summary(records: DataFrame, keys: list[str]) -> DataFrame:
    """Long table of counts: status, rejection reason, and for eligible rows layer, source and age band."""
    eligible = F.col("reserve_status") == "eligible"
    facts = F.array_compact(F.array(
        F.struct(F.lit("status").alias("dimension"), F.col("reserve_status").alias("value")),
        F.when(~eligible, F.struct(F.lit("rejection_reason").alias("dimension"), F.col("reserve_reason").alias("value"))),
        *[F.when(eligible, F.struct(F.lit(name).alias("dimension"), value.alias("value"))) for name, value in (
            ("supply_layer", F.col("supply_layer")), ("source", F.col("source")), ("age", ru.age_band(F.col("age_days"))))]))
    return records.select(*keys, F.explode(facts).alias("f")).groupBy(*keys, "f.dimension", "f.value").agg(F.count("*").alias("n"))
