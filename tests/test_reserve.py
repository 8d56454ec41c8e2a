"""Reserve review branch by branch."""

import datetime as dt

from pyspark.sql import functions as F

from broadsheet.operators import reserve as rs

NOW = dt.datetime(2026, 9, 14)
BODY = "This explains the underlying mechanism and implementation details with a step-by-step method. " * 25
OFFICIAL = {"category": "policy", "channel": "policy_economy"}
EVIDENCE = {"policy_validity": "valid", "policy_validity_evidence": "explicit provision", "policy_checked_at": NOW.isoformat() + "+00:00",
            "policy_evidence_url": "https://example.com/release"}
ARTICLE = ("feed int, id string, title string, clean_text string, category string, channel string, source string, source_tier int, source_role string, "
           "verification_status string, published_at timestamp, original_url string, fingerprint string")
CACHE = "article_id string, cache_reason string, enrichment_hash_now string, importance_score int, what_happened_en string, what_happened string"


def review(spark, cases):
    """All cases in one run, each in a feed of its own."""
    articles, cache, reviews, history = [], [], [], []
    kinds = rs.PRIOR_FIELDS
    for feed, case in enumerate(cases):
        changes = dict(case)
        age, cached, prior = changes.pop("age", 48), changes.pop("cached", True), changes.pop("prior", None)
        past, cache_reason, score = changes.pop("past", ()), changes.pop("cache_reason", None), changes.pop("score", 80)
        ident = f"x{feed}"
        articles.append(tuple(({
            "feed": feed, "id": ident, "title": "A tool appears", "clean_text": "Plain words. " * 20, "category": "ai", "channel": "technology", "source": "S",
            "source_tier": 1, "source_role": "primary", "verification_status": "source_verified", "published_at": NOW - dt.timedelta(hours=age),
            "original_url": "https://example.com/release", "fingerprint": "fp"} | changes).values()))
        if cached:
            cache.append((ident, cache_reason, "h", score, "It works.", "可以。"))
        if prior is not None:
            reviews.append(tuple([ident, *[prior.get(k) for k in kinds]]))
        history += [(feed, ident if p.get("id") else "other", p.get("url", "https://example.com/o"), p.get("fp", "other"), p.get("title", "Zebra quilt"), 1, "2026-09-13") for p in past]
    inputs = rs.reserve_inputs(
        spark.createDataFrame(articles, ARTICLE), spark.createDataFrame(cache, CACHE),
        spark.createDataFrame(reviews, "article_id string, " + ", ".join(f"{k} {t}" for k, t in kinds.items())),
        spark.createDataFrame(history, "feed int, article_id string, original_url string, fingerprint string, title string, seq int, daily_published_at string"), ["feed"])
    rows = rs.reserve_classify(inputs, F.lit(NOW).cast("timestamp")).collect()
    return {r.feed: r for r in rows}


CASES = [
    (dict(cached=False), "pending_review", "cache_missing", "catch_up"), (dict(), "eligible", "within_catchup_window", "catch_up"),
    (dict(cache_reason="cache_validation_failed"), "pending_review", "cache_validation_failed", "catch_up"),
    (dict(score=59), "rejected", "importance_below_60", "catch_up"), (dict(source_role="discovery"), "rejected", "existing_quality_filter", "catch_up"),
    (dict(age=365 * 24 + 1), "rejected", "outside_reserve_design_window", None),
    (dict(prior={"content_fingerprint": "other"}), "pending_review", "content_fingerprint_changed", "catch_up"),
    (dict(prior={"enrichment_hash": "other"}), "pending_review", "cache_content_changed", "catch_up"),
    (dict(age=240, **OFFICIAL), "pending_review", "policy_validity_unknown", "evergreen"),
    (dict(age=240, prior={"policy_validity": "expired"}, **OFFICIAL), "rejected", "policy_expired_or_superseded", None),
    (dict(age=240, prior={"policy_validity": "valid", "replaced_by": "new"}, **OFFICIAL), "rejected", "policy_expired_or_superseded", None),
    (dict(age=240, prior={"policy_validity": "valid", "validity_end": "2026-09-13T00:00:00+00:00"}, **OFFICIAL), "rejected", "policy_expired", None),
    (dict(age=240, prior={"policy_validity": "valid"}, **OFFICIAL), "pending_review", "policy_validity_evidence_missing_or_stale", "evergreen"),
    (dict(age=240, prior=EVIDENCE, **OFFICIAL), "eligible", "verified_valid_policy", "evergreen"),
    (dict(age=240, prior={**EVIDENCE, "policy_checked_at": "2026-09-06T00:00:00+00:00"}, **OFFICIAL), "pending_review", "policy_validity_evidence_missing_or_stale", "evergreen"),
    (dict(age=240, prior={**EVIDENCE, "policy_checked_at": "2026-09-15T00:00:00+00:00"}, **OFFICIAL), "pending_review", "policy_validity_evidence_missing_or_stale", "evergreen"),
    (dict(age=240, title="Research report analysis", clean_text="A product was shown. " * 300), "pending_review", "long_term_value_not_proven", None),
    (dict(age=240, clean_text=BODY), "eligible", "body_supported_long_read", "deep_read"),
    (dict(age=1000, clean_text=BODY), "pending_review", "long_term_value_not_proven", None),
    (dict(age=1000, clean_text=BODY, prior={"current_applicability_verified": True, "applicability_evidence": "reviewed"}), "eligible", "reviewed_long_term_read", "evergreen"),
    (dict(age=240, clean_text=BODY, title="Temporary outage"), "rejected", "short_lived_content", None),
    (dict(past=[{"id": "x"}]), "rejected", "previously_published", "catch_up"), (dict(past=[{"fp": "fp"}]), "rejected", "previously_published", "catch_up"),
    (dict(past=[{"url": "https://example.com/release/"}]), "rejected", "previously_published", "catch_up"),
    (dict(past=[{"title": "A tool appears!"}]), "rejected", "previously_published", "catch_up"),
]


def test_branches(spark):
    got = review(spark, [given for given, *_ in CASES] + [dict(age=12)])
    for n, (given, status, reason, layer) in enumerate(CASES):
        assert (got[n].reserve_status, got[n].reserve_reason, got[n].supply_layer) == (status, reason, layer), given
    assert len(CASES) not in got  # today's article is no reserve
