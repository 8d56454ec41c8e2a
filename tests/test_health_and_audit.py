"""Health, budget and audit figures on small hand-made histories."""

import datetime as dt

from pyspark.sql import functions as F

from broadsheet.operators import audit as au
from broadsheet.operators import health as he
from broadsheet.operators import ledger as le
from broadsheet.operators import ordered as od
from broadsheet.sources import audits as sa
from broadsheet.sources import tables as tb

T0 = dt.datetime(2026, 1, 1)
EVENTS = "source_id string, id long, checked_at timestamp, status string, duration_ms double, error_kind string"


def checks(extra=()):
    rows = [("one", i, T0 + dt.timedelta(hours=i), "ok", float(i), None) for i in range(1, 21)]
    rows += [("one", 21, T0 + dt.timedelta(hours=21), "empty", None, None), ("one", 22, T0 + dt.timedelta(hours=22), "error", 30.0, "timeout"),
             ("one", 23, T0 + dt.timedelta(hours=23), "error", 40.0, "ssl"), ("few", 1, T0, "error", 5.0, "ssl")]
    return rows + list(extra)


def metrics(spark, rows):
    events = spark.createDataFrame(rows, EVENTS)
    snapshot = he.health_snapshot(events).unionByName(spark.createDataFrame(
        [("old", "ok", T0, T0)], "source_id string, status string, checked_at timestamp, latest_success_at timestamp"))
    return {r.source_id: r for r in he.source_health_metrics(events, snapshot).collect()}


def test_source_health(spark):
    got = metrics(spark, checks())
    one = got["one"]
    assert (one.success_count, one.empty_count, one.timeout_count, one.failure_count) == (20, 1, 1, 1)
    assert (one.consecutive_failures, one.p95_duration_ms, one.duration_sample_count) == (2, 30.0, 22)
    assert one.last_success_at == T0 + dt.timedelta(hours=20)
    assert (got["few"].p95_duration_ms, got["few"].consecutive_failures) == (None, 1)
    assert (got["old"].sample_count, got["old"].average_duration_ms, got["old"].last_success_at) == (0, None, T0)
    fixed = metrics(spark, checks([("one", 24, T0 + dt.timedelta(hours=24), "ok", 1.0, None)]))
    assert fixed["one"].consecutive_failures == 0


def test_running_sums_across_chunks(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id", (F.col("id") % 7).alias("v"))
    out = od.running_before(df, ["k"], F.floor(F.col("id") / 50), ["id"], {"s": (F.col("v"), "sum"), "m": (F.col("v"), "max")})
    total = {0: 0, 1: 0, 2: 0}
    best = {}
    for r in sorted(out.collect(), key=lambda r: r.id):
        assert (r.s, r.m) == (total[r.k], best.get(r.k))
        total[r.k] += r.v
        best[r.k] = max(best.get(r.k, 0), r.v)


def test_budget_boundaries(spark):
    def status(accepted, used, need):
        rows = [(1, 1, used, 0, accepted), (1, 2, 0, need, accepted)]
        df = spark.createDataFrame(rows, "d int, pos int, used long, required long, accepted int")
        out = le.budget_admission(df, ["d"], F.floor(F.col("pos") / 10), ["pos"], F.col("pos"), accepted="accepted")
        return out.filter("pos = 2").first()["budget_status"]

    assert status(10, 35_000, 5_000) == "normal"
    assert status(10, 35_001, 5_000) == "graceful_stop"
    assert status(0, 35_001, 5_000) == "exhausted_before_minimum"


DECISIONS = "run_id string, article_id string, seq int, stage string, status string, reason string, importance_score int, is_today boolean"
MEMBERS = "article_id string, selected boolean, requested boolean, submitted boolean, published boolean"


def outcome(spark, events, published=None, skipped=None):
    rows = [("r", "a", n, s, st, why, score, None) for n, (s, st, why, score) in enumerate(events)]
    dec = spark.createDataFrame(rows, DECISIONS)
    members = spark.createDataFrame([("a", True, True, True, published)], MEMBERS)
    return au.article_outcomes(dec, members, F.lit(skipped) if skipped else None).first()


def test_outcomes(spark):
    got = outcome(spark, [("inventory", "kept", "historical_inventory", None), ("enrichment_cache", "observed", "cache_hit", 80),
                          ("publishable", "kept", "selected_after_event_dedup", None)], published=True)
    assert (got.current_run, got.cache_reused, got.importance_score, got.final_reason) == (False, True, 80, "selected_after_event_dedup")
    got = outcome(spark, [("validation", "dropped", "hard_facts", None), ("repair", "kept", "repair_succeeded", None), ("validation", "kept", "ok", 80),
                          ("publishable", "kept", "selected_after_event_dedup", None)], published=False, skipped="enrichment_failed")
    assert (got.final_reason, got.model_result) == ("enrichment_failed", "accepted")
    got = outcome(spark, [("validation", "dropped", "hard_facts", None), ("repair", "dropped", "repair_failed", None),
                          ("fallback_historical_dedup", "dropped", "historical_url", None)])
    assert got.final_reason == "repair_failed"
    assert outcome(spark, [("initial_selection", "dropped", "duplicate_url", None)]).final_reason == "duplicate_url"
    assert outcome(spark, [("collection", "kept", "x", None)]).final_reason is None


def test_last_fields_keep_false(spark):
    rows = [("r", "a", 1, "x", "kept", "y", None, True), ("r", "a", 2, "x", "kept", "y", None, False), ("r", "a", 3, "x", "kept", "y", None, None)]
    got = au.last_known_fields(spark.createDataFrame(rows, DECISIONS), ["is_today", "importance_score"]).first()
    assert (got.is_today, got.importance_score) == (False, None)


def test_stage_states(spark):
    rows = [("r", "a", 1, "collection", "kept", "x", None, None), ("r", "a", 2, "normalization", "dropped", "x", None, None),
            ("r", "b", 1, "inventory", "kept", "historical_inventory", None, None), ("r", "b", 2, "initial_selection", "dropped", "x", None, None),
            ("r", "c", 1, "repair", "dropped", "repair_failed", None, None), ("r", "d", 1, "token_budget", "observed", "x", None, None)]
    got = {r.article_id: r for r in au.stage_states(spark.createDataFrame(rows, DECISIONS)).collect()}
    assert (got["a"].collected, got["a"].normalized, got["a"].candidate, got["a"].publishable) == ("kept", "dropped", "not_reached", "not_reached")
    assert (got["b"].collected, got["b"].normalized, got["b"].candidate, got["b"].enrichment) == ("not_in_current_run", "not_in_current_run", "dropped", "not_reached")
    assert (got["c"].validation, got["c"].publishable) == ("dropped", "not_reached")
    assert (got["d"].enrichment, got["d"].collected) == ("dropped", None)


def test_boundary_needs_a_subset(spark):
    left = spark.createDataFrame([("r", "a")], "run_id string, article_id string")
    right = spark.createDataFrame([("r", "a"), ("r", "old")], "run_id string, article_id string")
    assert au.funnel_boundary(left, right, ["run_id"]).first()["dropped"] is None
    assert au.funnel_boundary(right, left, ["run_id"]).first()["dropped"] == 1


def test_parser_accounting(spark):
    rows = [("r", "a", 1, "adapter_rss", "kept", "k", None, None)] * 101 + [("r", "b", 1, "adapter_rss", "dropped", "missing_url", None, None),
                                                                          ("r", "c", 1, "adapter_feed_cap", "dropped", "feed_cap_100", None, None)]
    dec = spark.createDataFrame(rows, DECISIONS)
    raw, post = F.col("stage") == "adapter_rss", F.col("stage") == "adapter_feed_cap"
    for returned, want in ((100, 2), (99, None)):
        items = spark.createDataFrame([("r", returned)], "run_id string, returned long")
        assert au.parser_accounting(dec, items, "run_id", raw, post).first()["dropped"] == want


def test_run_outcomes(spark):
    rows = [("sent", None, 0, "daily_success"), ("skipped", "dry_run", 0, "normal_skip"), ("sent", "publish_failed", 5, "daily_failed"),
            ("uncertain", None, 7, "daily_failed"), ("skipped", "something", 1, "daily_failed"), ("odd", None, 1, "daily_failed")]
    out = au.run_outcome(spark.createDataFrame([r[:2] for r in rows], "status string, reason string")).collect()
    assert [(r.exit_code, r.final_status) for r in out] == [r[2:] for r in rows]
    bad = spark.createDataFrame([(1, "daily_success", 1), (2, "running", 0), (3, "daily_failed", 4)], "k int, final_status string, exit_code int")
    assert {r.k: r.rule for r in au.outcome_violations(bad, "k").collect()} == {1: "inconsistent_exit_code", 2: "invalid_final_status"}


def test_tables(spark):
    current = spark.createDataFrame([("a", 1, "first"), ("b", 2, "first")], "k string, v int, first_reserved_at string")
    changes = spark.createDataFrame([("b", None, "later"), ("c", 4, "later")], "k string, v int, first_reserved_at string")
    got = {r.k: (r.v, r.first_reserved_at) for r in tb.upsert_by_key(current, changes, ["k"], ["first_reserved_at"]).collect()}
    assert got == {"a": (1, "first"), "b": (None, "first"), "c": (4, "later")}
    old = spark.createDataFrame([("x",), (None,)], "id string")
    target = spark.createDataFrame([], "id string, source_tier int, channel string").schema
    rows = tb.normalize_schema(old, target, {"source_tier": 3, "channel": "technology"}).collect()
    assert [tuple(r) for r in rows] == [("x", 3, "technology"), (None, 3, "technology")]


def test_saved_audits(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"run_id":"r1","date":"2026-09-28","end_time":"2026-09-28T01:00:00","articles":[{"article_id":"a","source_id":"s","title":"T",'
                                     '"original_url":"http://x","events":[{"stage":"collection","status":"kept","reason":"x"}]}]}')
    (tmp_path / "b.json").write_text('{"run_id":"r2","date":"2026-09-28","end_time":"2026-09-28T02:00:00","articles":[]}')
    (tmp_path / "c.json").write_text("{broken")
    (tmp_path / "d.json").write_text('{"run_id":"r3","date":"yesterday"}')
    audits = sa.read_run_audits(spark, str(tmp_path))
    assert [r.run_id for r in audits.collect()] == ["r2", "r1"]
    assert [r.date for r in sa.available_dates(audits).collect()] == ["2026-09-28"]
    assert sa.pick_run(audits, ["date"]).first()["run_id"] == "r2"
    row = sa.article_rows(audits.filter("run_id = 'r1'")).first()
    assert (row.collected, row.normalized, row.original_url) == ("kept", None, None)
