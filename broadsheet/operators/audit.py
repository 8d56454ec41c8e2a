"""Decision-level audit: funnels, stage states and outcomes over the `decisions` table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.operators.admission import first_reason


def drop_reasons(decisions: DataFrame) -> DataFrame:
    return decisions.filter(F.col("status") == "dropped").groupBy("stage", "reason").agg(F.count("*").alias("drops"))


def stage_stats(decisions: DataFrame) -> DataFrame:
    """Occurrences per stage (revisits counted) with the dropped reasons as a map."""
    by_reason = decisions.groupBy("stage", "status", "reason").agg(F.count("*").alias("n"))
    state = F.col("status")
    dropped = F.when(state == "dropped", F.struct(F.coalesce("reason", F.lit("unknown")).alias("reason"), "n"))
    return by_reason.groupBy("stage").agg(
        F.sum("n").alias("occurrences"),
        F.sum(F.when(state == "kept", F.col("n")).otherwise(0)).alias("kept"),
        F.sum(F.when(state == "dropped", F.col("n")).otherwise(0)).alias("dropped"),
        F.sum(F.when(~state.isin("kept", "dropped"), F.col("n")).otherwise(0)).alias("other"),
        F.map_from_entries(F.array_sort(F.collect_list(dropped))).alias("reasons"))


def parser_accounting(decisions: DataFrame, returned: DataFrame, run: str, raw: Column, post: Column) -> DataFrame:
    """Parser drops per run, shown only where kept, dropped and returned items reconcile."""
    status = F.col("status")
    out = decisions.groupBy(run).agg(
        F.count_if(raw).alias("raw_seen"), F.count_if(raw & (status == "kept")).alias("raw_kept"),
        F.count_if(raw & (status == "dropped")).alias("raw_dropped"),
        F.count_if(post & (status == "dropped")).alias("postparse_dropped"))
    out = out.join(returned, run, "left")
    whole = (F.col("raw_kept") + F.col("raw_dropped") == F.col("raw_seen")) & (
        F.col("raw_kept") - F.col("postparse_dropped") == F.col("returned"))
    return out.withColumn("dropped", F.when(whole, F.col("raw_dropped") + F.col("postparse_dropped")))


def latest_event_per_stage(decisions: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("status", "reason"), "seq")
    return decisions.groupBy("article_id", "stage").agg(last.alias("_last")).select("article_id", "stage", "_last.*")


def last_known_fields(decisions: DataFrame, fields) -> DataFrame:
    """Last observed value of each field per article; false and zero are values, NULL is not."""
    latest = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col("seq"))).alias(f) for f in fields]
    return decisions.groupBy("article_id").agg(*latest)


def trace_status(decisions: DataFrame, published: DataFrame, skipped_reason: Column | None = None) -> DataFrame:
    """Final state per article from its last kept or dropped decision and the published ids."""
    decided = decisions.filter(F.col("status").isin("kept", "dropped"))
    last = decided.groupBy("article_id").agg(F.max_by(F.struct("stage", "status", "reason"), "seq").alias("l"))
    everyone = decisions.select("article_id").distinct().join(last, "article_id", "left")
    out = everyone.join(published.select("article_id", F.lit(True).alias("_out")).distinct(), "article_id", "left")
    dropped = F.col("l.status") == "dropped"
    ready = F.col("l.stage") == "publishable"
    waiting = F.lit("run_ended_before_publication")
    waiting = waiting if skipped_reason is None else F.coalesce(skipped_reason, waiting)
    return out.select(
        "article_id",
        F.when(dropped, "dropped").when(ready & F.col("_out"), "published").when(ready, "not_published")
        .otherwise("not_selected_or_not_reached").alias("final_status"),
        F.when(dropped, F.col("l.reason")).when(ready & F.col("_out"), None).when(ready, waiting)
        .otherwise("run_ended_before_later_stages").alias("final_reason"))


def _view_stage_match(view_stage: str) -> Column:
    stage = F.col("stage")
    if view_stage == "collected":
        return (stage == "collection") | stage.startswith("adapter_")
    if view_stage == "normalized":
        return stage == "normalization"
    if view_stage == "candidate":
        return stage.isin(*fv.CANDIDATE_STAGES)
    if view_stage == "enrichment":
        return stage.isin("enrichment", "token_budget")
    return stage.isin(view_stage, f"final_{view_stage}")


def stage_states(decisions: DataFrame, keys: tuple[str, ...] = ("article_id",)) -> DataFrame:
    """State of the six view stages per article (or per run and article, by `keys`) in one aggregate.

    A stage without a decision is `not_reached` only if an earlier stage dropped the article;
    otherwise it is NULL (not observable).
    """
    stage, status, reason = F.col("stage"), F.col("status"), F.col("reason")
    shown = F.when(stage == "token_budget", "dropped").otherwise(status)
    aggregates = [
        F.max_by(shown, F.when(_view_stage_match(s), F.col("seq"))).alias(f"last_{s}") for s in fv.VIEW_STAGES]
    aggregates.append(F.bool_or((stage == "inventory") & (reason == "historical_inventory")).alias("historical"))
    aggregates.append(F.bool_or((stage == "repair") & (reason == "repair_failed")).alias("repair_failed"))
    for view_stage, terminal in fv.TERMINAL_BEFORE.items():
        hit = (status == "dropped") & (stage.startswith("adapter_") | stage.isin(*terminal))
        aggregates.append(F.bool_or(hit).alias(f"blocked_{view_stage}"))
    aggregates.append(F.bool_or((status == "dropped") & stage.startswith("adapter_")).alias("blocked_collected"))
    wide = decisions.groupBy(*keys).agg(*aggregates)

    def state(view_stage: str) -> Column:
        chain = F.when(F.col(f"last_{view_stage}").isNotNull(), F.col(f"last_{view_stage}"))
        if view_stage == "validation":
            chain = chain.when(F.col("repair_failed"), "dropped")
        if view_stage in ("collected", "normalized"):
            chain = chain.when(F.col("historical"), "not_in_current_run")
        return chain.when(F.col(f"blocked_{view_stage}"), "not_reached").alias(view_stage)

    return wide.select(*keys, *[state(s) for s in fv.VIEW_STAGES])


def article_outcomes(decisions: DataFrame, members: DataFrame, skipped_reason: Column | None = None) -> DataFrame:
    """One row per article: origin, cache use, model result, score and the final reason.

    `members` marks the saved id sets per article: selected, requested, submitted, published
    (booleans; NULL where that set was not saved).
    """
    stage, status, reason, seq = F.col("stage"), F.col("status"), F.col("reason"), F.col("seq")

    def last(name: str, value: Column) -> Column:
        return F.max_by(value, F.when(stage == name, seq))

    dropped = (status == "dropped") & ~stage.startswith("fallback_")
    scored = stage.isin(*fv.SCORE_STAGES) & F.col("importance_score").isNotNull()
    wide = decisions.groupBy("article_id").agg(
        last("inventory", reason).alias("origin"), last("enrichment_cache", reason).alias("cache"),
        last("validation", status).alias("validation"), last("repair", reason).alias("repair"),
        last("publishable", status).alias("publishable"), last("publishable", reason).alias("_publishable_reason"),
        last("enrichment", reason).alias("_enrichment_reason"),
        F.max_by(reason, F.when(dropped, seq)).alias("_drop"),
        F.max_by(reason, F.when(dropped & ~stage.isin("validation", "repair"), seq)).alias("_other_drop"),
        F.max_by("importance_score", F.when(scored, seq)).alias("importance_score"),
    ).join(members, "article_id", "left")
    published = F.col("published")
    skipped = F.lit(None).cast("string") if skipped_reason is None else skipped_reason
    final = (F.when(F.coalesce(published, F.lit(False)), F.col("_publishable_reason"))
             .when(F.col("publishable") == "kept", skipped)
             .when(F.col("publishable") == "dropped", F.col("_publishable_reason"))
             .when(F.col("validation") == "kept", F.col("_other_drop"))
             .otherwise(F.col("_drop")))
    in_use = F.coalesce(F.col("selected"), F.lit(False)) | F.coalesce(F.col("requested"), F.lit(False)) | F.coalesce(published, F.lit(False))
    reused = F.when(F.col("cache").isNotNull(), in_use & (F.col("cache") == "cache_hit"))
    result = (F.when(F.coalesce(reused, F.lit(False)) & (F.col("submitted") == F.lit(False)), "cache_reused")
              .when(F.col("validation") == "kept", "accepted").when(F.col("validation") == "dropped", "validation_rejected")
              .otherwise(F.col("_enrichment_reason")))
    current = F.when(F.col("origin") == "current_run_inventory", True).when(F.col("origin") == "historical_inventory", False)
    return wide.select("article_id", current.alias("current_run"), "origin", "cache", reused.alias("cache_reused"),
                       "selected", "submitted", "validation", "repair", result.alias("model_result"), "importance_score",
                       "publishable", "published", final.alias("final_reason"))


def funnel_boundary(left: DataFrame, right: DataFrame, run: list[str]) -> DataFrame:
    """Sizes of two id sets and the drop between them, known only when right is inside left."""
    a = left.select(*run, "article_id").distinct().withColumn("_l", F.lit(1))
    b = right.select(*run, "article_id").distinct().withColumn("_r", F.lit(1))
    both = a.join(b, [*run, "article_id"], "full")
    out = both.groupBy(*run).agg(F.count("_l").alias("before"), F.count("_r").alias("after"),
                                 F.count_if(F.col("_l").isNull()).alias("_outside"))
    return out.select(*run, "before", "after", F.when(F.col("_outside") == 0, F.col("before") - F.col("after")).alias("dropped"))


def stage_ids(decisions: DataFrame, stage: str, status: str | None = None) -> DataFrame:
    out = decisions.filter(F.col("stage") == stage)
    return out if status is None else out.filter(F.col("status") == status)


def funnel(decisions: DataFrame, run: list[str], boundaries: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    parts = [funnel_boundary(a, b, run).withColumn("boundary", F.lit(name)) for name, a, b in boundaries]
    return reduce(DataFrame.unionByName, parts)


def collection_funnel(raw: DataFrame, items: DataFrame, articles: DataFrame, inserted: DataFrame, run: list[str]) -> DataFrame:
    """Raw entries (objects), source items (objects and distinct ids), articles and inserts per run.

    Object counts are never subtracted from id sets; a drop is shown where sets prove it.
    """
    counts = raw.groupBy(*run).agg(F.count("*").alias("raw_entries")).join(
        items.groupBy(*run).agg(F.count("*").alias("source_items")), run, "left")
    kept = funnel_boundary(items, articles, run).select(
        *run, F.col("before").alias("distinct_items"), F.col("after").alias("articles"), F.col("dropped").alias("distinct_dropped"))
    new = funnel_boundary(articles, inserted, run).select(*run, F.col("after").alias("inserted"), F.col("dropped").alias("known_dropped"))
    out = counts.join(kept, run, "left").join(new, run, "left")
    return out.withColumn("object_dropped", F.when(F.col("distinct_items") == F.col("source_items"), F.col("distinct_dropped")))


def model_flow(decisions: DataFrame, requested: DataFrame, submitted: DataFrame, published: DataFrame, run: list[str]) -> DataFrame:
    """Requested, submitted, valid, rejected, not reached, repaired, publishable and published per run."""
    stage, status, reason = F.col("stage"), F.col("status"), F.col("reason")
    key = [*run, "article_id"]
    seen = decisions.groupBy(*key).agg(
        F.max_by(status, F.when(stage == "validation", F.col("seq"))).alias("validation"),
        F.max_by(status, F.when(stage == "repair", F.col("seq"))).alias("repair"),
        F.bool_or((stage == "repair") & reason.isin("field_repair_requested", "repair_failed", "repair_succeeded")).alias("repair_tried"),
        F.bool_or((stage == "repair") & (reason == "token_guard")).alias("guarded"),
        F.bool_or(stage.startswith("final_")).alias("selector_input"),
        F.max_by(status, F.when(stage == "publishable", F.col("seq"))).alias("publishable"))
    for name, ids in (("requested", requested), ("submitted", submitted), ("published", published)):
        seen = seen.join(ids.select(*key, F.lit(True).alias(name)).distinct(), key, "full")
    yes = {name: F.coalesce(F.col(name), F.lit(False)) for name in
           ("requested", "submitted", "published", "repair_tried", "guarded", "selector_input")}
    valid = F.coalesce(F.col("validation") == "kept", F.lit(False))
    rejected = F.coalesce(F.col("validation") == "dropped", F.lit(False))
    out_now = F.coalesce(F.col("publishable") == "kept", F.lit(False))
    return seen.groupBy(*run).agg(
        F.count_if(yes["requested"]).alias("requested"), F.count_if(yes["submitted"]).alias("submitted"),
        F.count_if(valid).alias("valid"), F.count_if(rejected).alias("rejected"),
        F.count_if(yes["submitted"] & ~valid & ~rejected).alias("not_reached"),
        F.count_if(yes["repair_tried"]).alias("repair_tried"),
        F.count_if(F.coalesce(F.col("repair") == "kept", F.lit(False))).alias("repaired"),
        F.count_if(F.coalesce(F.col("repair") == "dropped", F.lit(False)) & ~yes["guarded"]).alias("repair_failed"),
        F.count_if(yes["selector_input"]).alias("selector_input"), F.count_if(out_now).alias("publishable"),
        F.count_if(yes["selector_input"] & ~out_now).alias("not_publishable"),
        F.count_if(yes["published"]).alias("published"),
        F.count_if(out_now & ~yes["published"]).alias("not_published"))


def origin_split(inventory: DataFrame, run_articles: DataFrame) -> DataFrame:
    """Inventory ids marked as collected in this run or carried over."""
    now = run_articles.select("article_id").distinct().withColumn("_now", F.lit(True))
    return inventory.select("article_id").distinct().join(now, "article_id", "left").select(
        "article_id", F.when(F.col("_now"), "current_run_inventory").otherwise("historical_inventory").alias("origin"))


def union_inventory(inventory: DataFrame, reserve: DataFrame) -> DataFrame:
    """Inventory plus eligible reserve articles it does not hold yet."""
    extra = reserve.filter(F.col("reserve_status") == "eligible").join(inventory.select("id"), "id", "left_anti")
    return inventory.unionByName(extra.select(*inventory.columns))


def lock_violations(locked: DataFrame, final: DataFrame, key: list[str]) -> DataFrame:
    """Locked articles missing from the final selection; must be empty."""
    return locked.join(final, key, "left_anti").select(*key)


def distinct_set(ids: DataFrame, run: list[str]) -> DataFrame:
    """Distinct ids per run as rows, each with the size of its set."""
    unique = ids.select(*run, "article_id").distinct()
    return unique.join(unique.groupBy(*run).agg(F.count("*").alias("set_count")), run)


def run_outcome(runs: DataFrame) -> DataFrame:
    """Exit class of each run: a failure reason beats any status, unknown is never a success."""
    status, reason = F.col("status"), F.col("reason")
    codes = F.create_map(*[F.lit(x) for pair in fv.FAILURE_CODES.items() for x in pair])
    failure = codes[reason]
    sent = (status == "sent") & reason.isNull()
    skipped = status.isin("skipped", "dry_run", "verified") & reason.isin(*fv.NORMAL_SKIPS)
    code = F.coalesce(failure, F.when(sent | skipped, 0).when(status == "uncertain", 7).otherwise(1))
    exit_reason = first_reason(
        (failure.isNotNull(), "known_failure"), (sent, "delivery_completed"), (skipped, "skip"),
        (status == "uncertain", fv.UNSURE_SEND), (F.lit(True), "unclassified_delivery_failure"))
    exit_reason = F.when(exit_reason.isin("known_failure", "skip"), reason).otherwise(exit_reason)
    final = F.when(failure.isNotNull(), "daily_failed").when(sent, "daily_success").when(skipped, "normal_skip").otherwise("daily_failed")
    return runs.select("*", code.cast("int").alias("exit_code"), exit_reason.alias("exit_reason"), final.alias("final_status"))


def exception_outcome(runs: DataFrame) -> DataFrame:
    """Exit class of runs that ended in an exception: a failed model request, else the stage it names (`failure_stage`)."""
    stage = F.concat(F.coalesce("failure_stage", F.lit("unhandled")), F.lit("_failed"))
    reason = F.when(F.coalesce("model_request_failed", F.lit(False)), "model_request_failed").otherwise(stage)
    code = F.create_map(*[F.lit(x) for pair in fv.FAILURE_CODES.items() for x in pair])[reason]
    return runs.select("*", F.coalesce(code, F.lit(1)).cast("int").alias("exit_code"),
                       F.when(code.isNull(), "unhandled_failure").otherwise(reason).alias("exit_reason"), F.lit("daily_failed").alias("final_status"))


def outcome_violations(runs: DataFrame, key: str) -> DataFrame:
    """Recorded outcomes whose status is unknown or contradicts the exit code."""
    known = F.col("final_status").isin("daily_success", "normal_skip", "daily_failed")
    good = F.col("final_status").isin("daily_success", "normal_skip")
    rule = F.when(~known, "invalid_final_status").when((F.col("exit_code") == 0) != good, "inconsistent_exit_code")
    return runs.select(key, rule.alias("rule")).filter("rule is not null")


def error_kind(df: DataFrame) -> DataFrame:
    """Failure class from structured error columns (`error_type`, `http_status`, `cause_type`, `message`)."""
    kind, cause, message = F.col("error_type"), F.col("cause_type"), F.coalesce("message", F.lit(""))
    model_http = (kind == fv.MODEL_ERROR_TYPE) & message.rlike(fv.MODEL_HTTP_MESSAGE)
    return df.withColumn("error_kind", first_reason(
        ((kind == "HTTPError") | model_http, "http"),
        (kind == "TimeoutError", "timeout"), (kind == "SSLError", "ssl"),
        ((kind == "URLError") & (cause == "TimeoutError"), "timeout"),
        ((kind == "URLError") & (cause == "SSLError"), "ssl"), (kind == "URLError", "network"),
        (kind.isin("ParseError", "JSONDecodeError"), "parser"),
        ((kind == "ValueError") & (message == fv.TOO_LARGE_MESSAGE), "size_limit"),
        ((kind == "ValueError") & message.startswith(fv.REDIRECT_MESSAGE), "redirect"),
        (F.lit(True), "other")))


def attach_metadata(ids: DataFrame, articles: DataFrame) -> DataFrame:
    meta = articles.select(F.col("id").alias("article_id"), "source", "title", "published_at", "original_url")
    return ids.join(meta, "article_id", "left")


def articles_desc(df: DataFrame) -> DataFrame:
    """Newest first; rows without a valid time last; id as the tiebreak."""
    return df.orderBy(F.desc_nulls_last("published_at"), F.desc("article_id"))
