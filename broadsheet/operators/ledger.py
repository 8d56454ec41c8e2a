"""Token ledger, daily budget and model-request accounting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.operators.ordered import running_before

USAGE_FIELDS = ("prompt_tokens", "completion_tokens", "total_tokens", "prompt_cache_hit_tokens", "prompt_cache_miss_tokens")


def flatten_usage(usage: DataFrame, raw: str = "raw_usage_json") -> DataFrame:
    """Ledger columns out of the raw usage object; unknown vendor fields stay in the raw text."""

    def number(path: str) -> Column:
        return F.get_json_object(raw, path).try_cast("bigint")

    names = {"prompt_tokens": "input_tokens", "completion_tokens": "output_tokens"}
    return usage.select("*", *[number(f"$.{f}").alias(names.get(f, f)) for f in USAGE_FIELDS],
                        number("$.completion_tokens_details.reasoning_tokens").alias("reasoning_tokens"))


def daily_tokens(ledger: DataFrame) -> DataFrame:
    """Total tokens per day over the covered range; days without a call count zero."""
    daily = ledger.groupBy(F.to_date("created_at").alias("day")).agg(F.sum("total_tokens").alias("_total"))
    span = daily.agg(F.min("day").alias("low"), F.max("day").alias("high"))
    spine = span.filter("low is not null").select(F.explode(F.sequence("low", "high")).alias("day"))
    return spine.join(daily, "day", "left").select("day", F.coalesce("_total", F.lit(0)).cast("bigint").alias("total_tokens"))


def usage_rollup(ledger: DataFrame, by: list[Column | str]) -> DataFrame:
    def total(name: str) -> Column:
        return F.sum(F.coalesce(F.col(name), F.lit(0))).cast("bigint")

    return ledger.groupBy(*by).agg(
        F.count("*").alias("calls"), total("input_tokens").alias("input_tokens"),
        total("output_tokens").alias("output_tokens"), total("total_tokens").alias("total_tokens"),
        total("prompt_cache_hit_tokens").alias("cache_hit_tokens"),
        total("prompt_cache_miss_tokens").alias("cache_miss_tokens"))


def budget_admission(batches: DataFrame, keys: list[str], chunk: Column, order: list, rank: Column,
                     budget: int = fv.DAILY_TOKENS, accepted: str | None = None) -> DataFrame:
    """Batches admitted in order until the first that does not fit the day's budget.

    Adds `used_before`, `admitted` and `budget_status`; `rank` is the order as one comparable value.
    """
    out = running_before(batches, keys, chunk, order, {"used_before": (F.col("used"), "sum")})
    fits = F.col("used_before") + F.col("required") <= budget
    out = out.withColumn("_rank", rank)
    stop = out.filter(~fits).groupBy(*keys).agg(F.min("_rank").alias("_stop"))
    out = out.join(stop, keys, "left")
    admitted = F.col("_stop").isNull() | (F.col("_rank") < F.col("_stop"))
    done = F.col(accepted) if accepted else F.col("used_before")
    status = F.when(admitted, "normal").when(done >= 1, "graceful_stop").otherwise("exhausted_before_minimum")
    return out.withColumn("admitted", admitted).withColumn("budget_status", status).drop("_rank", "_stop")


def char_limit_plan(articles: DataFrame, batch: list[str], keys: list[str], remaining: Column, start: int = 4000,
                    floor: int = 1200, step: int = 200, overhead: int = 0) -> DataFrame:
    """Per-batch character limit: the largest step down from `start` whose request fits `remaining`.

    The limit only ever falls: a later batch starts from the limit an earlier one needed.
    Articles carry `chars`; all limits are tried in one aggregate, without exploding a grid.
    """
    grid = sorted({max(floor, start - step * i) for i in range((start - floor) // step + 2)} | {start}) if start > floor else [start]
    sums = [F.sum(F.least("chars", F.lit(limit))).alias(f"_c{limit}") for limit in grid]
    out = articles.groupBy(*batch).agg(F.count("*").alias("members"), F.max(remaining).alias("_left"), *sums)

    def need(limit: int) -> Column:
        return ru.estimate_tokens(F.col(f"_c{limit}") + overhead, ru.output_allocation(F.col("members")), F.lit(0))

    fitting = F.greatest(F.lit(grid[0]), *[F.when(need(limit) <= F.col("_left"), limit) for limit in grid]) if len(grid) > 1 else F.lit(grid[0])
    out = out.withColumn("own_limit", fitting.cast("int"))
    position = [c for c in batch if c not in keys]
    out = running_before(out, keys, F.floor(F.col(position[0]) / 1000), position, {"_carried": (F.col("own_limit"), "min")})
    limit = F.least("own_limit", F.coalesce("_carried", F.lit(start))).cast("int")
    out = out.withColumn("char_limit", limit)
    chosen = F.coalesce(*[F.when(F.col("char_limit") == g, need(g)) for g in grid])
    return out.select(*batch, "members", "char_limit", chosen.alias("required_tokens"), (chosen <= F.col("_left")).alias("fits"))


def observed_ratio(batches: DataFrame, keys: list[str], chunk: Column, order: list) -> DataFrame:
    """Largest prompt-token-per-character ratio seen in earlier batches (0 before the first)."""
    ratio = F.when(F.col("prompt_tokens") > 0, F.try_divide(F.col("prompt_tokens"), F.col("chars")))
    out = running_before(batches, keys, chunk, order, {"_seen": (ratio, "max")})
    return out.withColumn("observed_ratio", F.coalesce("_seen", F.lit(0.0))).drop("_seen")


def batch_rollup(attempts: DataFrame, batch: list[str], order: Column) -> DataFrame:
    """Tokens, retries and the final finish reason per batch; token sums stay NULL without any usage."""
    has_usage = F.col("total_tokens").isNotNull()
    sums = [F.sum(F.when(has_usage, F.coalesce(F.col(c), F.lit(0)))).alias(c)
            for c in ("prompt_tokens", "completion_tokens", "total_tokens")]
    return attempts.groupBy(*batch).agg(
        *sums, F.greatest(F.count("*") - 1, F.lit(0)).alias("retry_count"),
        F.max_by("finish_reason", order).alias("finish_reason"))


def validation_counts(validations: DataFrame, batch: list[str]) -> DataFrame:
    """Passed validations and repair attempts and successes per batch."""
    repaired = F.col("repair_reason")
    return validations.groupBy(*batch).agg(
        F.count_if(F.col("validation_status") == "kept").alias("validation_passed"),
        F.count_if(repaired.isin("field_repair_requested", "repair_failed", "repair_succeeded")).alias("repair_attempts"),
        F.count_if(repaired == "repair_succeeded").alias("repair_successes"))


def readiness_summary(attempts: DataFrame, request: list[str], kinds=("h5", "json")) -> DataFrame:
    """First HTTP 200 per address kind, total probing time and the verdict per request."""
    ready = [F.min(F.when((F.col("kind") == k) & (F.col("http_status") == 200), F.col("ts"))).alias(f"{k}_first_200_at") for k in kinds]
    out = attempts.groupBy(*request).agg(F.min("ts").alias("_start"), F.max("ts").alias("_end"), *ready)
    both = reduce(lambda a, b: a & b, [F.col(f"{k}_first_200_at").isNotNull() for k in kinds])
    end = F.when(both, F.greatest(*[F.col(f"{k}_first_200_at") for k in kinds])).otherwise(F.col("_end"))
    total = F.floor((F.unix_micros(end) - F.unix_micros("_start") + 5) / 10) / F.lit(100.0)
    return out.select(*request, *[f"{k}_first_200_at" for k in kinds], total.alias("readiness_total_ms"),
                      F.when(both, "ready").otherwise("publish_verification_failed").alias("readiness_result"))


def retry_counts(attempts: DataFrame, request: list[str]) -> DataFrame:
    return attempts.groupBy(*request).agg(F.greatest(F.count("*") - 1, F.lit(0)).alias("retry_count"))


DISPATCH_KEY = ["report_date", "report_id", "target_type", "target_id"]


def dispatch_pending(editions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Editions not yet recorded for their target; forced repeats never block, any status does."""
    recorded = ledger.filter(~F.col("force_resend")).select(*DISPATCH_KEY).distinct()
    return editions.join(recorded, DISPATCH_KEY, "left_anti")


def dispatch_state(ledger: DataFrame, key: list[str], order: Column) -> DataFrame:
    """Latest state per dispatch; `sent_at` only where the latest state is sent."""
    out = ledger.groupBy(*key).agg(F.max_by(F.struct("status", "updated_at"), order).alias("_last"),
                                   F.greatest(F.count("*") - 1, F.lit(0)).alias("retry_count"))
    return out.select(*key, F.col("_last.status").alias("status"), "retry_count",
                      F.when(F.col("_last.status") == "sent", F.col("_last.updated_at")).alias("sent_at"))


def illegal_dispatch(ledger: DataFrame, key: str = "attempt_id") -> DataFrame:
    legal = F.coalesce(F.col("status").isin("pending", "sent", "failed", "uncertain"), F.lit(False))
    return ledger.filter(~legal).select(key, F.col("status").alias("illegal_status"))
