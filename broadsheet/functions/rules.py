"""Dates, freshness, scores and budget arithmetic as native columns."""

from __future__ import annotations

from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet import fixed_values as fv
from broadsheet.functions import text as tx
from broadsheet.functions import urls


# --- time --------------------------------------------------------------------
def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def age_hours(ts: Column, now: Column) -> Column:
    return (micros(now) - micros(ts)) / F.lit(3_600_000_000.0)


def age_days(ts: Column, now: Column) -> Column:
    return (micros(now) - micros(ts)) / F.lit(86_400_000_000.0)


def in_window(ts: Column, now: Column, hours: int) -> Column:
    return ts.between(now - F.expr(f"INTERVAL {hours} HOURS"), now + F.expr(f"INTERVAL {fv.FUTURE_MINUTES} MINUTES"))


def local_date(ts: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, fv.LOCAL_ZONE))


ISO_DATE = r"^\d{4}-?\d{2}-?\d{2}"
HAS_OFFSET = r"(?i)^\d{4}-\d{2}-\d{2}[T ]\d{2}(:?\d{2}){0,2}([.,]\d+)?\s*(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)$"


@F.pandas_udf(T.TimestampType())
def _mail_date(values: pd.Series) -> pd.Series:
    """RFC 2822 dates; anything else is NULL."""

    def read(value):
        if value is None:
            return None
        try:
            stamp = parsedate_to_datetime(value)
        except (TypeError, ValueError, IndexError, OverflowError):
            return None
        stamp = pd.Timestamp(stamp)
        return stamp.tz_localize("UTC") if stamp.tzinfo is None else stamp.tz_convert("UTC")

    return pd.to_datetime(values.map(read, na_action="ignore"), utc=True)


def iso_timestamp(value: Column) -> Column:
    """ISO dates and date-times; a missing offset means UTC."""
    shaped = F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?)?$"), value)
    return F.coalesce(
        shaped.try_cast("timestamp"),
        F.try_to_timestamp(F.when(value.rlike(r"^\d{8}$"), value), F.lit("yyyyMMdd")),
    )


MONTH = "(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
WRITTEN_DATES = (
    # full pattern, order of (month, day, year) groups
    (rf"(?i)^({MONTH}[a-z]*) (\d{{1,2}}), (\d{{4}})$", (1, 2, 3)),
    (rf"(?i)^(\d{{1,2}}) ({MONTH}[a-z]*) (\d{{4}})$", (2, 1, 3)),
)
MONTH_WORDS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
    "november", "december",
)


def month_number(word: Column) -> Column:
    """Number of a full English month name or its three-letter form, else NULL."""
    low = F.lower(word)
    cases = None
    for number, name in enumerate(MONTH_WORDS, start=1):
        test = low.isin(name, name[:3])
        cases = F.when(test, number) if cases is None else cases.when(test, number)
    return cases


def written_date(value: Column) -> Column:
    """`Sep 5, 2026`, `September 5, 2026` and `5 September 2026`."""
    found = []
    for pattern, (month, day, year) in WRITTEN_DATES:
        number = month_number(F.regexp_extract(value, pattern, month))
        found.append(F.try_to_timestamp(
            F.concat_ws("-", F.regexp_extract(value, pattern, year), number.cast("string"),
                        F.regexp_extract(value, pattern, day)), F.lit("yyyy-M-d")))
    return F.coalesce(*found)


def parse_published(value: Column) -> Column:
    """Published time in UTC: mail dates, ISO, then written dates; otherwise NULL."""
    trimmed = tx.squeeze(value)
    # Only strings no native form covers travel to the mail-date helper.
    native = F.coalesce(iso_timestamp(trimmed), written_date(trimmed))
    odd = F.when(native.isNull() & trimmed.rlike(r"\d"), trimmed)
    return F.coalesce(native, _mail_date(odd))


def index_title_date(title: Column) -> Column:
    found = F.regexp_extract(title, "(?i)" + fv.TITLE_DATE, 0)
    return written_date(F.regexp_replace(found, r"\s+", " "))


# --- headline signals ------------------------------------------------------------
def on_topic(text: Column, words: str = fv.TOPIC_WORDS, stems: str = fv.TOPIC_STEMS + "|" + fv.WIDE_TOPIC_STEMS) -> Column:
    hit = tx.matches(text, tx.some_word(words))
    return hit | tx.matches(text, tx.begun(stems) + f"({stems})") if stems else hit


def blocked_terms(text: Column, words: str = fv.BLOCKED_WORDS) -> Column:
    return tx.matches(text, tx.bounded(words))


def scan_text(title: Column, body: Column) -> Column:
    """Headline plus the first 3,000 body characters: the range the content rules look at."""
    return F.concat(title, F.lit(" "), F.substring(body, 1, fv.SCAN_CHARS))


def editorial_candidate(title: Column) -> Column:
    return ~tx.matches(title, f"({fv.LOW_VALUE_TITLE})")


def short_lived(text: Column) -> Column:
    def search(t: Column) -> Column:
        return tx.let(F.lower(t), lambda low: tx.holds_part(t, low, fv.SHORT_LIVED_PARTS)) & tx.matches(t, f"({fv.SHORT_LIVED})")

    return tx.let(text, search)


def deep_read(title: Column, body: Column, tier: Column, terms: str = fv.DEEP_TITLE) -> Column:
    return (tier <= 2) & tx.matches(title, f"({terms})") & (F.length(body) >= fv.DEEP_CHARS)


def category_of(text: Column, categories: Column) -> Column:
    """First matching rule whose category the source may use, else its first category."""
    chain = None
    for name, pattern in fv.CATEGORY_RULES:
        test = F.array_contains(categories, name) & tx.matches(text, f"({pattern})")
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain.otherwise(F.get(categories, F.lit(0)))


def channel_of(category: Column, channels: Column) -> Column:
    chain = None
    for channel, members in fv.CHANNEL_GROUPS:
        test = category.isin(*members) & F.array_contains(channels, channel)
        chain = F.when(test, channel) if chain is None else chain.when(test, channel)
    return chain.otherwise(F.get(channels, F.lit(0)))


# --- supply levels and scores ------------------------------------------------------
def supply_level(ts: Column, tier: Column, is_deep: Column, now: Column) -> Column:
    age = micros(now) - micros(ts)
    hour = 3_600_000_000
    return (
        F.when(age < -10 * 60_000_000, None)
        .when(age <= 24 * hour, F.when(tier <= 2, 1).otherwise(2))
        .when(age <= 72 * hour, 3)
        .when((age <= 168 * hour) & is_deep, 4)
    )


def importance(cached: Column, title: Column, terms: str = fv.IMPACT_TITLE) -> Column:
    return F.coalesce(cached, F.lit(60) + 15 * tx.matches(title, f"({terms})").cast("int"))


def rank_score(importance_score: Column, tier: Column, category: Column, personal=fv.RULES["personal_categories"]) -> Column:
    points = None
    for value, score in fv.TIER_POINTS:
        points = F.when(tier == value, score) if points is None else points.when(tier == value, score)
    relevance = F.when(category.isin(*personal), 100).otherwise(0)
    return F.lit(0.6) * importance_score + F.lit(0.2) * points + F.lit(10) + F.lit(0.1) * relevance


def age_band(days: Column) -> Column:
    return F.when(days <= 3, "1-3d").when(days <= 7, "3-7d").when(days <= 30, "7-30d").otherwise("30-365d")


def daily_mode(count: Column, minimum: int = fv.RULES["minimum"]) -> Column:
    return (F.when(count >= minimum, "normal").when(count >= 5, "graceful_degraded")
            .when(count >= 1, "minimal_daily").otherwise("true_failure"))


def reading_minutes(items: Column) -> Column:
    chars = F.aggregate(items, F.lit(0), lambda total, item: total
                        + F.length(F.coalesce(item["what_happened"], F.lit("")))
                        + F.length(F.coalesce(item["why_it_matters"], F.lit(""))))
    return F.greatest(F.lit(5), F.least(F.lit(10), F.ceil(chars / 650).cast("int")))


# --- token budget ---------------------------------------------------------------
def input_tokens(chars: Column, ratio: Column) -> Column:
    return F.greatest(F.floor((chars + 2) / 3), F.ceil(chars / 2), F.ceil(chars * ratio)).cast("bigint")


def estimate_tokens(chars: Column, output: Column, ratio: Column) -> Column:
    """Input estimate plus reserved output plus a 10 % (at least 256) safety margin."""
    need = input_tokens(chars, ratio)
    return (need + output + F.greatest(F.lit(256), F.ceil(need * F.lit(0.1)))).cast("bigint")


def output_allocation(members: Column, cap: int = 7200, batch: int = 12) -> Column:
    return F.least(F.lit(cap), F.greatest(F.lit(1800), F.floor((F.lit(cap) * members + batch - 1) / batch))).cast("bigint")


# --- reserve evidence --------------------------------------------------------------
def stamped(value: Column) -> Column:
    """A timestamp that names its offset, else NULL."""
    return F.when(value.rlike(HAS_OFFSET), value).try_cast("timestamp")


def validity_expired(end: Column, now: Column) -> Column:
    """A bare or unreadable end of validity counts as expired."""
    return F.coalesce(stamped(end) <= now, F.lit(True))


def policy_evidence_ok(prior: dict[str, Column], article_url: Column, now: Column) -> Column:
    url = F.coalesce(prior["policy_evidence_url"], F.lit(""))
    name = urls.host(url)
    checked = stamped(prior["policy_checked_at"])
    lag = micros(now) - micros(checked)
    start_text = F.nullif(prior["validity_start"], F.lit(""))
    start_ok = start_text.isNull() | F.coalesce(stamped(start_text) <= now, F.lit(False))
    return (
        (urls.scheme(url) == "https")
        & ((name == urls.host(article_url)) | name.endswith(".gov.cn"))
        & (F.length(F.coalesce(prior["policy_validity_evidence"], F.lit(""))) > 0)
        & F.coalesce(lag.between(0, 7 * 86_400_000_000), F.lit(False))
        & start_ok
    )


def deep_evidence(body: Column, tier: Column) -> Column:
    """Kinds of body evidence with the matched text; empty unless at least two kinds are found."""

    def build(text: Column, lowered: Column) -> Column:
        kinds = [
            F.struct(F.lit(kind).alias("key"), F.when(tx.holds_part(text, lowered, fv.DEEP_EVIDENCE_PARTS[kind]), F.regexp_extract(
                text, f"(?iu)({pattern})", 0)).otherwise("").alias("value"))
            for kind, pattern in fv.DEEP_EVIDENCE
        ]
        steps = F.when(tx.holds_part(text, lowered, fv.NUMBERED_STEP_PARTS), F.array_sort(F.array_distinct(
            F.regexp_extract_all(text, F.lit("(?iu)" + fv.NUMBERED_STEP), 1))))
        numbered = F.struct(F.lit("procedural_steps").alias("key"),
                            F.when(F.size(steps) >= 2, F.array_join(steps, ",")).otherwise("").alias("value"))
        return F.map_filter(F.map_from_entries(F.array(*kinds, numbered)), lambda _, found: found != "")

    enough = (F.length(body) >= 1500) & (tier <= 2)
    found = tx.let(F.when(enough, body).otherwise(F.lit("")), lambda text: tx.let(F.lower(text), lambda lowered: build(text, lowered)))
    return tx.let(found, lambda kinds: F.when(F.size(kinds) >= 2, kinds).otherwise(
        F.map_filter(kinds, lambda _kind, _found: F.lit(False))))
