"""Gates: which items, articles and edition rows may pass, and the first reason why not."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.functions import text as tx
from broadsheet.functions import urls


def first_reason(*tests: tuple[Column, str]) -> Column:
    """The reason of the first test that holds; NULL when none does."""
    return reduce(lambda chain, t: F.when(t[0], t[1]) if chain is None else chain.when(t[0], t[1]), tests, None)


def admit_article(df: DataFrame, topic: Column, blocked: Column | None = None) -> DataFrame:
    """Add `reject_reason` for freshly extracted pages (NULL = admitted)."""
    body = F.coalesce(F.col("clean_text"), F.lit(""))
    blocked = ru.blocked_terms(ru.scan_text(F.col("title"), body)) if blocked is None else blocked
    return df.withColumn("reject_reason", first_reason(
        (F.col("source_role") == "discovery", "discovery_source"),
        (F.col("published_at").isNull(), "missing_publish_time"),
        (body == "", "missing_content"),
        (F.length(body) < 120, "content_shorter_than_120"),
        (blocked, "blocked_content_terms"),
        (~topic, fv.OFF_TOPIC),
    ))


def content_gate(df: DataFrame, categories=fv.CATEGORIES) -> DataFrame:
    """Add `gate_reason` for stored articles (NULL = eligible)."""
    url = F.col("original_url")
    host = urls.host(url)
    return df.withColumn("gate_reason", first_reason(
        (F.col("verification_status") != "source_verified", "source_not_verified"),
        (~F.col("category").isin(*categories), "category_not_supported"),
        (F.col("source_tier") > 3, "tier_above_3"),
        (F.col("source_role") == "discovery", "discovery_source"),
        ((urls.scheme(url) != "https") | (host == ""), "non_https_or_host_missing"),
        (urls.is_index_path(url), "index_page"),
        (urls.host_in(host, fv.BLOCKED_HOSTS), "blocked_host"),
        (ru.blocked_terms(ru.scan_text(F.col("title"), F.col("clean_text"))), "blocked_content_terms"),
    ))


def cap_enriched_importance(df: DataFrame, floor: int = 60) -> DataFrame:
    """Drop rows whose cached score is below the floor; unscored rows stay."""
    return df.filter(F.coalesce(F.col("importance") >= floor, F.lit(True)))


def purge_hosts(df: DataFrame, hosts=fv.BLOCKED_HOSTS, url: str = "original_url") -> DataFrame:
    """The table without rows of the given hosts (written back by the caller, partition by partition)."""
    return df.filter(~urls.host_in(urls.host(F.col(url)), hosts))


def violations(df: DataFrame, keys: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """One row per broken rule: `keys` plus `rule`. A rule column is true where the row is fine."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules]))
    return df.select(*keys, F.explode(broken).alias("rule"))


def unique_violations(df: DataFrame, key: str, rule: str = "unique_key") -> DataFrame:
    """Keys that occur more than once."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return counts.filter("n > 1").select(key, F.lit(rule).alias("rule"))


REQUIRED_FIELDS = ("title_cn", "title_original", "source", "published_at", "original_url")
FIELDS_BY_VERSION = {
    1: ("summary_cn", "summary_en"),
    2: ("category", "what_happened", "why_it_matters"),
    3: ("category", "what_happened", "why_it_matters", "title_en", "what_happened_en", "why_it_matters_en"),
}


def edition_item_rules(version: int, columns: list[str]) -> list[tuple[str, Column]]:
    """Publication rules of one item row; `published_at` is text here, as it is in edition files."""

    def filled(name: str) -> Column:
        return F.length(F.trim(F.col(name).cast("string"))) > 0 if name in columns else F.lit(False)

    url = F.col("original_url")
    rules = [(f"missing_{name}", filled(name)) for name in REQUIRED_FIELDS + FIELDS_BY_VERSION[version]]
    rules.append(("original_language", F.col("original_language").isin("en", "zh")))
    if version >= 2:
        rules.append(("importance_score", F.col("importance_score").between(0, 100)))
    else:
        other = F.when(F.col("original_language") == "en", "zh").otherwise("en")
        rules.append(("translation_language", F.col("translation_language") == other))
        points, translated = F.col("key_points_original"), F.col("translation")
        rules.append(("bilingual_key_points", (F.size(points) > 0) & (F.size(points) == F.size(translated))))
        rules.append(("useful_expressions", F.col("useful_expressions").isNotNull()))
    host = urls.host(url)
    texts = [F.col(c).cast("string") for c in columns if c not in ("doc_id", "feed_id", "importance_score")]
    rules += [
        ("original_url", (urls.scheme(url) == "https") & (host != "") & ~urls.has_userinfo(url)),
        ("blocked_host", ~urls.host_in(host, fv.BLOCKED_HOSTS)),
        ("published_at_zone", ru.stamped(F.col("published_at").cast("string")).isNotNull()),
        ("blocked_terms", ~ru.blocked_terms(F.concat_ws("\n", *texts))),
    ]
    return rules


def rules_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """Edition rules per feed with defaults filled in; one row per broken bound."""
    low, mid, high = (F.coalesce(F.col(c), F.lit(fv.RULES[c])) for c in ("minimum", "target", "maximum"))
    return violations(df, keys, [
        ("minimum_at_least_10", low >= 10), ("minimum_to_target", low <= mid),
        ("target_to_maximum", mid <= high), ("maximum_at_most_18", high <= 18)])


REPORT_FIELDS = ("title_en", "title_cn", "what_happened_en", "what_happened", "why_it_matters_en", "why_it_matters",
                 "source", "published_at", "original_url")


def report_checks(editions: DataFrame, keys: list[str], expected_date: str = "partition_date") -> DataFrame:
    """Checks before an edition is sent: date, size and filled bilingual fields."""

    def complete(item: Column) -> Column:
        tests = [F.length(F.trim(F.coalesce(item[f].cast("string"), F.lit("")))) > 0 for f in REPORT_FIELDS]
        return reduce(lambda a, b: a & b, tests) & item["original_url"].startswith("https://")

    return violations(editions, keys, [
        ("report_missing_or_empty", (F.col("report_date") == F.col(expected_date)) & (F.size("items") > 0)),
        ("article_count", F.col("article_count") == F.size("items")),
        ("item_fields", F.forall("items", complete)),
    ])
