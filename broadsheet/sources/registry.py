"""The source registry: a closed JSON schema and its rules as constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet import fixed_values as fv
from broadsheet.functions import urls
from broadsheet.operators.admission import unique_violations, violations

# Numbers and flags are read as text: JSON true must not pass for 1, nor 3.0 for 3.
REGISTRY = T.StructType([
    *[T.StructField(n, T.StringType()) for n in fv.REGISTRY_FIELDS if n not in ("allow_hosts", "category", "channel", "cleaning")],
    *[T.StructField(n, T.ArrayType(T.StringType())) for n in ("allow_hosts", "category", "channel")],
    T.StructField("cleaning", T.StructType([T.StructField("include", T.StringType()), T.StructField("exclude", T.ArrayType(T.StringType()))])),
])


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """Registry rows with defaults, `unknown_fields` and the raw text fields the rules look at."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("row"))
    parsed = raw.select(F.from_json("row", REGISTRY).alias("s"), F.json_object_keys("row").alias("_keys"), "row")
    known = F.array(*[F.lit(n) for n in fv.REGISTRY_FIELDS])
    out = parsed.select("s.*", F.array_except("_keys", known).alias("unknown_fields"), "row")
    official = F.col("source_type").startswith("official")
    return out.withColumns({
        "source_role": F.coalesce("source_role", F.when(official, "primary").otherwise("media")),
        "channel": F.when(F.array_contains(F.json_object_keys("row"), "channel"), F.col("channel"))
        .otherwise(F.array(F.lit("technology"))),
        "route": F.coalesce("network_route", "proxy_mode", F.lit("system")),
        "request_timeout_seconds": F.coalesce("request_timeout_seconds", F.lit("12")),
        "request_attempts": F.coalesce("request_attempts", F.lit("2")),
        "enabled": F.coalesce("enabled", F.lit("true")), "conditional_requests": F.coalesce("conditional_requests", F.lit("true")),
    })


def _between(name: str, low: int, high: int) -> Column:
    return F.col(name).rlike(r"^-?\d+$") & F.col(name).try_cast("int").between(low, high)


def registry_violations(sources: DataFrame) -> DataFrame:
    """Broken rules per source id; an empty result means the registry loads."""
    host = urls.host(F.col("url"))
    filled = [(f"{n}_required", F.length(F.trim(F.col(n))) > 0) for n in (
        "id", "name", "source_type", "adapter", "url", "region", "language", "fetch_method", "health_status")]

    def all_in(name: str, allowed) -> Column:
        return (F.size(name) > 0) & F.forall(name, lambda x: F.coalesce(x.isin(*allowed), F.lit(False)))

    selector = fv.SELECTOR.replace("?P<", "?<")
    cleaning = F.col("cleaning")
    pattern_ok = F.col("cleaning.include").isNull() | (F.col("cleaning.include").rlike(f"(?i){selector}") & (F.col("cleaning.include") != ""))
    rules = filled + [
        ("unknown_fields", F.size("unknown_fields") == 0),
        ("id_pattern", F.col("id").rlike("^[a-z0-9][a-z0-9_-]*$")),
        ("adapter_supported", F.col("adapter").isin(*fv.ADAPTERS)),
        ("url_https", (urls.scheme(F.col("url")) == "https") & (host != "") & ~urls.has_userinfo(F.col("url"))),
        ("allow_hosts", (F.size("allow_hosts") > 0) & F.forall("allow_hosts", lambda h: F.coalesce(h.rlike("^[A-Za-z0-9.-]+$"), F.lit(False)))),
        ("url_in_allow_hosts", urls.host_in(host, F.col("allow_hosts"))),
        ("blocked_host", ~urls.blocked_host(host) & ~F.exists("allow_hosts", lambda h: urls.blocked_host(F.lower(h)))),
        ("priority_range", _between("priority", 1, 100)),
        ("fetch_method_is_adapter", F.col("fetch_method") == F.col("adapter")),
        ("health_status", F.col("health_status").isin(*fv.HEALTH_STATES)), ("tier", _between("tier", 1, 4)),
        ("category", all_in("category", fv.CATEGORIES)), ("source_role", F.col("source_role").isin(*fv.SOURCE_ROLES)),
        ("channel", all_in("channel", fv.CHANNELS)),
        ("discovery_tier", (F.col("source_role") != "discovery") | (F.col("tier") == "4")),
        ("discovery_json_role", (F.col("adapter") != "discovery_json") | ((F.col("source_role") == "discovery") & (F.col("tier") == "4"))),
        ("route_conflict", F.col("network_route").isNull() | F.col("proxy_mode").isNull() | (F.col("network_route") == F.col("proxy_mode"))),
        ("network_route", F.col("route").isin(*fv.NETWORK_ROUTES)),
        ("request_timeout_seconds", _between("request_timeout_seconds", 1, 30)), ("request_attempts", _between("request_attempts", 1, 3)),
        ("enabled_flag", F.col("enabled").isin("true", "false")), ("conditional_flag", F.col("conditional_requests").isin("true", "false")),
        ("cleaning_include", cleaning.isNull() | pattern_ok),
        ("cleaning_exclude", cleaning.isNull() | F.col("cleaning.exclude").isNull()
         | F.forall("cleaning.exclude", lambda x: F.coalesce(x.rlike(f"(?i){selector}") & (x != ""), F.lit(False)))),
    ]
    return violations(sources, ["id"], rules).unionByName(unique_violations(sources, "id", "id_unique"))


def typed_sources(sources: DataFrame) -> DataFrame:
    """The registry as the dimension table other operators join."""
    return sources.select(
        F.col("id").alias("source_id"), F.col("name").alias("source"), "source_type", "adapter", "url", F.transform("allow_hosts", F.lower).alias("allow_hosts"),
        F.col("priority").cast("int"), "article_path_pattern", F.col("enabled").cast("boolean"), "region",
        F.col("category").alias("categories"), F.col("tier").cast("int"), "language", "source_role", F.col("channel").alias("channels"),
        F.col("cleaning.include").alias("include"), F.col("cleaning.exclude").alias("exclude"))
