"""Edition documents, their index, digests and the reasons behind a short edition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru

ITEM_FIELDS = ("title_en", "title_cn", "title_original", "what_happened_en", "what_happened", "why_it_matters_en",
               "why_it_matters", "source", "published_at", "original_url", "category", "importance_score")


def build_edition(selection: DataFrame, enrichments: DataFrame, keys: list[str], version: int = 3,
                  published_at: Column | None = None) -> DataFrame:
    """One document per edition: items in pick order, highlights, reading time, mode.

    `selection` holds `keys`, `id`, `pick`; an edition has at most 18 items by rule. `published_at` is the edition's own
    time as ISO text, a column of the keys.
    """
    chosen = selection.select(*keys, F.col("id").alias("article_id"), "pick")
    items = chosen.join(enrichments.select("article_id", *ITEM_FIELDS), "article_id")
    listed = items.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pick", "article_id", *ITEM_FIELDS))).alias("items"))
    titles = F.filter(F.transform(F.slice("items", 1, 3), lambda i: i["title_cn"]), lambda t: F.trim(t) != "")
    return listed.select(
        *keys, F.lit(version).alias("schema_version"), F.lit(fv.EDITION_CATEGORY[version]).alias("category"),
        (F.lit(None) if published_at is None else published_at).cast("string").alias("published_at"), F.size("items").alias("article_count"), ru.daily_mode(F.size("items")).alias("daily_mode"),
        ru.reading_minutes(F.col("items")).alias("estimated_reading_minutes"), titles.alias("highlights"), "items")


def edition_summaries(editions: DataFrame, keys: list[str]) -> DataFrame:
    return editions.select(*keys, "category", "schema_version", "article_count", "estimated_reading_minutes", "highlights", "daily_mode")


def edition_index(index: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The index with same-date entries replaced, newest first."""
    return index.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*index.columns)).orderBy(F.desc("report_date"))


def write_editions(editions: DataFrame, path: str) -> None:
    """JSON per report date; a rewritten date replaces itself and nothing else."""
    (editions.hint("rebalance", F.col("report_date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("report_date").json(path))


def read_history(spark, path: str, schema, as_of: Column) -> DataFrame:
    """Items of all editions up to a local date, with their edition's columns (named `edition_...` where an item has one
    of that name); later dates are pruned."""
    editions = spark.read.schema(schema).json(path).filter(F.col("report_date") <= as_of)
    inner = editions.schema["items"].dataType.elementType.names
    rest = {c: f"edition_{c}" if c in inner else c for c in editions.columns if c not in ("items", "report_date")}
    flat = editions.select("report_date", *[F.col(c).alias(n) for c, n in rest.items()], F.explode("items").alias("item"))
    return flat.select("report_date", *rest.values(), "item.*")


DIGEST_FIELDS = ("schema_version", "report_date", "published_at", "article_count", "items")


def edition_digest(editions: DataFrame, fields=DIGEST_FIELDS) -> Column:
    """First 32 hex digits of the SHA-256 of the sorted-key compact JSON of the given fields."""
    ordered = F.struct(*[_sorted(F.col(f), editions.schema[f].dataType).alias(f) for f in sorted(fields)])
    return F.substring(F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256), 1, 32)


def _sorted(value: Column, kind) -> Column:
    from pyspark.sql import types as T

    if isinstance(kind, T.StructType):
        return F.struct(*[_sorted(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _sorted(item, kind.elementType))
    return value


def shortfall_reason(runs: DataFrame) -> DataFrame:
    """Why an edition is below normal size (NULL for a normal one)."""
    mode = ru.daily_mode(F.col("publishable"))
    minimum = fv.RULES["minimum"]
    reason = (F.when(mode == "normal", None)
              .when(F.col("fill_stopped"), "enrichment_fill_stopped_after_model_failure")
              .when(F.col("budget_status") != "normal", "token_budget_insufficient_for_next_batch")
              .when(F.col("chosen") < minimum, "eligible_candidate_shortage")
              .when((F.col("publishable") < minimum) & (F.col("rejected") > 0), "validation_rejections")
              .otherwise("final_selection_shortfall"))
    return runs.withColumn("daily_mode", mode).withColumn("degraded_reason", reason)


PAIR_FIELDS = ("title_en", "title_cn", "what_happened_en", "what_happened", "why_it_matters_en", "why_it_matters")


def merge_pairs_by_id(editions: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Bilingual pairs applied to legacy items by position; the editions with exactly one pair per item, with all their
    columns."""
    rows = editions.select(*keys, F.posexplode("items").alias("pos", "item"))
    sizes = editions.select(*keys, F.size("items").alias("_size"))
    good = pairs.groupBy(*keys).agg(F.count("*").alias("_pairs"), F.countDistinct("pos").alias("_distinct"),
                                    F.min("pos").alias("_low"), F.max("pos").alias("_high")).join(sizes, keys)
    size = F.col("_size")
    good = good.filter((F.col("_pairs") == size) & (F.col("_distinct") == size) & (F.col("_low") == 0) & (F.col("_high") == size - 1))
    merged = rows.join(pairs.join(good.select(*keys), keys, "left_semi"), [*keys, "pos"])
    keep = [c for c in editions.schema["items"].dataType.elementType.names if c not in PAIR_FIELDS]
    item = F.struct(*[F.col(f"item.{c}").alias(c) for c in keep], *[F.col(c) for c in PAIR_FIELDS])
    changed = merged.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", item.alias("item")))).alias("_r")).select(
        *keys, F.lit(3).alias("schema_version"), F.transform("_r", lambda r: r["item"]).alias("items"))
    kept = [c for c in editions.columns if c not in (*keys, "schema_version", "items")]
    return editions.select(*keys, *kept).join(changed, keys)
