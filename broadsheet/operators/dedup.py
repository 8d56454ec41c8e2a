"""Uniqueness of URLs, fingerprints and releases, within a batch and against the stored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import text as tx
from broadsheet.session import small, stored


def unique_urls(items: DataFrame, url: str, seq: str) -> DataFrame:
    """One row per URL: the last row's values at the first row's place (`first_seq`).

    An aggregate, so a URL repeated a million times is reduced before it is shuffled.
    """
    rest = [c for c in items.columns if c != url]
    best = items.groupBy(url).agg(F.max_by(F.struct(*rest), seq).alias("_last"), F.min(seq).alias("first_seq"))
    return best.select(url, "_last.*", "first_seq")


def first_per_key(df: DataFrame, keys: list, order: list, limit: int = 1) -> DataFrame:
    """The first rows of each key; Spark trims every task to `limit` rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= limit).drop("_rank")


def first_fingerprint(batch: DataFrame, seq: str = "seq") -> DataFrame:
    """Newest article of each fingerprint; exact because URLs are already unique."""
    return first_per_key(batch, ["fingerprint"], [F.desc("published_at"), F.asc(seq)])


def source_cap(items: DataFrame, seq: str, cap: int = fv.SOURCE_CAP, source: str = "source_id") -> DataFrame:
    """At most `cap` items per source in collection order; undated items come last but may pass."""
    order = [F.coalesce(F.unix_micros("published_at"), F.lit(0)).desc(), F.asc("priority"), F.asc(seq)]
    return first_per_key(items, [source], order, cap)


def order_candidates(items: DataFrame, seq: str) -> DataFrame:
    return items.orderBy(F.coalesce(F.unix_micros("published_at"), F.lit(0)).desc(), "priority", seq)


def collapse_release_bursts(articles: DataFrame, tiebreak: str = "id") -> DataFrame:
    """Same-day patch releases of one minor version keep only the newest; other articles pass."""
    changelog = F.col("source_type") == "official_changelog"
    series = F.when(changelog, tx.release_series(F.col("title")))
    # Other rows get a key of their own, so they neither wait for nor join a hot series.
    own = F.when(~changelog, F.col(tiebreak))
    keyed = articles.select("*", series.alias("_series"), own.alias("_own"), F.to_date("published_at").alias("_day"))
    kept = first_per_key(keyed, ["source", "_day", "_series", "_own"], [F.desc("published_at"), F.asc(tiebreak)])
    return kept.drop("_series", "_own", "_day")


def exclude_known(batch: DataFrame, known: DataFrame, url: str = "original_url", key: str = "fingerprint") -> DataFrame:
    """Drop rows whose URL or fingerprint is stored already: two equi anti-joins instead of one OR join."""
    urls = known.select(url).distinct()
    prints = known.select(key).distinct()
    return batch.join(urls, url, "left_anti").join(prints, key, "left_anti")


def colliding(known: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored keys a small batch can collide with: the table is scanned, only matches are shuffled.

    Larger batches keep the whole table, whose join then is the cheaper one.
    """
    keys = known.select("original_url", "fingerprint")
    if not small(batch):
        return keys
    by_url = keys.join(F.broadcast(batch.select("original_url").distinct()), "original_url", "left_semi")
    by_print = keys.join(F.broadcast(batch.select("fingerprint").distinct()), "fingerprint", "left_semi")
    return by_url.unionByName(by_print)


LAST_ROWS = 100_000  # colliding rows (narrow) that one task admits one by one


def first_of_both(batch: DataFrame, seq: str = "seq", url: str = "original_url", key: str = "fingerprint") -> DataFrame:
    """The rows that are admitted one by one, newest first, if no row admitted before has their URL or fingerprint. A null is
    no key: it bars nobody and is barred by nobody.

    A row that is dropped for one key bars nobody by its other key, so this is not the first of each. Rows that lead both
    their URL and their fingerprint are admitted together, what they bar leaves, and the rest is judged again; only rows
    that collide take part in a further round. When at most LAST_ROWS are left, one task goes through them in order, so a long
    chain of collisions takes no round per link. `seq` tells rows apart.
    """
    rank = F.struct(F.col("published_at").isNull(), -F.unix_micros("published_at"), F.col(seq))

    def own(name: str, mark: str) -> Column:  # a null gets a key that no other row has
        return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.concat(F.lit(mark), F.col(seq).cast("string")))

    batch = stored(batch, "batch")
    waiting = batch.select(F.col(seq).alias("_seq"), own(url, "u").alias("_url"), own(key, "k").alias("_key"), rank.alias("_rank"))
    admitted: DataFrame | None = None
    while True:
        by_url = waiting.groupBy("_url").agg(F.min("_rank").alias("_url_first"))
        by_key = waiting.groupBy("_key").agg(F.min("_rank").alias("_key_first"))
        leads = waiting.join(by_url, "_url").join(by_key, "_key").filter(
            (F.col("_rank") == F.col("_url_first")) & (F.col("_rank") == F.col("_key_first")))
        leads = stored(leads.select("_seq", "_url", "_key"), "admitted")
        admitted = leads if admitted is None else admitted.unionByName(leads)
        waiting = stored(waiting.join(leads.select("_url"), "_url", "left_anti").join(leads.select("_key"), "_key", "left_anti"), "waiting")
        if small(waiting, LAST_ROWS):
            admitted = admitted.unionByName(_one_by_one(waiting))
            return batch.join(admitted.select(F.col("_seq").alias(seq)), seq, "left_semi").select(*batch.columns)


def _one_by_one(waiting: DataFrame) -> DataFrame:
    """The admitted rows of a bounded rest, in one task."""

    def admit(parts):
        urls, keys = set(), set()
        for part in parts:
            kept = []
            for n, (a, b) in enumerate(zip(part["_url"], part["_key"])):
                if a not in urls and b not in keys:
                    urls.add(a)
                    keys.add(b)
                    kept.append(n)
            yield part.iloc[kept]

    rows = waiting.repartition(1).sortWithinPartitions("_rank").select("_seq", "_url", "_key")
    return rows.mapInPandas(admit, rows.schema)


def new_articles(batch: DataFrame, known: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows of a batch that may be appended: unknown to the table, and admitted by URL and fingerprint among themselves."""
    return first_of_both(exclude_known(batch, known), seq)


def unenriched(articles: DataFrame, enrichments: DataFrame, task: str, limit: int, after: Column | None = None,
               before: Column | None = None) -> DataFrame:
    """Newest verified articles without a rendering for the task."""
    done = enrichments.filter(F.col("task") == task).select(F.col("article_id").alias("id"))
    open_ = articles.filter(F.col("verification_status") == "source_verified")
    if after is not None:
        open_ = open_.filter(F.col("published_at") >= after)
    if before is not None:
        open_ = open_.filter(F.col("published_at") <= before)
    return open_.join(done, "id", "left_anti").orderBy(F.desc("published_at"), "id").limit(limit)


def with_enrichment(articles: DataFrame, enrichments: DataFrame, how: str = "inner") -> DataFrame:
    return articles.join(enrichments.withColumnRenamed("article_id", "id"), "id", how)


def inventory_top(articles: DataFrame, enrichments: DataFrame, limit: int = 100, cached_first: bool = False) -> DataFrame:
    """Newest cached articles (1..300); the preview form also lists uncached ones, after the cached."""
    if not 1 <= limit <= 300:
        raise ValueError("inventory limit must be 1..300")
    cached = enrichments.select(F.col("article_id").alias("id"), F.lit(True).alias("cached")).distinct()
    joined = articles.join(cached, "id", "left" if cached_first else "inner")
    order = [F.desc("published_at"), F.asc("id")]
    if cached_first:
        order.insert(0, F.coalesce("cached", F.lit(False)).desc())
    return joined.orderBy(*order).limit(limit)


def cache_reason(article: str = "a", cached: str = "e", task: str = fv.ENRICH_TASK) -> Column:
    """Why a cached rendering may not be reused (NULL = its metadata fits)."""

    def a(name: str) -> Column:
        return F.col(f"{article}.{name}")

    def e(name: str) -> Column:
        return F.col(f"{cached}.{name}")

    filled = (F.length(F.coalesce(e("model"), F.lit(""))) > 0) & e("generated_at").isNotNull()
    same = a("id").eqNullSafe(e("article_id"))
    for left, right in (("original_url", "original_url"), ("published_at", "published_at"), ("source", "source"),
                        ("original_title", "title_original")):
        same = same & a(left).eqNullSafe(e(right))
    return (F.when(e("article_id").isNull(), "cache_missing")
            .when(~((e("task") == task) & filled), "cache_version_incompatible")
            .when(~same, "cache_metadata_mismatch"))
