"""Parquet tables: append, upsert, captures, schema evolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.operators.dedup import first_of_both
from broadsheet.session import stored
from broadsheet.sources import keys


def write_articles(df: DataFrame, path: str) -> None:
    # Rebalanced, not hash-partitioned: a day holding most rows is still written by many tasks.
    df.hint("rebalance", F.col("published_date")).write.mode("append").partitionBy("published_date").parquet(path)


def append_articles(batch: DataFrame, path: str, seq: str = "seq") -> DataFrame:
    """Append what the table does not hold yet and return it (single writer: nothing enforces keys).

    Known keys are looked up in the table's key index, of which only the touched buckets are read; a table without one gets it
    here. Should a run end between table and index, `keys.rebuild_keys` makes them agree again.
    """
    spark = batch.sparkSession
    batch = stored(batch, "batch")
    part = keys.next_part(spark, path)
    if part == 0:
        keys.rebuild_keys(spark, path)
        part = 1
    # Stored first: the append must not re-read an index it is changing.
    fresh = stored(first_of_both(keys.unknown(batch, path), seq), "fresh")
    write_articles(fresh, path)
    keys.write_keys(fresh, path, part)
    return fresh


def upsert_by_key(current: DataFrame, changes: DataFrame, key: list[str], keep: list[str] = ()) -> DataFrame:
    """Changed rows replace current ones; columns in `keep` stay as first written."""
    a, b = current.alias("a"), changes.alias("b")
    joined = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key], "full")
    first = key[0]

    def value(name: str) -> Column:
        old, new = F.col(f"a.{name}"), F.col(f"b.{name}")
        if name in key:
            return F.coalesce(new, old).alias(name)
        if name in keep:
            return F.coalesce(old, new).alias(name)
        return F.when(F.col(f"b.{first}").isNotNull(), new).otherwise(old).alias(name)

    return joined.select(*[value(c) for c in current.columns])


def latest_capture(captures: DataFrame, key: list[str], order: str, values: list[str]) -> DataFrame:
    """Newest stored body and validators per source and address."""
    out = captures.groupBy(*key).agg(F.max_by(F.struct(order, *values), order).alias("_last"))
    return out.select(*key, "_last.*")


def normalize_schema(df: DataFrame, target: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Project onto the target schema; missing or NULL columns take their default."""
    defaults = defaults or {}
    columns = []
    for field in target.fields:
        present = F.col(field.name).cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        if field.name in defaults:
            present = F.coalesce(present, F.lit(defaults[field.name]).cast(field.dataType))
        columns.append(present.alias(field.name))
    return df.select(*columns)


def append_usage(usage: DataFrame, path: str) -> None:
    from broadsheet.operators.ledger import flatten_usage

    flatten_usage(usage).write.mode("append").parquet(path)
