"""Streaming article intake and drop counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.operators.dedup import colliding, first_of_both, new_articles
from broadsheet.session import stored
from broadsheet.sources import keys


def stream_articles(stream: DataFrame, path: str, checkpoint: str, seq: str = "seq", **trigger) -> StreamingQuery:
    """Append unknown articles of every micro-batch; duplicates are looked up in the table's key index, not in state, and only
    in the buckets that the batch's keys fall into.

    Each micro-batch owns its partitions of table and index and ignores them when it looks for known rows, so a replayed
    batch finds the same rows again and overwrites exactly what it wrote before. A table without an index is indexed by the
    first micro-batch that meets it.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        try:
            unknown = keys.unknown(rows, path, without=batch_id + FIRST_PART)
            if unknown is None:
                fresh = new_articles(rows, _known(spark, path, rows, batch_id), seq)
            else:
                fresh = first_of_both(unknown, seq)
            fresh = stored(fresh.withColumn("batch_id", F.lit(batch_id)), "fresh")
            fresh.hint("rebalance", F.col("published_date")).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("batch_id", "published_date").parquet(path)
            if unknown is None:
                _index(spark, path, batch_id)
            keys.write_keys(fresh, path, batch_id + FIRST_PART)
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


FIRST_PART = 1  # of the index, which holds what was in the table before the stream under 0


def _index(spark, path: str, batch_id: int) -> None:
    """Index what was in the table before the stream met it."""
    keys.write_keys(_before(spark.read.parquet(path), batch_id), path, 0)


def _before(table: DataFrame, batch_id: int) -> DataFrame:
    """What a table holds without a micro-batch's own rows; rows from before the stream have no number."""
    return table.filter(~F.col("batch_id").eqNullSafe(batch_id)) if "batch_id" in table.columns else table


def _known(spark, path: str, batch: DataFrame, batch_id: int) -> DataFrame:
    """Stored keys the batch could collide with, leaving out what this very batch wrote before."""
    from pyspark.errors import AnalysisException

    try:
        table = spark.read.parquet(path)
    except AnalysisException:  # first batch: no table yet
        return batch.select("original_url", "fingerprint").limit(0)
    return colliding(_before(table, batch_id), batch)


def stream_drop_reasons(decisions: DataFrame, delay: str = "1 day") -> DataFrame:
    """Dropped decisions per day, stage and reason; a day is final once the watermark has passed it."""
    dropped = decisions.filter(F.col("status") == "dropped").withWatermark("ts", delay)
    return dropped.groupBy(F.window("ts", "1 day"), "stage", "reason").agg(F.count("*").alias("drops")).select(
        F.to_date("window.start").alias("day"), "stage", "reason", "drops")
