"""A key index beside an article table: digests of URLs and fingerprints in buckets.

An append looks up the keys of its batch in the buckets they fall into and reads no other part of the index, and nothing of
the table itself. A bucket is a folder; a digest is 16 bytes, whatever the length of its key. Parts written by one append (or one
micro-batch) carry its number, so a repeated micro-batch ignores and then overwrites what it wrote before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256


def index_path(table: str) -> str:
    return table.rstrip("/") + "-keys"


def digests(rows: DataFrame, url: str = "original_url", key: str = "fingerprint") -> DataFrame:
    """(kind, digest, bucket) of every key that is not null, once each."""
    kinds = F.explode(F.array(F.struct(F.lit("url").alias("kind"), F.col(url).alias("value")), F.struct(F.lit("print").alias("kind"), F.col(key).alias("value"))))
    keyed = rows.select(kinds.alias("k")).select("k.kind", "k.value").filter(F.col("value").isNotNull())
    digest = F.unhex(F.md5(F.concat_ws(":", "kind", F.col("value").cast("string"))))
    return keyed.select("kind", digest.alias("digest")).distinct().withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(BUCKETS)).cast("int"))


def write_keys(rows: DataFrame, table: str, part: int) -> None:
    """Add the keys of newly written articles; one file a bucket. A part written before under the same number is replaced."""
    (digests(rows).withColumn("part", F.lit(part).cast("long")).repartition("bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "part").parquet(index_path(table)))


def read_keys(spark: SparkSession, table: str, buckets: list[int], without: int | None = None) -> DataFrame | None:
    """The keys in the given buckets (None if there is no index), leaving out one part."""
    try:
        index = spark.read.schema("kind string, digest binary, bucket int, part long").parquet(index_path(table))
    except AnalysisException:
        return None
    index = index.filter(F.col("bucket").isin(buckets))
    return index if without is None else index.filter(F.col("part") != without)


def next_part(spark: SparkSession, table: str) -> int:
    """A number that no part of the index has yet; only folder names are read."""
    try:
        index = spark.read.schema("kind string, digest binary, bucket int, part long").parquet(index_path(table))
    except AnalysisException:
        return 0
    return (index.agg(F.max("part")).first()[0] or 0) + 1


def unknown(batch: DataFrame, table: str, without: int | None = None, url: str = "original_url", key: str = "fingerprint") -> DataFrame | None:
    """The rows of the batch whose keys the index does not hold; None if there is no index. At most BUCKETS numbers come to
    the driver."""
    spark = batch.sparkSession
    buckets = [r.bucket for r in digests(batch, url, key).select("bucket").distinct().collect()]
    index = read_keys(spark, table, buckets, without)
    if index is None:
        return None
    known = index.select("kind", "digest").distinct()
    out = batch
    for kind, name in (("url", url), ("print", key)):
        mine = F.unhex(F.md5(F.concat_ws(":", F.lit(kind), F.col(name).cast("string"))))
        held = known.filter(F.col("kind") == kind).select(F.col("digest").alias("_digest"))
        out = out.withColumn("_mine", F.when(F.col(name).isNotNull(), mine)).join(held, F.col("_mine") == F.col("_digest"), "left_anti").drop("_mine")
    return out


def rebuild_keys(spark: SparkSession, table: str) -> None:
    """Index a table that was written without one."""
    rows = spark.read.parquet(table).select("original_url", "fingerprint")
    (digests(rows).withColumn("part", F.lit(0).cast("long")).repartition("bucket").write.mode("overwrite").partitionBy("bucket", "part")
     .parquet(index_path(table)))


def compact_keys(spark: SparkSession, table: str) -> str:
    """Write the index with all parts merged into part 0, one file a bucket, to a new folder, and return it. Files of many small
    appends are so few again; the caller swaps the folders while nothing writes."""
    target = index_path(table) + "-compact"
    index = spark.read.schema("kind string, digest binary, bucket int, part long").parquet(index_path(table))
    (index.select("kind", "digest", "bucket").distinct().withColumn("part", F.lit(0).cast("long")).repartition("bucket")
     .write.mode("overwrite").partitionBy("bucket", "part").parquet(target))
    return target
