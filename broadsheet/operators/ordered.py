"""Running values over ordered groups whose size nobody bounds.

A plain window would sort a whole group in one task. These helpers split every
group into value-ordered chunks (an hour of a stream, a block of positions),
carry chunk totals forward, and finish inside the chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_before(df: DataFrame, keys: list[str], chunk: Column, order: list, values: dict[str, tuple[Column, str]],
                   ) -> DataFrame:
    """Add `{name: (value, how)}` accumulated over the strictly earlier rows of the group.

    `how` is sum, max or min; `chunk` must grow with `order`. Sums start at 0, extremes at NULL.
    """
    fold = {"sum": F.sum, "max": F.max, "min": F.min}
    df = df.withColumn("_chunk", chunk)
    totals = df.groupBy(*keys, "_chunk").agg(*[fold[how](value).alias(f"_t_{name}") for name, (value, how) in values.items()])
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_chunk", *[
        fold[how](f"_t_{name}").over(earlier).alias(f"_c_{name}") for name, (_, how) in values.items()])
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(carried, [*keys, "_chunk"])
    combine = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest, "min": F.least}
    out = joined.select("*", *[
        combine[how](F.col(f"_c_{name}"), fold[how](value).over(inside)).alias(name)
        for name, (value, how) in values.items()])
    return out.drop("_chunk", *[f"_c_{name}" for name in values])


def numbered(df: DataFrame, keys: list[str], chunk: Column, order: list, name: str = "position") -> DataFrame:
    """Dense 1-based position of each row in its group."""
    out = running_before(df, keys, chunk, order, {"_before": (F.lit(1), "sum")})
    return out.withColumn(name, (F.col("_before") + 1).cast("bigint")).drop("_before")


def in_batches(df: DataFrame, keys: list[str], chunk: Column, order: list, size: int) -> DataFrame:
    """Fixed-size batches by rank: adds `position` and `batch`."""
    out = numbered(df, keys, chunk, order)
    return out.withColumn("batch", F.floor((F.col("position") - 1) / size).cast("bigint"))


def nearest_rank(df: DataFrame, key: str, value: str, share: float, minimum: int, bucket: Column) -> DataFrame:
    """Exact nearest-rank quantile per key: NULL below `minimum` samples.

    Works on value counts, so repeated values collapse before the shuffle; `bucket` is a coarse
    value range (a millisecond, say) and only the bucket holding the rank is opened.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, bucket.alias("_bucket"), F.col(value)).agg(
        F.count("*").alias("_n"))
    sizes = counts.groupBy(key, "_bucket").agg(F.sum("_n").alias("_bn"))
    upto = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(key)
    sizes = sizes.select(key, "_bucket", "_bn", F.coalesce(F.sum("_bn").over(upto), F.lit(0)).alias("_before"),
                         F.sum("_bn").over(every).alias("_total"))
    rank = F.ceil(F.lit(share) * F.col("_total"))
    target = sizes.filter((F.col("_total") >= minimum) & (F.col("_before") < rank) & (rank <= F.col("_before") + F.col("_bn")))
    opened = counts.join(target.select(key, "_bucket", "_before", rank.alias("_rank")), [key, "_bucket"])
    inside = Window.partitionBy(key, "_bucket").orderBy(value)
    seen = F.col("_before") + F.sum("_n").over(inside)
    return opened.select(key, value, (seen >= F.col("_rank")).alias("_hit")).filter("_hit").groupBy(key).agg(
        F.min(value).alias(value))
