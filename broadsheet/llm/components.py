"""Connected components by alternating large-star and small-star joins.

Links and labels stay in tables; each round is a few equi joins whose hot nodes adaptive execution splits, and is written
to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.session import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to the least node it knows (links run from the larger node to the smaller)."""
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy(F.col("high").alias("node")).agg(F.min(F.least("high", "low")).alias("root"))
    return (links.join(least, F.col("low") == F.col("node"))
            .select("high", F.col("root").alias("low")).filter("high <> low"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
    moved = (links.join(least, F.col("high") == F.col("node")).filter("low <> root")
             .select(F.col("low").alias("high"), F.col("root").alias("low")))
    return least.select(F.col("node").alias("high"), F.col("root").alias("low")).unionByName(moved).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (two long columns); the root is the component's least node and is itself
    left out where it is the node. Null ends and links of a node to itself are ignored."""
    a, b = (F.col(c) for c in links.columns[:2])
    links = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).filter(a.isNotNull() & b.isNotNull() & (a != b))
    links = stored(links.distinct(), "links")
    state = _state(links)
    while state[0]:
        links = stored(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("high").alias("node"), F.col("low").alias("root"))
