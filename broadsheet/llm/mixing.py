"""Mixing sources to target weights by Efraimidis-Spirakis sampling; DataFrame operations only.

A document's key is -ln(u) / weight, with u a hash of its id in (0, 1]: taking the least keys draws without replacement
in proportion to the weights, and a rerun draws the same. A source's target first takes as many complete epochs as fit
into it; what is left is a budget that the documents of the source fill in the order of their keys.

The order within a source is never made in one task. Keys fall into BINS ranges whose order is that of the keys; sizes are
summed by (source, bin) before any shuffle, running sums over the bins place each bin, and only then are documents ordered
within their bin. To draw, ids and sizes are shuffled; `mix` moves the texts themselves once, to join them with the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.words import free_names

BINS = 4096
RATIO = (3, 1, 2)  # weights of the sources in their order, repeating
SHARE = 1.5  # of all words
MOST = 2.0  # times its source's words, that a target may reach
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def chance(id_col: str) -> Column:
    """A number in (0, 1] that depends on the id alone: the first 13 hex digits of its MD5."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 1) / F.lit(float(16 ** 13))


def targets(sizes: DataFrame, ratio: tuple[int, ...] = RATIO, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    Sources in code-point order, null last, weigh `ratio`, repeating, and divide `share` of all words. A target stops at
    `most` times its source's words; the excess goes to the others by weight until none is above. That is the level of a
    water fill: with sources ordered by the level at which they are full, the level is what the full ones leave divided by
    the weights of the others, at the first source that this level does not fill. The windows run over one row a source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weights = F.array(*(F.lit(float(r)) for r in ratio))
    up = Window.orderBy("full_at", "place").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy("full_at", "place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    filled = (sizes.withColumn("place", place).withColumn("weight", F.element_at(weights, (F.col("place") % len(ratio) + 1).cast("int")))
              .withColumn("most", F.col("source_size") * F.lit(most)).withColumn("full_at", F.col("most") / F.col("weight"))
              .withColumn("left", F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("most").over(up), F.lit(0.0)))
              .withColumn("level", F.col("left") / F.sum("weight").over(down))
              .withColumn("rising", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "place", "level"))).over(every)["level"]))
    return filled.select("source", "source_size", F.when(F.col("rising").isNull(), F.col("most"))
                         .otherwise(F.least("most", F.col("rising") * F.col("weight"))).alias("target"))


def drawn(docs: DataFrame, quality: DataFrame | None = None, ratio: tuple[int, ...] = RATIO, share: float = SHARE,
          most: float = MOST, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row for each document: its id, size, source, source_size and target (its source's), epochs (complete ones),
    extra (drawn once more), copies and taken (copies times size).

    `quality` gives weights (id, weight) for some documents; others weigh 1. Documents stay whole: the document at the end
    of a budget is drawn if more than half of it fits, so a source misses its target by at most half of one document.
    Null texts have size 0; null sources are one source; documents of one null or repeated id have one key, and ties are
    ordered by size and by a hash of the text. Sources without words have target 0 and take nothing.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"),
                        F.xxhash64(F.col(text_col)).alias("tie"))
    if quality is not None:
        known = quality.select(F.col(quality.columns[0]).alias("id"), F.col(quality.columns[1]).cast("double").alias("weight"))
        sized = sized.join(known.filter("id is not null and weight > 0").groupBy("id").agg(F.max("weight").alias("weight")), "id", "left")
    else:
        sized = sized.withColumn("weight", F.lit(1.0))
    key = -F.log(chance("id")) / F.coalesce("weight", F.lit(1.0))
    # exp(-key) is the rank among keys of weight 1; as a rising function of the key it keeps the order for any weights
    bins = F.least(F.floor((1 - F.exp(-F.col("key"))) * BINS), F.lit(BINS - 1)).cast("int")
    keyed = sized.withColumn("key", key).withColumn("bin", bins)
    totals = keyed.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    within = Window.partitionBy("source")
    placed = (totals.withColumn("before", F.sum("bin_size").over(within.orderBy("bin")) - F.col("bin_size")))
    aims = targets(totals.groupBy("source").agg(F.sum("bin_size").alias("source_size")), ratio, share, most)
    aims = aims.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    aims = aims.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    placed = placed.alias("p").join(aims.alias("a"), F.col("p.source").eqNullSafe(F.col("a.source"))).select(
        F.col("p.source").alias("source_"), F.col("bin").alias("bin_"), "before", "source_size", "target", "epochs", "budget")
    inside = Window.partitionBy("source", "bin").orderBy("key", "id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    extra = (F.col("size") > 0) & (F.col("seen") + F.col("size") / 2 < F.col("budget"))
    return (keyed.join(placed, F.col("source").eqNullSafe(F.col("source_")) & (F.col("bin") == F.col("bin_")))
            .withColumn("seen", seen).withColumn("extra", extra)
            .withColumn("copies", F.when(F.col("size") > 0, F.col("epochs") + F.col("extra").cast("long")).otherwise(F.lit(0).cast("long")))
            .select(F.col("id").alias(id_col), "size", F.col("source").alias(source_col), "source_size", "target", "epochs", "extra", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"), "tie"))


def mix(docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The mixed documents, with the columns of `docs`: each row as often as it is drawn. Rows are found again by id and by
    a hash of the text, so rows that agree in both are drawn alike."""
    key, hashed, copies, copy = free_names(docs, "id", "tie", "copies", "copy")
    plan = (drawn(docs, quality, id_col=id_col, text_col=text_col, **settings).groupBy(F.col(id_col).alias(key), F.col("tie").alias(hashed))
            .agg(F.max("copies").alias(copies)).filter(F.col(copies) > 0))
    same = F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.col(text_col)) == F.col(hashed))
    return (docs.join(plan, same).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
            .select(*(docs[c] for c in docs.columns)))
