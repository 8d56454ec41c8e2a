"""The training-data pipeline: raw documents to token files, as five stages.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a DataFrame, which is written as
Parquet and read again as the next one's documents. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import decontaminate, mixing, near_copies, quality_rules, registered, token_files
from broadsheet.session import new_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the calibrated regression keep; the regression learns from the labelled ones among
    `docs`."""
    model = quality_rules.train(docs, registered.table(spark, sf_dir, "labels"))
    return quality_rules.kept(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: five-word shingles alike in 0.8 or more."""
    return near_copies.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, registered.table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them."""
    return mixing.mix(docs, registered.quality_weights(spark, sf_dir))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what is read back from them: doc_id, start, n_tokens, ids_crc32."""
    folder = new_folder(spark, "token-files")
    token_files.write(docs, folder, registered.vocabulary())
    return token_files.read(spark, folder, with_ids=False)


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("decontamination", decontamination),
          ("source mixing", mixture), ("token files", tokens)]

ORACLE_SQL = None  # the regression, the fingerprints and the vocabulary have no SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole table `documents`."""
    docs = registered.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)


registered.query("pipeline")(run)
