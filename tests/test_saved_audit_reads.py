"""Saved audits are written with one shuffle, a file for each run, and read without sorting them."""

import pathlib
import re

from pyspark.sql import functions as F

from broadsheet.plans import audit_queries as aq
from broadsheet.plans import views as v


def test_states_are_read_without_a_sort_of_the_audits(spark, data):
    plan = aq.saved_audits(spark, data)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "hashpartitioning" in plan


def test_one_shuffle_writes_one_file_for_each_run(spark, data):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("saved-audits-written", "")
    try:
        folder = pathlib.Path(re.sub("^file:", "", aq._saved_audits(spark, data)))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for job in tracker.getJobIdsForGroup("saved-audits-written") for s in tracker.getJobInfo(job).stageIds}
    ran = [s for s in stages if (info := tracker.getStageInfo(s)) is not None and info.numCompletedTasks]
    runs = v.decisions(spark, data).select(F.floor(F.col("article_id") / 1000).alias("run")).distinct().count()
    files = [p for p in folder.rglob("part-*") if p.is_file()]
    assert len(files) == runs and len({p.parent.name for p in files}) == runs
    assert len(ran) <= 3  # the footer of the table, the shuffle and the writing
