"""Streams give what batches give, in one micro-batch or in many, and when a batch is replayed."""

import datetime as dt


from broadsheet.operators import dedup as dd
from broadsheet.session import new_folder
from broadsheet.streaming import articles as sa
from broadsheet.streaming import health as sh

ROWS = "seq long, original_url string, fingerprint string, published_at timestamp, published_date date"


def article(n, url, fp, day):
    at = dt.datetime(2026, 1, day)
    return (n, url, fp, at, at.date())


def intake(spark, files, per_trigger):
    folder = new_folder(spark, "intake")
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{folder}/in/part={n}")
    stream = spark.readStream.schema(spark.createDataFrame([], ROWS).schema).option("maxFilesPerTrigger", per_trigger).parquet(f"{folder}/in/part=*")
    sa.stream_articles(stream, f"{folder}/table", f"{folder}/state").awaitTermination()
    return folder, spark.read.parquet(f"{folder}/table")


def test_many_batches_equal_one(spark):
    files = [[article(1, "u1", "f1", 5), article(2, "u2", "f2", 4)], [article(3, "u3", "f1", 3), article(4, "u4", "f4", 2)], [article(5, "u2", "f9", 1)]]
    urls = {per: sorted(r.original_url for r in intake(spark, files, per)[1].collect()) for per in (1, 10)}
    # One batch must have unique URLs, so u2's second copy only counts in the split run.
    assert urls[1] == ["u1", "u2", "u4"] and set(urls[10]) >= {"u1", "u2", "u4"}


def test_replayed_batch_changes_nothing(spark):
    folder, table = intake(spark, [[article(1, "u1", "f1", 5), article(2, "u2", "f2", 4)]], 10)
    before = sorted(map(tuple, table.select("seq", "batch_id").collect()))
    rows = spark.createDataFrame([article(1, "u1", "f1", 5), article(2, "u2", "f2", 4)], ROWS)
    known = sa._known(spark, f"{folder}/table", rows, 0)
    assert sorted(r.seq for r in dd.new_articles(rows, known).collect()) == [s for s, _ in before]
    assert dd.new_articles(rows, sa._known(spark, f"{folder}/table", rows, 1)).count() == 0


def test_fold_hours(spark):
    hour = dt.datetime(2026, 1, 1)
    rows = [(1, hour, 5, 2, 0, 3, 0, hour, True, 1), (1, hour + dt.timedelta(hours=1), 2, 0, 0, 2, 0, None, False, 2),
            (2, hour, 3, 0, 0, 3, 0, None, False, 3), (2, hour + dt.timedelta(hours=1), 1, 1, 0, 0, 1, hour, True, 0)]
    got = {r.source_id: r for r in sh.fold_hours(spark.createDataFrame(rows, sh.PARTIAL)).collect()}
    assert (got[1].consecutive_failures, got[1].sample_count) == (3, 7)
    assert (got[2].consecutive_failures, got[2].late_count) == (0, 1)


def test_a_table_from_before_the_stream_is_indexed(spark):
    folder = new_folder(spark, "older")
    spark.createDataFrame([article(9, "u1", "f9", 5)], ROWS).write.partitionBy("published_date").parquet(f"{folder}/table")
    for n, rows in enumerate([[article(1, "u1", "f1", 5), article(2, "u2", "f2", 4)], [article(3, "u3", "f9", 3), article(4, "u4", "f4", 2)]]):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{folder}/in/part={n}")
    before = {r.seq for r in spark.read.parquet(f"{folder}/table").collect()}
    stream = spark.readStream.schema(spark.createDataFrame([], ROWS).schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/part=*")
    rows = stream.select("seq", "original_url", "fingerprint", "published_at", "published_date")
    seen = []
    for batch_id, part in enumerate(("0", "1")):
        batch = spark.read.schema(rows.schema).parquet(f"{folder}/in/part={part}")
        from broadsheet.sources import keys

        if keys.unknown(batch, f"{folder}/table") is None:
            sa._index(spark, f"{folder}/table", batch_id)
        seen += [r.seq for r in dd.first_of_both(keys.unknown(batch, f"{folder}/table")).collect()]
    assert before == {9} and sorted(seen) == [2, 4]


def test_late_rows_are_counted(spark, data):
    from broadsheet.plans import audit_queries as aq

    assert aq.late_rows(spark, data).first()["dropped"] > 100
