"""Selection computes its rows once, however often it reads them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.operators import selection as se
from broadsheet.plans import views as v

NOW = dt.datetime(2024, 1, 20)


def counted(spark):
    """A column function that counts the rows it is computed for."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf(T.StringType())
    def same(value):
        calls.add(1)
        return value

    return calls, same


def test_pool_with_events_computes_features_once(spark, data):
    calls, same = counted(spark)
    rows = se.candidate_features(v.articles(spark, data), v.DEEP, v.IMPACT)
    rows = rows.withColumn("title_key", F.coalesce(same("title_key"), F.lit("")))
    pool = se.candidate_pool(rows, v.editions(spark, data), v.history(spark, data))
    assert pool.groupBy("gate").agg(F.max("title_key")).count() > 1
    assert calls.value == rows.count()


@pytest.mark.parametrize("layered, column", [(False, "title_key"), (True, "layer")])
def test_selection_computes_its_pool_once(spark, layered, column):
    calls, same = counted(spark)
    data = [(0, NOW.date(), f"{n:03d}", f"s{n}", "science", 1, NOW - dt.timedelta(hours=n), f"f{n}", f"u{n}", chr(0x4E00 + 7 * n) * 8, [], 70,
             float(70 - n), 1, "today" if n % 2 else None) for n in range(40)]
    rows = spark.createDataFrame(data, "feed_id int, report_date date, id string, source string, category string, source_tier int, published_at timestamp, "
                                       "fingerprint string, url_key string, title_key string, versions array<string>, importance int, score double, level int, layer string")
    rows = rows.withColumn(column, same(column))
    if layered:
        rows = rows.select("*", *[F.col(a).alias(f"{b}_{x}") for x in ("cn", "en") for a, b in (("title_key", "key"), ("versions", "versions"))])
    out = (se.select_layered if layered else se.select_edition)(rows)
    assert out.count() == 40
    assert out.filter("reason = 'outside_eligible_supply_layers'").count() == 20 * layered
    assert calls.value == 40
