"""A replay over days against one-by-one runs, and a replay that is taken up again."""

import datetime as dt

from pyspark.sql import functions as F

from broadsheet.operators import selection as se
from broadsheet.plans import selection_queries as sq
from broadsheet.plans import views as v
from broadsheet.session import new_folder, stored

from tests.test_reasons import alike, one_edition


def plain_replay(pool_rows, published, days):
    """Picks by feed and day. `pool_rows` passed every gate but the history's; `published` is what was out before."""
    past = [dict(r) for r in published]
    out = {}
    for day in days:
        for feed in sorted({r["feed_id"] for r in pool_rows}):
            known = [p for p in past if p["feed_id"] == feed and p["report_date"] <= day]
            open_ = [r for r in pool_rows if (r["feed_id"], r["report_date"]) == (feed, day)]
            open_ = [r for r in open_ if not any(p["fingerprint"] == r["fingerprint"] or p["url_key"] == r["url_key"] or alike(r, p) for p in known)]
            decided = one_edition(open_)
            for r in open_:
                if decided[r["id"]][1]:
                    out[feed, str(day), r["id"]] = decided[r["id"]][1]
                    past.append({**r, "report_date": day})
    return out


def test_days_equal_a_plain_replay(spark, data):
    rows = stored(sq.features(spark, data), "features")
    history = v.history(spark, data)
    days = [dt.date(2024, 1, 9) + dt.timedelta(days=n) for n in range(4)]
    folder = new_folder(spark, "replay")
    got = {(r.feed_id, str(r.report_date), r.id): r.pick for r in se.replay_editions(rows, history, days, folder).collect()}
    free = se.candidate_pool(rows, v.editions(spark, data), history.filter("false"), events=False).filter("gate is null")
    pool = [r.asDict() for r in free.filter(F.col("report_date").isin(days)).collect()]
    published = [r.asDict() for r in se.keyed_history(history).collect()]
    assert got == plain_replay(pool, published, days) and len(got) > 20
    # Taken up again, days that were written stay as they are.
    stamp = spark.read.parquet(f"{folder}/days/day=2024-01-09").select("id", F.col("_metadata.file_modification_time").alias("t"))
    before = {(r.id, r.t) for r in stamp.collect()}
    more = se.replay_editions(rows, history, [*days, dt.date(2024, 1, 13)], folder)
    assert {(r.feed_id, str(r.report_date), r.id): r.pick for r in more.filter("report_date < '2024-01-13'").collect()} == got
    assert {(r.id, r.t) for r in stamp.collect()} == before
