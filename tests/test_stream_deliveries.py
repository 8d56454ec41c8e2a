"""Work of a delivery or a day that does not pass through one task, or not through the joins at all."""

import datetime as dt

from broadsheet import session
from broadsheet.operators import selection as se


def test_a_delivery_is_written_by_several_tasks(spark, data, monkeypatch):
    """All of a delivery was one file, and so one task's."""
    from broadsheet.plans import audit_queries as aq

    named, real = [], session.new_folder
    monkeypatch.setattr(session, "new_folder", lambda s, name: named.append((name, real(s, name))) or named[-1][1])
    got = aq.stream_articles(spark, data)
    assert {(r.batch_id, r.doc_id % 3) for r in got.collect()} == {(n, n) for n in range(3)}
    folder = dict(named)["articles-stream"]
    for part in range(3):
        assert len(spark.read.parquet(f"{folder}/in/part={part}").inputFiles()) > 1


def test_a_day_joins_only_its_window(spark, data, monkeypatch):
    """Every day joined the articles of all days with the history."""
    from broadsheet.plans import selection_queries as sq
    from broadsheet.plans import views as v

    seen, real = [], se.candidate_pool
    monkeypatch.setattr(se, "candidate_pool", lambda features, *a, **k: seen.append(features) or real(features, *a, **k))
    rows = session.stored(sq.features(spark, data), "features")
    se.replay_editions(rows, v.history(spark, data), [dt.date(2024, 1, 12)], session.new_folder(spark, "replay"), events=False)
    days = {r.published_date for r in seen[0].select("published_date").distinct().collect()}
    assert dt.date(2024, 1, 5) in days and dt.date(2024, 1, 12) in days and not days & {dt.date(2024, 1, 2), dt.date(2024, 1, 14)}
    assert len(days) < rows.select("published_date").distinct().count()
