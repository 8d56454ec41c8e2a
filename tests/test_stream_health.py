"""Streamed health in shards of sources equals a plain fold of all events, over one micro-batch or several."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from broadsheet.session import new_folder
from broadsheet.streaming import health as sh

EVENTS = "source_id long, id long, checked_at timestamp, status string"
START = dt.datetime(2026, 1, 1)


def made(n: int):
    rng = random.Random(n)
    return [(rng.choice([1, 2, 3, (1 << 60) + 1, (1 << 60) + 2, None, *range(40, 90)]), k, START + dt.timedelta(seconds=k * 37),
             rng.choice(["ok", "empty", "error", "error", "timeout"])) for k in range(n)]


@pytest.mark.parametrize("pieces", [1, 3])
def test_shards_equal_a_plain_fold(spark, pieces):
    rows = made(600)
    folder = new_folder(spark, "health")
    for n in range(pieces):
        spark.createDataFrame(rows[n * 600 // pieces:(n + 1) * 600 // pieces], EVENTS).coalesce(1).write.parquet(f"{folder}/in/part={n}")
    spark.createDataFrame([(-1, -1, START + dt.timedelta(days=2), "ok")], EVENTS).coalesce(1).write.parquet(f"{folder}/in/part={pieces}")
    stream = spark.readStream.schema(spark.createDataFrame([], EVENTS).schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/part=*")
    sh.stream_health(stream).writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    partials = spark.read.schema(sh.PARTIAL).parquet(f"{folder}/out")
    hours = {}
    for source, n, at, status in rows:
        hours.setdefault((source, at.replace(minute=0, second=0)), []).append((at, n, status))
    want = {}
    for key, some in hours.items():
        good = [at for at, _, s in some if s == "ok"]
        fine = max(((at, n) for at, n, s in some if s not in sh.FAILING), default=None)
        want[key] = (len(some), len(good), sum(s == "empty" for *_, s in some), max(good, default=None), fine is not None,
                     sum(s in sh.FAILING and (fine is None or (at, n) > fine) for at, n, s in some))
    got = {(r.source_id, r.hour): (r.sample_count, r.success_count, r.empty_count, r.last_success_at, r.has_fine, r.tail_failures)
           for r in partials.collect()}
    assert got == want and partials.agg(F.sum("late_count")).first()[0] == 0


def test_many_sources_share_a_call():
    """One call for each source and hour cost more than its rows."""
    class State:
        exists, hasTimedOut, kept = False, False, None
        def getCurrentWatermarkMs(self): return 0
        def update(self, value): self.kept = value
        def setTimeoutTimestamp(self, at): self.at = at

    import pandas as pd

    state = State()
    rows = pd.DataFrame({"source": [1, 2, 1], "id": [1, 2, 3], "at": [5, 6, 7], "status": ["ok", "error", "error"]})
    assert list(sh._update((0, 0), iter([rows]), state)) == []
    assert state.kept[0] == [1, 2] and sorted(state.kept[len(sh.SOURCES)]) == [1, 2] and state.at == 3_600_000
