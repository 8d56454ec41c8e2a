"""Streaming source health.

State is kept per hour and shard of the sources, so that a call folds the rows of many sources at once: most sources have few
checks an hour, and one call for each would cost more than its rows. It holds only what the hour can still contribute, for each
source: counters, the last good check, and the failures after it. Closed hours leave as partial rows, one per source and hour;
`fold_hours` turns partials into the current figures.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from broadsheet.operators.health import FAILING

PARTIAL = ("source_id long, hour timestamp, sample_count long, success_count long, empty_count long, failure_count long, "
           "late_count long, last_success_at timestamp, has_fine boolean, tail_failures long")
COLUMNS = [part.split()[0] for part in PARTIAL.split(", ")]
SHARDS = 8  # of the sources; those without a name have their own
NEVER = np.iinfo(np.int64).min
COUNTS = ["ok", "empty", "bad", "late"]
SOURCES, TAIL = ["source", *COUNTS, "success", "fine_at", "fine_id"], ["source", "at", "id"]
STATE = ", ".join([*(f"{c} array<long>" for c in SOURCES), *(f"tail_{c} array<long>" for c in TAIL)])
LEAVING = PARTIAL.replace("timestamp", "long")  # instants in microseconds


def _folded(sources: pd.DataFrame, tail: pd.DataFrame, pdf: pd.DataFrame, horizon: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The sources' figures and their failures after the last good check, with some more rows."""
    stale, failing = pdf["at"] < horizon, pdf["status"].isin(FAILING)
    good, rest = pdf["status"] == "ok", ~stale & ~failing
    new = pd.DataFrame({"source": pdf["source"], "ok": ~stale & good, "empty": ~stale & (pdf["status"] == "empty"), "bad": ~stale & failing,
                        "late": stale, "success": pdf["at"].where(~stale & good, NEVER), "fine_at": pdf["at"].where(rest, NEVER),
                        "fine_id": pdf["id"].where(rest, NEVER)}).astype("int64")
    rows = pd.concat([sources, new], ignore_index=True).sort_values(["source", "fine_at", "fine_id"], kind="stable")
    sources = rows.groupby("source", as_index=False).agg(
        {**dict.fromkeys(COUNTS, "sum"), "success": "max", "fine_at": "last", "fine_id": "last"})
    tail = pd.concat([tail, pdf.loc[~stale & failing, TAIL]], ignore_index=True)
    fine = tail[["source"]].merge(sources, on="source", how="left")
    after = (tail["at"] > fine["fine_at"]) | ((tail["at"] == fine["fine_at"]) & (tail["id"] > fine["fine_id"]))
    return sources, tail[after]


def _close(key, state) -> pd.DataFrame:
    held = [np.array(c, np.int64) for c in state.get]
    state.remove()
    source, ok, empty, bad, late, success, fine_at, _ = held[:len(SOURCES)]
    tails = pd.Series(held[len(SOURCES)]).value_counts().reindex(source, fill_value=0)
    out = pd.DataFrame(dict(zip(COLUMNS, (source, key[1], ok + empty + bad, ok, empty, bad, late, success, fine_at != NEVER, tails.to_numpy()))))
    out["last_success_at"] = out["last_success_at"].astype("Int64").mask(success == NEVER)
    return out.assign(source_id=pd.array([None] * len(out), "Int64")) if key[0] < 0 else out


def _update(key, batches, state):
    if state.hasTimedOut:
        yield _close(key, state)
        return
    held = [np.array(c, np.int64) for c in state.get] if state.exists else [np.zeros(0, np.int64)] * (len(SOURCES) + len(TAIL))
    sources, tail = pd.DataFrame(dict(zip(SOURCES, held))), pd.DataFrame(dict(zip(TAIL, held[len(SOURCES):])))
    for pdf in batches:
        sources, tail = _folded(sources, tail, pdf, state.getCurrentWatermarkMs() * 1000)
    state.update(tuple(frame[c].tolist() for frame, names in ((sources, SOURCES), (tail, TAIL)) for c in names))
    state.setTimeoutTimestamp(max(int(key[1]) // 1000 + 3_600_000, state.getCurrentWatermarkMs() + 1))
    yield from ()


def stream_health(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One partial row per source and closed hour. Events behind the watermark are counted, not folded."""
    rows = events.select("source_id", "id", "checked_at", "status").withWatermark("checked_at", delay)
    shard = F.when(F.col("source_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("source_id"), F.lit(SHARDS))).cast("int")
    keyed = rows.select(shard.alias("shard"), F.unix_micros(F.date_trunc("hour", "checked_at")).alias("hour"), "checked_at",
                        F.coalesce("source_id", F.lit(0)).alias("source"), F.coalesce("id", F.lit(NEVER)).alias("id"),
                        F.unix_micros("checked_at").alias("at"), "status")
    out = keyed.groupBy("shard", "hour").applyInPandasWithState(_update, LEAVING, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumns({c: F.timestamp_micros(c) for c in ("hour", "last_success_at")})


def fold_hours(partials: DataFrame) -> DataFrame:
    """Current counters, last success and failure streak per source from the hourly partials."""
    later = Window.partitionBy("source_id").orderBy(F.desc("hour")).rowsBetween(Window.unboundedPreceding, -1)
    # An hour counts toward the streak until a later hour holds a good check.
    open_ = ~F.coalesce(F.bool_or("has_fine").over(later), F.lit(False))
    out = partials.withColumn("_tail", F.when(open_, F.col("tail_failures")).otherwise(0))
    return out.groupBy("source_id").agg(
        *[F.sum(c).alias(c) for c in ("sample_count", "success_count", "empty_count", "failure_count", "late_count")],
        F.max("last_success_at").alias("last_success_at"), F.sum("_tail").alias("consecutive_failures"))
