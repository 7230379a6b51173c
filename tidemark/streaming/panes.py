"""Early / on-time / late panes, accumulating or discarding.

Spark has no trigger with early and late firings, so this is a stateful operator:
``applyInPandasWithState`` grouped by (key, window_start, window_end) with an
event-time timeout. State per window = (total, since_last, pane_index, fired).

Clock: Spark's watermark already has the allowed lateness subtracted, so the
window's on-time point (input watermark passes the window end) is
``spark_watermark >= end - lateness``, and the window expires (late data dropped)
when ``spark_watermark >= end``. On every call, in this order:

  (i)   state exists, not fired, on-time point reached -> emit ON_TIME;
  (ii)  window expired -> incoming rows go to the late side output, a ``closed``
        row records the last pane index (pane info "last") and total, state removed;
  (iii) otherwise count rows one by one: after ON_TIME every row emits a LATE pane,
        before it every ``early_n``-th row emits an EARLY pane; save state and set
        the timeout to max(end if fired else end - lateness, watermark + 1).

Rows must be judged late by these rules, not filtered before the function, so the
grouped rows carry the watermark marker (required for an event-time timeout) on a
guard column that is never behind the watermark, while the global watermark keeps
advancing from the real event time upstream.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

OUTPUT_SCHEMA = ("key string, window_start timestamp, window_end timestamp, kind string, timing string, "
                 "pane_index int, is_first boolean, value long, event_time timestamp")
STATE_SCHEMA = "total long, since_last long, pane_index int, fired boolean"
# column metadata key Spark uses to mark an event-time column with its watermark delay
WATERMARK_KEY = "spark.watermarkDelayMs"
FAR_FUTURE = "2262-01-01 00:00:00"   # inside the pandas nanosecond range


def _pane_fn(size_ms: int, lateness_ms: int, early_n: int, accumulating: bool):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        k, w_start, w_end = key
        end_ms = int(pd.Timestamp(w_end).value // 1_000_000)
        wm = state.getCurrentWatermarkMs()
        if state.exists:
            total, since, pane, fired = state.get
        else:
            total, since, pane, fired = 0, 0, 0, False
        rows = [p for p in pdfs]
        batch = pd.concat(rows) if rows else pd.DataFrame({"event_time": []})
        out = []

        def emit(timing, value, et=None):
            out.append((k, w_start, w_end, "pane", timing, pane, pane == 0, int(value), et))

        # (i) on-time firing
        if state.exists and not fired and wm >= end_ms - lateness_ms:
            emit("ON_TIME", total if accumulating else since)
            pane, since, fired = pane + 1, 0, True
        # (ii) expired window: late side output; a "closed" row names the last pane
        #      (T10 is_last: pane_index of that row), carrying the final total
        if wm >= end_ms:
            for et in batch["event_time"]:
                out.append((k, w_start, w_end, "late", "DROPPED", None, False, 1, et))
            if state.exists:
                out.append((k, w_start, w_end, "closed", "CLOSED", pane - 1, False, int(total), None))
                state.remove()
        else:
            # (iii) count one by one
            for _ in range(len(batch)):
                total, since = total + 1, since + 1
                if fired:
                    emit("LATE", total if accumulating else since)
                    pane, since = pane + 1, 0
                elif since >= early_n:
                    emit("EARLY", total if accumulating else since)
                    pane, since = pane + 1, 0
            state.update((total, since, pane, fired))
            state.setTimeoutTimestamp(max(end_ms if fired else end_ms - lateness_ms, wm + 1))
        if out:
            yield pd.DataFrame(out, columns=["key", "window_start", "window_end", "kind", "timing", "pane_index",
                                             "is_first", "value", "event_time"])
    return fn


def paned_counts(stream: DataFrame, key: str, ts: str, size_seconds: int, early_n: int, lateness_seconds: int,
                 accumulating: bool = True) -> DataFrame:
    """T8-T10 (+T12 late side output): panes per (key, fixed window)."""
    s = stream.withColumn("_et", F.col(ts).cast("timestamp")).withWatermark("_et", "%d seconds" % lateness_seconds)
    secs = F.unix_seconds("_et")
    start = F.timestamp_seconds(secs - F.pmod(secs, F.lit(size_seconds)))
    g = s.select(F.col(key).cast("string").alias("key"), start.alias("window_start"),
                 F.timestamp_add("SECOND", F.lit(size_seconds), start).alias("window_end"),
                 (F.col("_et") + F.expr("INTERVAL 0 SECONDS")).alias("event_time"),
                 F.lit(FAR_FUTURE).cast("timestamp").alias("_wm_guard", metadata={WATERMARK_KEY: lateness_seconds * 1000}))
    return g.groupBy("key", "window_start", "window_end").applyInPandasWithState(
        _pane_fn(size_seconds * 1000, lateness_seconds * 1000, early_n, accumulating),
        OUTPUT_SCHEMA, STATE_SCHEMA, "append", "EventTimeTimeout")
