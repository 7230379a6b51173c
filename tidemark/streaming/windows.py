"""Event-time windows, the same functions for batch and streaming
DataFrames, plus a bounded runner for streaming queries.

Spark's streaming watermark needs TIMESTAMP (not TIMESTAMP_NTZ), so event time is
cast on entry and window bounds are cast back to NTZ on exit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir
from tidemark.sources import files


def with_event_time(df: DataFrame, col: str, out: str = "event_time", lateness: str | None = None) -> DataFrame:
    """T1 (+T7): attach event time (TIMESTAMP) and, for streams, a watermark."""
    c = F.col(col)
    dtype = df.schema[col].dataType.typeName()
    et = F.timestamp_seconds(c) if dtype in ("long", "integer", "double") else c.cast("timestamp")
    out_df = df.withColumn(out, et)
    return out_df.withWatermark(out, lateness) if lateness else out_df


def _bounds(w: str = "window") -> list[Column]:
    return [F.col(w + ".start").cast("timestamp_ntz").alias("window_start"),
            F.col(w + ".end").cast("timestamp_ntz").alias("window_end")]


def per_key(df: DataFrame, keys: list[str], value: str | None = None) -> DataFrame:
    """The global window - one result per key over everything."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(F.col(value).cast("decimal(18,2)")).cast("double").alias("total"))
    return df.groupBy(*keys).agg(*aggs)


def tumbling(df: DataFrame, ts: str, size: str, keys: list[str]) -> DataFrame:
    """Fixed windows with (start, end) labels."""
    g = df.groupBy(F.window(F.col(ts), size).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*_bounds(), *keys, "n")


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys: list[str]) -> DataFrame:
    """T4: overlapping windows (each event counted in size/slide windows)."""
    g = df.groupBy(F.window(F.col(ts), size, slide).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*_bounds(), *keys, "n")


def session(df: DataFrame, ts: str, gap: str, keys: list[str], bucket_seconds: int = 86400) -> DataFrame:
    """T5: per-key sessions closed after ``gap`` of silence; end = last event + gap.

    Skew-safe in two phases, so one key holding a third of all events is never
    sorted in a single task:
      1. sessionize inside (key, time bucket) with lag + running sum - the
         event-heavy phase is spread over every bucket of a hot key;
      2. one more window over the local sessions, partitioned by (key, slot) where
         slot = the bucket for interior sessions (they are final: the lag rule never
         merges two sessions of one bucket) and -1 for sessions touching a bucket
         edge (at most two per key and bucket), which are stitched per key: a
         session starting before the previous one's end joins it - the rule
         ``session_window`` applies to events.
    One lineage, two exchanges; the result equals ``session_window`` per key."""
    gap_s = interval_seconds(gap)
    gap_iv = F.expr("INTERVAL %d SECONDS" % gap_s)
    sec = F.unix_seconds(F.col(ts).cast("timestamp"))
    wb = Window.partitionBy(*keys, "_bucket").orderBy(F.col(ts))
    local = (df.filter(F.col(ts).isNotNull()).select(*keys, F.col(ts), F.floor(sec / bucket_seconds).alias("_bucket"))
             .withColumn("_new", F.when(F.col(ts) < F.lag(ts).over(wb) + gap_iv, 0).otherwise(1))
             .withColumn("_sid", F.sum("_new").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy(*keys, "_bucket", "_sid")
             .agg(F.min(ts).alias("s"), (F.max(ts) + gap_iv).alias("e"), F.count(F.lit(1)).alias("n")))
    b_start = F.col("_bucket") * bucket_seconds
    edge = ((F.unix_seconds(F.col("s").cast("timestamp")) < b_start + gap_s)
            | (F.unix_seconds(F.col("e").cast("timestamp")) > b_start + bucket_seconds))
    w2 = Window.partitionBy(*keys, "_slot").orderBy("s", "e")
    merged = (local.withColumn("_slot", F.when(edge, F.lit(-1).cast("bigint")).otherwise(F.col("_bucket")))
              .withColumn("_new", F.when(F.col("s") < F.lag("e").over(w2), 0).otherwise(1))
              .withColumn("_grp", F.sum("_new").over(w2.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*keys, "_slot", "_grp")
              .agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("n")))
    return merged.select(F.col("s").cast("timestamp_ntz").alias("window_start"),
                         F.col("e").cast("timestamp_ntz").alias("window_end"), *keys,
                         F.col("n").cast("bigint").alias("n"))


def interval_seconds(text: str) -> int:
    num, unit = text.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(num) * mult


def run_available(spark: SparkSession, stream: DataFrame, name: str, output_mode: str = "append",
                  fmt: str = "parquet", foreach_batch=None, root: str | None = None, more=None) -> str:
    """Run a streaming query over what is available now and stop by itself.

    Sink and checkpoint live under the shared checkpoint root, so a restarted job
    resumes from its last committed micro-batch (executors may be lost any time). ``root``
    is the result of an earlier call, to go on from where that one ended; ``more`` lands further input
    once this one is processed, and says whether there was any (``deliver``)."""
    root = root or scratch_dir(spark, "stream-" + name)
    w = stream.writeStream.option("checkpointLocation", root + "/_checkpoint").outputMode(output_mode)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", root + "/out")
    while True:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        if more is None or not more():
            return root


def deliver(spark: SparkSession, rows: DataFrame, step: str, name: str):
    """A table as a stream that comes in steps: (stream, ``more`` for ``run_available``).

    Rows are written once, in parallel, to a folder per value of the integer column ``step``; a step's folder is
    moved in front of the stream when the one before it is processed, so a step is one micro-batch of any number
    of files."""
    root = scratch_dir(spark, name)
    rows.write.partitionBy(step).parquet(root + "/all")
    left = sorted(files.list_partition_values(spark, root + "/all", step), key=int)
    files.make_dir(spark, root + "/in")

    def more() -> bool:
        if not left:
            return False
        value = left.pop(0)
        files.move(spark, "%s/all/%s=%s" % (root, step, value), "%s/in/%s_%s" % (root, step, value))
        return True

    more()
    return spark.readStream.schema(rows.drop(step).schema).parquet(root + "/in/*"), more


# Event time of the row that ends a bounded stream: later than any window to be closed.
END_OF_STREAM = "9999-12-01 00:00:00"


def run_to_end(spark: SparkSession, stream: DataFrame, build, ts: str, name: str) -> str:
    """T18 for a bounded input: run ``build(stream)`` over what is available, then close every
    window that is still open.

    Append mode emits a window once the watermark passes it, so the last windows of a
    bounded stream would stay in state. A second source, empty at first, is joined to
    the stream; when all input is processed one row with nothing but an event time at
    the end of time lands there and the query goes on from its checkpoint: the watermark
    passes every real window, the row's own window is never emitted. The row comes last
    whatever the size of the micro-batches, so it makes no input late. ``build`` must not
    filter the row before its watermark; an empty input gives an empty sink."""
    end = scratch_dir(spark, "end-" + name) + "/rows"
    files.make_dir(spark, end)
    query = build(stream.unionByName(spark.readStream.schema(stream.schema).parquet(end)))
    root = run_available(spark, query, name)
    at = F.lit(END_OF_STREAM).cast("timestamp")
    last = [(at if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in stream.schema]
    spark.range(1).select(*last).write.mode("append").parquet(end)
    return run_available(spark, query, name, root=root)


def windowed_counts(stream: DataFrame, ts: str, size: str, keys: list[str], lateness: str) -> DataFrame:
    """Watermarked tumbling counts; in append mode a window is emitted once the
    watermark (max event time - lateness) passes its end, and later rows for it drop."""
    s = with_event_time(stream, ts, "event_time", lateness)
    g = s.groupBy(F.window("event_time", size).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*_bounds(), *keys, "n")


def session_counts(stream: DataFrame, ts: str, gap: str, keys: list[str], lateness: str) -> DataFrame:
    """Streaming sessions over late data (session window + watermark)."""
    s = with_event_time(stream, ts, "event_time", lateness)
    g = s.groupBy(F.session_window("event_time", gap).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*_bounds(), *keys, "n")


def threshold_alerts_stream(stream: DataFrame, ts: str, value: str, threshold: float, window: str = "5 minutes",
                            lateness: str = "5 minutes") -> DataFrame:
    """Q20 on a stream: events above ``threshold`` counted per window with a watermark;
    a window is emitted (append mode) once complete, and only when its count > 0."""
    # the watermark must follow every event (the clock), so the threshold is a
    # conditional count inside the window aggregate, not a filter that Catalyst would
    # push below the watermark
    s = with_event_time(stream, ts, "event_time", lateness)
    g = s.groupBy(F.window("event_time", window).alias("window")).agg(
        F.count_if(F.col(value) > threshold).alias("events"))
    return g.filter(F.col("events") > 0).select(*_bounds(), "events", F.lit(True).alias("alert"))
