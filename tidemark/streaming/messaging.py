"""Dead-letter parsing, per-key ordering, retry-to-DLQ, replay,
landing and duplicate suppression - batch and streaming alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.sources import files


def _is_int_text(c: Column) -> Column:
    return c.rlike(r"^-?[0-9]+$")


def parse_or_dead_letter(lines: DataFrame, schema: dict[str, str], line_col: str = "value",
                         preview_chars: int | None = None):
    """JSON lines -> (good typed rows, dead letters with a reason): both sides of ``parsed_lines``."""
    return sides(parsed_lines(lines, schema, line_col, preview_chars), schema)


def sides(parsed: DataFrame, schema: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters) of parsed lines, saved ones too."""
    return parsed.where("error is null").select(*schema), parsed.where("error is not null").select("raw_line", "error")


def parsed_lines(lines: DataFrame, schema: dict[str, str], line_col: str = "value",
                 preview_chars: int | None = None) -> DataFrame:
    """One row per line: the typed fields of a good one, or the raw line and the reason.

    Every line gets exactly one outcome: malformed JSON, a missing required field,
    or a field that does not cast to its type; otherwise it is good. The reason is
    attached to the dead letter together with the whole raw line, so that it can be
    replayed (``preview_chars`` cuts it, where only a preview is wanted)."""
    ddl = ", ".join("%s string" % f for f in schema) + ", _corrupt_record string"
    parsed = lines.withColumn("_p", F.from_json(F.col(line_col), ddl, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    valid_json = F.col("_p").isNotNull() & F.col("_p._corrupt_record").isNull()
    reason = F.when(~F.coalesce(valid_json, F.lit(False)), F.lit("malformed_json"))
    for f, typ in schema.items():
        reason = reason.when(F.col("_p." + f).isNull(), F.lit("missing_field:" + f))
    for f, typ in schema.items():
        if typ in ("int", "bigint", "integer", "long"):
            fits = _is_int_text(F.col("_p." + f)) & F.col("_p." + f).try_cast(typ).isNotNull()
            reason = reason.when(~fits, F.lit("bad_type:" + f))
    raw = F.col(line_col) if preview_chars is None else F.substring(F.col(line_col), 1, preview_chars)
    good = F.col("error").isNull()
    return parsed.withColumn("error", reason).select(
        *[F.when(good, F.col("_p." + f).try_cast(t)).alias(f) for f, t in schema.items()],
        F.when(~good, raw).alias("raw_line"), "error")


def order_per_key(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Deliver rows in (key, seq) order. A range partitioning on (key, seq) keeps
    each key's rows contiguous and ordered across tasks, and splits a hot key over
    several tasks instead of one."""
    return df.repartitionByRange(F.col(key), F.col(seq)).sortWithinPartitions(key, seq)


def retry_or_dead_letter(deliveries: DataFrame, msg_id: str, ok: str, max_attempts: int = 5) -> DataFrame:
    """Per message, attempts until acknowledged; never acknowledged within
    ``max_attempts`` deliveries -> dead letter. ``deliveries`` has one row per attempt
    with ``ok`` = processing succeeded (partial aggregates per key, no per-key lists)."""
    g = deliveries.groupBy(msg_id).agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.min(F.when(F.col(ok), F.col("attempt"))).alias("acked_at"))
    in_time = F.col("acked_at").isNotNull() & (F.col("acked_at") <= max_attempts)
    attempts = F.when(in_time, F.col("acked_at")).otherwise(F.least(F.col("deliveries"), F.lit(max_attempts)))
    status = (F.when(in_time, "acked")
              .when(F.col("deliveries") >= max_attempts, "dead_letter").otherwise("retrying"))
    return g.select(msg_id, attempts.cast("bigint").alias("attempts"), status.alias("status"))


def replay(landing: DataFrame, ts: str, since) -> DataFrame:
    """Everything published at or after a mark (seek-to-timestamp)."""
    return landing.filter(F.col(ts) >= F.lit(since).cast(landing.schema[ts].dataType))


def landed_message(df: DataFrame, msg_id: str, ts: str, data: str, attrs: dict[str, Column],
                   subscription: str) -> DataFrame:
    """The landing row: subscription, message id, publish time, data, attributes (JSON)."""
    return df.select(F.lit(subscription).alias("subscription_name"), F.col(msg_id).cast("string").alias("message_id"),
                     F.col(ts).alias("publish_time"), F.col(data).alias("data"),
                     F.to_json(F.struct(*[c.alias(k) for k, c in attrs.items()])).alias("attributes"))


def dedup_stream(stream: DataFrame, msg_id: str, ts: str, horizon: str) -> DataFrame:
    """At-least-once delivery made effectively-once: duplicates of a message id
    arriving within ``horizon`` of event time are dropped; state expires after it."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([msg_id])


def land(spark, stream: DataFrame, name: str) -> str:
    """Append a message stream to a Parquet landing table (bounded run); returns
    the folder holding ``out`` (the table) and ``_checkpoint``."""
    from tidemark.streaming.windows import run_available
    return run_available(spark, stream, name)


def dead_letter_stream(spark, source_dir: str, schema: dict[str, str], name: str = "dead-letter") -> tuple[str, str]:
    """T11 streaming form: text lines arriving as files -> every micro-batch is parsed
    once and both sides are appended (good rows, dead letters with reason) inside one
    ``foreachBatch``; the batch id makes each side's output folder idempotent when a
    micro-batch is retried after a failure. Returns (good_path, bad_path)."""
    from tidemark.streaming.windows import run_available

    def write_both(batch_df, batch_id):
        parsed = parsed_lines(batch_df, schema)
        work = "%s/parsed/batch=%d" % (root, batch_id)
        parsed.write.mode("overwrite").parquet(work)                    # parsed once, published from there
        good, bad = sides(spark.read.schema(parsed.schema).parquet(work), schema)
        good.write.mode("overwrite").parquet("%s/good/batch=%d" % (root, batch_id))
        bad.write.mode("overwrite").parquet("%s/bad/batch=%d" % (root, batch_id))

    from tidemark.session import scratch_dir
    root = scratch_dir(spark, name + "-out")
    stream = spark.readStream.format("text").load(source_dir)
    run_available(spark, stream, name, foreach_batch=write_both)
    return root + "/good", root + "/bad"


RETRY_OUTPUT = "message_id string, attempts long, status string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed_state(spark) -> None:
    """Stateful processors need the RocksDB state store, whatever session they run in."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _timed(stream: DataFrame, ts: str | None, lateness: str, columns: list) -> tuple[DataFrame, str]:
    """The stream with its event time as ``event_at`` and the time mode of its state: without an event time
    (``ts``) state has no timers. Processing time is not used: a bounded run would never end."""
    if ts is None:
        return stream.select(*columns, F.lit(0).cast("long").alias("event_ms")), "None"
    at = F.col(ts).cast("timestamp")
    timed = stream.select(*columns, at.alias("event_at")).withWatermark("event_at", lateness)
    return timed.withColumn("event_ms", F.unix_millis("event_at")), "EventTime"


def _millis(text: str) -> int:
    from tidemark.streaming.windows import interval_seconds
    return int(interval_seconds(text) * 1000)


def retry_stream(deliveries: DataFrame, msg_id: str, ok: str, max_attempts: int = 5, ts: str | None = None,
                 forget_after: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """T14 on a stream: state counts the failed deliveries of a message; the first
    successful delivery emits ``acked``, the ``max_attempts``-th failure emits
    ``dead_letter``, and what is delivered after that is ignored. With an event time (``ts``) a message
    leaves the state ``forget_after`` its last delivery, finished or not: the state follows
    the messages of that time, not all there ever were."""
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor
    horizon = _millis(forget_after)
    d, mode = _timed(deliveries, ts, lateness, [F.col(msg_id).cast("string").alias("message_id"), F.col(ok).alias("ok")])

    class Attempts(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.seen = handle.getValueState("seen", "failed long, done boolean")

        def handleInputRows(self, key, rows, timerValues):
            known = self.seen.get()                     # None: the first delivery
            failed, done = known or (0, False)
            status, last = None, 0
            for row in rows:
                last = max(last, row["event_ms"])
                if not done:
                    failed += 0 if row["ok"] else 1
                    status = "acked" if row["ok"] else "dead_letter" if failed >= max_attempts else None
                    done = status is not None
            self.seen.update((failed, done))
            if mode == "EventTime":
                for timer in list(self.handle.listTimers()) if known else ():
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(last + horizon)
            if status:
                yield Row(message_id=key[0], attempts=failed + (status == "acked"), status=status)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.seen.clear()
            return iter(())

        def close(self):
            pass

    keyed_state(deliveries.sparkSession)
    # rows, not pandas: a message has a delivery or two, for which frames would cost more than the work
    return d.groupBy("message_id").transformWithState(Attempts(), RETRY_OUTPUT, "Append", mode)


def resequence_stream(stream: DataFrame, key: str, seq: str, payload: str, first_seq: int = 1, ts: str | None = None,
                      gap_after: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """T13 on a stream: per ordering key, release messages strictly in sequence order.

    A message ahead of a gap is held, one entry each, until the missing ones arrive. With an event
    time (``ts``) a gap is given up once the watermark is ``gap_after`` past the newest message held, and the key goes on
    behind it: one lost message never holds a key, or its state, for ever. A message that
    comes for a gap given up is dropped, as a repeat is."""
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor
    wait = _millis(gap_after)
    s, mode = _timed(stream, ts, lateness, [F.col(key).cast("string").alias("key"), F.col(seq).cast("long").alias("seq"),
                                            F.col(payload).cast("string").alias("payload")])

    class InOrder(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.next = handle.getValueState("next", "seq long")
            self.held = handle.getMapState("held", "seq long", "payload string")

        def released(self, key, at):
            import pandas as pd
            out = []
            while self.held.containsKey((at,)):
                out.append((key[0], at, self.held.getValue((at,))[0]))
                self.held.removeKey((at,))
                at += 1
            self.next.update((at,))
            return pd.DataFrame(out, columns=["key", "seq", "payload"])

        def ahead(self):
            return [k[0] for k in self.held.keys()] if self.held.exists() else []

        def handleInputRows(self, key, rows, timerValues):
            at, last = self.next.get()[0] if self.next.exists() else first_seq, 0
            for pdf in rows:
                last = max(last, int(pdf["event_ms"].max()))
                for s, p in zip(pdf["seq"].tolist(), pdf["payload"].tolist()):
                    if s >= at:
                        self.held.updateValue((int(s),), (p,))
            out = self.released(key, at)
            if mode == "EventTime" and self.ahead():
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(last + wait)
            if len(out):
                yield out

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            while ahead := self.ahead():
                yield self.released(key, min(ahead))

        def close(self):
            pass

    keyed_state(stream.sparkSession)
    return s.groupBy("key").transformWithStateInPandas(InOrder(), "key string, seq long, payload string", "Append", mode)


def split_late(spark, stream: DataFrame, ts: str, lateness: str, name: str = "late", more=None) -> tuple[str, str]:
    """Rows on time and rows that are late, each appended to its own table.

    A row is late if its event time is more than ``lateness`` behind the greatest event time of the
    micro-batches before its own: the rule of a watermark, but the late rows are kept. What each
    micro-batch saw as its greatest event time is a row of a small table beside the checkpoint; all three outputs
    are keyed by the micro-batch's id, so one that runs again writes the same. Returns (on-time path, late path)."""
    from tidemark.session import scratch_dir
    from tidemark.streaming.windows import interval_seconds, run_available
    root = scratch_dir(spark, name + "-split")
    wait = F.make_dt_interval(secs=F.lit(interval_seconds(lateness)))

    def write(batch, batch_id):
        clock = root + "/clock"
        before = None
        if files.path_exists(spark, clock):
            before = spark.read.parquet(clock).where(F.col("batch") < batch_id).agg(F.max("greatest")).first()[0]
        late = F.lit(False) if before is None else F.coalesce(F.col(ts) < F.lit(before).cast(batch.schema[ts].dataType) - wait,
                                                              F.lit(False))
        sides = batch.withColumn("side", F.when(late, "late").otherwise("on_time"))
        (sides.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("side", "batch").parquet(root + "/rows"))
        (batch.agg(F.max(ts).alias("greatest")).withColumn("batch", F.lit(batch_id)).coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(clock))

    run_available(spark, stream, name, foreach_batch=write, more=more)
    return root + "/rows/side=on_time", root + "/rows/side=late"
