"""Registered event-time and messaging queries over ``events``
and ``conversations``.

Streaming keys read the driver table as a file stream and run with
``availableNow`` into a sink under the shared checkpoint root; the returned frame
reads that sink, so the oracle is the batch SQL of the final state.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import u01
from tidemark.plans.oracle_feed import U
from tidemark.session import ensure_conf, scratch_dir
from tidemark.sources import files
from tidemark.sources.tables import Tables
from tidemark.streaming import messaging, panes, windows

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
DL_SCHEMA = {"event_id": "int", "user": "string", "action": "string", "value": "int"}
REPLAY_MARK = "2024-01-29 00:00:00"


def _events(spark, sf_dir) -> DataFrame:
    return Tables(spark, sf_dir).events


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's events table as a file stream (only that file is picked up)."""
    return (spark.readStream.schema(EVENTS_DDL).option("pathGlobFilter", "events.parquet")
            .parquet(sf_dir))


# ------------------------------------------------------------- batch windows
def win_global(spark, sf_dir):
    """One global window per user."""
    return windows.per_key(_events(spark, sf_dir), ["user_id"], "value")


def win_tumbling(spark, sf_dir):
    """1-hour fixed windows per event type, labelled with (start, end)."""
    return windows.tumbling(_events(spark, sf_dir), "ts", "1 hour", ["event_type"])


def win_sliding(spark, sf_dir):
    """T4: 1-hour windows every 30 minutes (each event in two windows)."""
    return windows.sliding(_events(spark, sf_dir), "ts", "1 hour", "30 minutes", ["event_type"])


def win_session(spark, sf_dir):
    """T5: per-user sessions closed after 6 hours of silence."""
    return windows.session(_events(spark, sf_dir), "ts", "6 hours", ["user_id"])


# ----------------------------------------------------------------- streams
def stream_watermark_counts(spark, sf_dir):
    """Watermarked 1-hour counts (10 min lateness), append mode, run to end."""
    ensure_conf(spark)
    root = windows.run_to_end(
        spark, _event_stream(spark, sf_dir),
        lambda s: windows.windowed_counts(s, "ts", "1 hour", ["event_type"], "10 minutes"), "ts", "wm-counts")
    return spark.read.parquet(root + "/out")


def stream_sessions(spark, sf_dir):
    """Streaming 6-hour-gap sessions per user with a 1-hour watermark, run to end."""
    ensure_conf(spark)
    root = windows.run_to_end(
        spark, _event_stream(spark, sf_dir),
        lambda s: windows.session_counts(s, "ts", "6 hours", ["user_id"], "1 hour"), "ts", "sessions")
    return spark.read.parquet(root + "/out")


def stream_dedup(spark, sf_dir):
    """At-least-once feed (5% of events delivered twice) de-duplicated in the stream."""
    ensure_conf(spark)
    s = _event_stream(spark, sf_dir).withColumn("event_time", F.col("ts").cast("timestamp"))
    dup = s.filter(u01("event_id", "rep") < 0.05)
    q = messaging.dedup_stream(s.unionByName(dup), "event_id", "event_time", "1 day")
    root = windows.run_available(spark, q.select("event_id", "ts", "user_id", "event_type"), "dedup")
    return spark.read.parquet(root + "/out")


def _land(spark, sf_dir) -> str:
    s = _event_stream(spark, sf_dir)
    landed = messaging.landed_message(s, "event_id", "ts", "props", {"kind": F.col("event_type")}, "events-sub")
    return windows.run_available(spark, landed, "landing")


def land_messages(spark, sf_dir):
    """Messages landed with id, publish time, data and attributes (streaming append)."""
    ensure_conf(spark)
    return spark.read.parquet(_land(spark, sf_dir) + "/out")


def replay_since(spark, sf_dir):
    """Replay from a mark: everything landed with publish_time >= mark."""
    ensure_conf(spark)
    landing = spark.read.parquet(_land(spark, sf_dir) + "/out")
    return messaging.replay(landing, "publish_time", REPLAY_MARK)


def _arrivals(spark, sf_dir):
    """Events by arrival (10% arrive two days late), 5 arrival days a micro-batch: (stream, ``more``)."""
    ev = spark.read.schema(EVENTS_DDL).parquet("%s/events.parquet" % sf_dir.rstrip("/"))
    late = u01("event_id", "arr") < 0.10
    arr = F.when(late, F.timestamp_add("DAY", F.lit(2), F.col("ts"))).otherwise(F.col("ts"))
    lo = ev.agg(F.min(F.to_date("ts"))).first()[0]
    staged = ev.withColumn("chunk", (F.datediff(F.to_date(arr), F.lit(lo)) / 5).cast("int"))
    return windows.deliver(spark, staged, "chunk", "arrivals")


def _panes(spark, sf_dir, accumulating: bool, lateness_seconds: int = 3 * 86400) -> DataFrame:
    ensure_conf(spark)
    stream, more = _arrivals(spark, sf_dir)
    q = panes.paned_counts(stream, "event_type", "ts", 86400, 50, lateness_seconds, accumulating)
    root = windows.run_available(spark, q, "panes", more=more)
    return spark.read.schema(panes.OUTPUT_SCHEMA).parquet(root + "/out")


def stream_panes_acc(spark, sf_dir):
    """Daily panes per event type, early every 50 events, accumulating,
    3 days of allowed lateness (the two-day-late arrivals give LATE panes)."""
    return _panes(spark, sf_dir, True).filter(F.col("kind") == "pane")


def stream_panes_disc(spark, sf_dir):
    """Same panes, discarding (each pane holds only new events)."""
    return _panes(spark, sf_dir, False).filter(F.col("kind") == "pane")


def stream_late_dropped(spark, sf_dir):
    """With 6 hours of allowed lateness the two-day-late arrivals are behind the clock of the files
    before theirs: they are kept in a table of their own, not silently dropped."""
    ensure_conf(spark)
    stream, more = _arrivals(spark, sf_dir)
    _, late = messaging.split_late(spark, stream, "ts", "6 hours", more=more)
    return spark.read.parquet(late).drop("batch")


# --------------------------------------------------------------- messaging
def dead_letter_lines(spark, sf_dir) -> DataFrame:
    """Event lines as JSON text; ~8% broken in one of four ways (hash draw on the id)."""
    ev = _events(spark, sf_dir)
    d = u01("event_id", "dl")
    good = F.to_json(F.struct(F.col("event_id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"),
                              F.col("event_type").alias("action"), F.floor("value").cast("bigint").alias("value")))
    no_value = F.to_json(F.struct(F.col("event_id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"),
                                  F.col("event_type").alias("action")))
    bad_type = F.to_json(F.struct(F.col("event_id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"),
                                  F.col("event_type").alias("action"), F.lit("n/a").alias("value")))
    line = (F.when(d < 0.02, no_value).when(d < 0.04, F.lit("THIS IS NOT JSON AT ALL"))
            .when(d < 0.06, F.lit('{"broken json": }')).when(d < 0.08, bad_type).otherwise(good))
    return ev.select(line.alias("value"))


def dead_letter_job(spark, lines: DataFrame) -> tuple[str, str]:
    """Lines landed as a text file (S17), read back (S4), parsed with a dead-letter
    side output (T11), both sides written as whole tables (S10)."""
    root = scratch_dir(spark, "dead-letter")
    lines.write.mode("overwrite").text(root + "/in")
    parsed = messaging.parsed_lines(files.read_lines(spark, root + "/in"), DL_SCHEMA)
    parsed.write.parquet(root + "/parsed")                              # parsed once, published from there
    good, bad = messaging.sides(spark.read.schema(parsed.schema).parquet(root + "/parsed"), DL_SCHEMA)
    files.replace_table(good, root + "/events")
    files.replace_table(bad, root + "/events_dead_letter")
    return root + "/events", root + "/events_dead_letter"


def _dead_letter(spark, sf_dir):
    ensure_conf(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DL_CACHE or not files.path_exists(spark, _DL_CACHE[key][0]):
        _DL_CACHE[key] = dead_letter_job(spark, dead_letter_lines(spark, sf_dir))
    return _DL_CACHE[key]


_DL_CACHE: dict = {}


def dead_letter_good(spark, sf_dir):
    """Parsed, schema-checked rows (the good table of the batch job)."""
    return spark.read.parquet(_dead_letter(spark, sf_dir)[0])


def dead_letter_bad(spark, sf_dir):
    """Dead letters with raw line (cut at 900 chars) and reason."""
    return spark.read.parquet(_dead_letter(spark, sf_dir)[1])


def ordered_per_key(spark, sf_dir):
    """Conversation turns delivered in (conversation, turn) order."""
    c = Tables(spark, sf_dir).conversations
    return messaging.order_per_key(c.select("conv_id", "turn", "role", F.length("text").alias("n_chars")),
                                   "conv_id", "turn")


def dlq_after_n(spark, sf_dir):
    """Poison messages (5%) fail every delivery and are dead-lettered after 5."""
    c = Tables(spark, sf_dir).conversations
    msg = (F.col("conv_id") * 100 + F.col("turn")).alias("message_id")
    m = c.select(msg).withColumn("poison", u01("message_id", "poison") < 0.05)
    deliveries = m.select("message_id", "poison", F.explode(
        F.sequence(F.lit(1), F.when(F.col("poison"), F.lit(6)).otherwise(F.lit(1)))).alias("attempt"))
    deliveries = deliveries.withColumn("ok", ~F.col("poison"))
    return messaging.retry_or_dead_letter(deliveries, "message_id", "ok", 5)


def dlq_stream(spark, sf_dir):
    """T14 as a stream: the same deliveries, two attempts a file; attempts and finished messages are state that expires."""
    ensure_conf(spark)
    c = Tables(spark, sf_dir).conversations
    m = c.select((F.col("conv_id") * 100 + F.col("turn")).alias("message_id"))
    m = m.withColumn("ok", u01("message_id", "poison") >= 0.05)
    sent = m.select("message_id", "ok", F.explode(F.when(F.col("ok"), F.array(F.lit(1))).otherwise(
        F.sequence(F.lit(1), F.lit(6)))).alias("attempt"))
    sent = sent.withColumn("at", F.timestamp_add("MINUTE", F.col("attempt"), F.lit("2026-01-01").cast("timestamp")))
    stream, more = windows.deliver(spark, sent.withColumn("step", F.floor((F.col("attempt") - 1) / 2).cast("int")), "step", "deliveries")
    root = windows.run_available(spark, messaging.retry_stream(stream, "message_id", "ok", 5, ts="at"), "dlq", more=more)
    out = spark.read.schema(messaging.RETRY_OUTPUT).parquet(root + "/out")
    return out.withColumn("message_id", F.col("message_id").cast("bigint"))


def ordered_stream(spark, sf_dir):
    """T13 as a stream: turns arrive in two files, odd ones in the first; each conversation comes out in
    order and without gaps (``position``: where in the key's output a turn was released)."""
    ensure_conf(spark)
    c = Tables(spark, sf_dir).conversations.select("conv_id", "turn", "role").dropDuplicates(["conv_id", "turn"])
    src = scratch_dir(spark, "turns")
    for odd in (1, 0):
        c.where(F.pmod("turn", F.lit(2)) == odd).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(src)
    first = c.agg(F.min("turn")).first()[0] or 0
    root = windows.run_available(spark, messaging.resequence_stream(stream, "conv_id", "turn", "role", int(first)), "ordered")
    return spark.read.schema("key string, seq long, payload string").parquet(root + "/out").select(
        F.col("key").cast("bigint").alias("conv_id"), F.col("seq").alias("turn"), F.col("payload").alias("role"))


QUERIES = {f.__name__: f for f in [
    dlq_stream, ordered_stream, win_global, win_tumbling, win_sliding, win_session, stream_watermark_counts, stream_sessions, stream_dedup,
    land_messages, replay_since, stream_panes_acc, stream_panes_disc, stream_late_dropped, dead_letter_good,
    dead_letter_bad, ordered_per_key, dlq_after_n]}

_DL = U("event_id", "dl")
_DL_LINES = """WITH lines AS (
  SELECT CASE WHEN %(d)s < 0.02 THEN '{"event_id":' || event_id || ',"user":"u' || user_id || '","action":"' || event_type || '"}'
              WHEN %(d)s < 0.04 THEN 'THIS IS NOT JSON AT ALL'
              WHEN %(d)s < 0.06 THEN '{"broken json": }'
              WHEN %(d)s < 0.08 THEN '{"event_id":' || event_id || ',"user":"u' || user_id || '","action":"' || event_type || '","value":"n/a"}'
              ELSE '{"event_id":' || event_id || ',"user":"u' || user_id || '","action":"' || event_type || '","value":' || CAST(floor(value) AS BIGINT) || '}'
         END AS value,
         CASE WHEN %(d)s < 0.02 THEN 'missing_field:value' WHEN %(d)s < 0.04 THEN 'malformed_json'
              WHEN %(d)s < 0.06 THEN 'malformed_json' WHEN %(d)s < 0.08 THEN 'bad_type:value' END AS error,
         event_id, 'u' || user_id AS "user", event_type AS action, CAST(floor(value) AS INTEGER) AS v
  FROM events)
""" % {"d": _DL}

_SESS = """WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
s AS (SELECT user_id, ts, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e),
w AS (SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, count(*) AS n
      FROM s GROUP BY user_id, sid)
"""

_DLQ = """WITH m AS (SELECT conv_id * 100 + turn AS message_id,
            %s < 0.05 AS poison FROM conversations)
        SELECT message_id, CAST(CASE WHEN poison THEN 5 ELSE 1 END AS BIGINT) AS attempts,
               CASE WHEN poison THEN 'dead_letter' ELSE 'acked' END AS status FROM m""" % U("(conv_id * 100 + turn)", "poison")

ORACLE = {
    "win_global": """SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM events GROUP BY user_id""",
    "win_tumbling": """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
        time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n
        FROM events GROUP BY 1, 2, 3""",
    "win_sliding": """WITH b AS (SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) AS b30 FROM events),
        w AS (SELECT event_type, b30 AS window_start FROM b UNION ALL SELECT event_type, b30 - INTERVAL 30 MINUTE FROM b)
        SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n
        FROM w GROUP BY 1, 2, 3""",
    "win_session": _SESS + "SELECT window_start, window_end, user_id, n FROM w",
    "stream_watermark_counts": """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
        time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n
        FROM events GROUP BY 1, 2, 3""",
    "stream_sessions": _SESS + "SELECT window_start, window_end, user_id, n FROM w",
    "stream_dedup": "SELECT event_id, ts, user_id, event_type FROM events",
    "land_messages": """SELECT 'events-sub' AS subscription_name, CAST(event_id AS VARCHAR) AS message_id,
        ts AS publish_time, props AS data, '{"kind":"' || event_type || '"}' AS attributes FROM events""",
    "replay_since": """SELECT 'events-sub' AS subscription_name, CAST(event_id AS VARCHAR) AS message_id,
        ts AS publish_time, props AS data, '{"kind":"' || event_type || '"}' AS attributes FROM events
        WHERE ts >= TIMESTAMP '%s'""" % REPLAY_MARK,
    "dead_letter_good": _DL_LINES + """SELECT CAST(event_id AS INTEGER) AS event_id, "user", action, v AS value
        FROM lines WHERE error IS NULL""",
    "dead_letter_bad": _DL_LINES + "SELECT substr(value, 1, 900) AS raw_line, error FROM lines WHERE error IS NOT NULL",
    "ordered_per_key": "SELECT conv_id, turn, role, CAST(length(text) AS INTEGER) AS n_chars FROM conversations",
    "dlq_after_n": _DLQ,
    "dlq_stream": _DLQ,
    # a conversation whose turns have a gap is released up to the gap
    "ordered_stream": """WITH c AS (SELECT DISTINCT conv_id, turn, role FROM conversations),
        r AS (SELECT *, turn - (SELECT min(turn) FROM c) - row_number() OVER (PARTITION BY conv_id ORDER BY turn) + 1 AS missing
              FROM c)
        SELECT conv_id, CAST(turn AS BIGINT) AS turn, role FROM r WHERE missing = 0""",
    "stream_late_dropped": """WITH e AS (
          SELECT *, CASE WHEN %s < 0.10 THEN ts + INTERVAL 2 DAY ELSE ts END AS arrives FROM events),
        c AS (SELECT *, date_diff('day', (SELECT CAST(min(ts) AS DATE) FROM events), CAST(arrives AS DATE)) // 5 AS chunk FROM e),
        m AS (SELECT chunk, max(max(ts)) OVER (ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock
              FROM c GROUP BY chunk)
        SELECT event_id, ts, user_id, event_type, value, props FROM c JOIN m USING (chunk)
        WHERE ts < clock - INTERVAL 6 HOUR""" % U("event_id", "arr"),
}
