"""Golden cases 3, 11, 12: dead letters, retry-to-DLQ, replay, threshold alerts."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import usage
from tidemark.streaming import messaging

LINES = ['{"event_id": 1, "user": "alice", "action": "click", "value": 10}',
         '{"event_id": 2, "user": "bob", "action": "view", "value": 3}',
         'THIS IS NOT JSON AT ALL',
         '{"event_id": 3, "user": "carol", "action": "click", "value": 7}',
         '{"event_id": 4, "user": "alice", "action": "purchase", "value": 120}',
         '{"event_id": 5, "user": "bob", "action": "click"}',
         '{"broken json": }',
         '{"event_id": 6, "user": "dave", "action": "view", "value": 1}',
         '{"event_id": 7, "user": "alice", "action": "click", "value": 5}',
         '{"event_id": 8, "user": "carol", "action": "purchase", "value": 45}']
SCHEMA = {"event_id": "int", "user": "string", "action": "string", "value": "int"}


def test_dead_letter_split(spark):
    good, bad = messaging.parse_or_dead_letter(spark.createDataFrame([(x,) for x in LINES], "value string"), SCHEMA)
    assert sorted(r["event_id"] for r in good.collect()) == [1, 2, 3, 4, 6, 7, 8]
    got = sorted((r["raw_line"], r["error"]) for r in bad.collect())
    assert got == sorted([("THIS IS NOT JSON AT ALL", "malformed_json"), ('{"broken json": }', "malformed_json"),
                          ('{"event_id": 5, "user": "bob", "action": "click"}', "missing_field:value")])


def test_raw_line_is_whole_unless_a_preview_is_asked_for(spark):
    lines = spark.createDataFrame([("x" * 2000,)], "value string")
    assert len(messaging.parse_or_dead_letter(lines, SCHEMA)[1].first()["raw_line"]) == 2000
    assert len(messaging.parse_or_dead_letter(lines, SCHEMA, preview_chars=900)[1].first()["raw_line"]) == 900


def test_retry_then_dead_letter(spark):
    rows = [("poison", a, False) for a in range(1, 7)] + [("ok", 1, True)]
    d = spark.createDataFrame(rows, "message_id string, attempt int, ok boolean")
    got = {r["message_id"]: (r["attempts"], r["status"]) for r in messaging.retry_or_dead_letter(d, "message_id", "ok", 5).collect()}
    assert got == {"poison": (5, "dead_letter"), "ok": (1, "acked")}


def test_replay_since_mark(spark):
    base = dt.datetime(2026, 1, 1, 12)
    landing = spark.createDataFrame([("r%d" % i, base + dt.timedelta(seconds=i)) for i in (1, 2, 3)] +
                                    [("old", base - dt.timedelta(hours=1))], "data string, publish_time timestamp")
    assert sorted(r["data"] for r in messaging.replay(landing, "publish_time", base).collect()) == ["r1", "r2", "r3"]


def test_threshold_alerts(spark):
    base = dt.datetime(2026, 1, 1, 12)
    jobs = spark.createDataFrame([(base, 200_000_000), (base + dt.timedelta(minutes=1), 50_000_000),
                                  (base + dt.timedelta(minutes=7), 150_000_000),
                                  (base + dt.timedelta(minutes=12), 10)], "t timestamp, b bigint")
    got = sorted((r["window_start"].minute, r["events"]) for r in usage.threshold_alerts(jobs, "t", "b", 100_000_000).collect())
    assert got == [(0, 1), (5, 1)]


def test_order_per_key_keeps_each_key_contiguous_and_sorted(spark):
    rows = [(k, t) for k in range(20) for t in range(50)]
    df = spark.createDataFrame(rows, "k int, t int").repartition(7)
    out = messaging.order_per_key(df, "k", "t").select("k", "t", F.spark_partition_id().alias("p")).collect()
    by_part = {}
    for r in out:
        by_part.setdefault(r["p"], []).append((r["k"], r["t"]))
    for seq in by_part.values():
        assert seq == sorted(seq)
    spans = sorted((min(s), max(s)) for s in by_part.values() if s)
    for (a_lo, a_hi), (b_lo, b_hi) in zip(spans, spans[1:]):
        assert a_hi <= b_lo          # partitions cover disjoint, ordered ranges of (key, seq)


def test_threshold_alerts_stream(spark):
    import time as _t
    from tidemark.session import scratch_dir
    from tidemark.streaming import windows
    src = scratch_dir(spark, "alerts-src")
    base = dt.datetime(2026, 1, 1, 12)
    for rows in ([(base, 200_000_000), (base + dt.timedelta(minutes=1), 50_000_000)],
                 [(base + dt.timedelta(minutes=7), 150_000_000)],
                 [(base + dt.timedelta(minutes=30), 10)]):
        spark.createDataFrame(rows, "t timestamp, b bigint").coalesce(1).write.mode("append").parquet(src)
        _t.sleep(0.05)
    stream = spark.readStream.schema("t timestamp, b bigint").option("maxFilesPerTrigger", 1).parquet(src)
    root = windows.run_available(spark, windows.threshold_alerts_stream(stream, "t", "b", 100_000_000), "alerts")
    got = sorted((r["window_start"].minute, r["events"]) for r in spark.read.parquet(root + "/out").collect())
    assert got == [(0, 1), (5, 1)]


def test_dead_letter_stream_matches_batch(spark):
    from tidemark.session import scratch_dir
    src = scratch_dir(spark, "dl-src")
    for i in range(0, len(LINES), 4):          # three files, three micro-batches
        spark.createDataFrame([(x,) for x in LINES[i:i + 4]], "value string").coalesce(1).write.mode("append").text(src)
    good_path, bad_path = messaging.dead_letter_stream(spark, src, SCHEMA)
    good = spark.read.parquet(good_path)
    bad = spark.read.parquet(bad_path)
    assert sorted(r["event_id"] for r in good.collect()) == [1, 2, 3, 4, 6, 7, 8]
    assert sorted(r["error"] for r in bad.collect()) == ["malformed_json", "malformed_json", "missing_field:value"]


def test_retry_stream_dead_letters_after_five(spark):
    import time as _t
    from tidemark.session import scratch_dir
    from tidemark.streaming import windows
    src = scratch_dir(spark, "retry-src")
    rounds = [[("poison", False), ("ok", True)]] + [[("poison", False)]] * 6   # redelivered until dead-lettered
    for rows in rounds:
        spark.createDataFrame(rows, "message_id string, ok boolean").coalesce(1).write.mode("append").parquet(src)
        _t.sleep(0.05)
    stream = spark.readStream.schema("message_id string, ok boolean").option("maxFilesPerTrigger", 1).parquet(src)
    root = windows.run_available(spark, messaging.retry_stream(stream, "message_id", "ok", 5), "retry")
    got = sorted((r["message_id"], r["attempts"], r["status"]) for r in spark.read.parquet(root + "/out").collect())
    assert got == [("ok", 1, "acked"), ("poison", 5, "dead_letter")]


def test_resequence_stream_releases_in_order(spark):
    import time as _t
    from tidemark.session import scratch_dir
    from tidemark.streaming import windows
    src = scratch_dir(spark, "reseq-src")
    arrivals = [[("A", 2), ("B", 1)], [("A", 3), ("B", 3)], [("A", 1)], [("B", 2), ("A", 4)]]
    for rows in arrivals:
        spark.createDataFrame([(k, s, "%s%d" % (k, s)) for k, s in rows], "k string, s long, p string") \
            .coalesce(1).write.mode("append").parquet(src)
        _t.sleep(0.05)
    stream = spark.readStream.schema("k string, s long, p string").option("maxFilesPerTrigger", 1).parquet(src)
    root = windows.run_available(spark, messaging.resequence_stream(stream, "k", "s", "p"), "reseq")
    out = spark.read.parquet(root + "/out").collect()
    assert sorted((r["key"], r["seq"]) for r in out) == [("A", 1), ("A", 2), ("A", 3), ("A", 4), ("B", 1), ("B", 2), ("B", 3)]


def _arrive(spark, name, rounds, schema):
    import time as _t
    from tidemark.session import scratch_dir
    src = scratch_dir(spark, name)
    for rows in rounds:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        _t.sleep(0.05)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


def _state_rows(stream_df, spark, name):
    from tidemark.session import scratch_dir
    root = scratch_dir(spark, "state-" + name)
    q = (stream_df.writeStream.option("checkpointLocation", root + "/_checkpoint").outputMode("append")
         .format("parquet").option("path", root + "/out").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    return spark.read.parquet(root + "/out").collect(), rows


def test_finished_messages_leave_the_state(spark):
    at = lambda d, m=0: dt.datetime(2026, 1, d, 0, m)                           # noqa: E731
    rounds = [[("m%d-%d" % (d, i), i > 0, at(d)) for i in range(6)] for d in (1, 3, 5, 7, 9)]
    rounds[1] += [("m1-0", False, at(3))]
    stream = _arrive(spark, "retry-ttl", rounds, "message_id string, ok boolean, at timestamp")
    out, state = _state_rows(messaging.retry_stream(stream, "message_id", "ok", 2, ts="at", forget_after="36 hours"),
                             spark, "retry")
    assert {r["message_id"] for r in out if r["status"] == "acked"} == {"m%d-%d" % (d, i) for d in (1, 3, 5, 7, 9)
                                                                        for i in range(1, 6)}
    assert state and max(state) < 60 and state[-1] <= 4 * 7                     # not all 30 messages and their timers


def test_a_gap_is_given_up_and_leaves_the_state(spark):
    at = lambda h: dt.datetime(2026, 1, 1, h)                                   # noqa: E731
    rounds = [[("A", 1, at(0)), ("A", 3, at(0)), ("B", 1, at(0))], [("A", 4, at(1))], [("B", 2, at(8))], [("B", 3, at(9))],
              [("A", 2, at(9)), ("A", 5, at(9)), ("B", 4, at(15))]]
    rows = [[(k, s, "%s%d" % (k, s), t) for k, s, t in r] for r in rounds]
    stream = _arrive(spark, "gap", rows, "k string, s bigint, p string, at timestamp")
    out, _ = _state_rows(messaging.resequence_stream(stream, "k", "s", "p", ts="at", gap_after="2 hours"), spark, "gap")
    assert sorted((r["key"], r["seq"]) for r in out) == [("A", 1), ("A", 3), ("A", 4), ("A", 5), ("B", 1), ("B", 2), ("B", 3),
                                                         ("B", 4)]


def test_late_rows_go_to_their_own_table(spark):
    at = lambda h: dt.datetime(2026, 1, 1, h)                                   # noqa: E731
    rounds = [[(1, at(5)), (2, at(1))], [(3, at(4)), (4, at(2)), (5, None)], [(6, at(9))], [(7, at(6)), (8, at(5))]]
    stream = _arrive(spark, "late-src", rounds, "id int, at timestamp")
    on_time, late = messaging.split_late(spark, stream, "at", "2 hours")
    assert sorted(r["id"] for r in spark.read.parquet(late).collect()) == [4, 7, 8]
    assert sorted(r["id"] for r in spark.read.parquet(on_time).collect()) == [1, 2, 3, 5, 6]


def test_a_failed_replacement_leaves_the_table(spark):
    import pytest
    from tidemark.session import scratch_dir
    from tidemark.sources import files
    path = scratch_dir(spark, "replace") + "/t"
    files.replace_table(spark.range(5), path)
    with pytest.raises(Exception):
        files.replace_table(spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    files.replace_table(spark.read.parquet(path).where("id < 2"), path)         # a table may be replaced by what is read from it
    assert spark.read.parquet(path).count() == 2
