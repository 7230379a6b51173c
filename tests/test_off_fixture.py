"""Ordinary inputs that the driver tables lack: each once gave a wrong answer."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash
from tidemark.operators import gates, joins, merge, usage
from tidemark.session import scratch_dir
from tidemark.sources import files, layout
from tidemark.streaming import messaging, windows


def test_overlong_integer_is_a_dead_letter(spark):
    long_line = '{"id": "1", "v": "99999999999", "pad": "%s"}' % ("x" * 2000)
    lines = spark.createDataFrame([(long_line,), ('{"id": "2", "v": "7"}',)], "value string")
    good, bad = messaging.parse_or_dead_letter(lines, {"id": "string", "v": "int"})
    assert [tuple(r) for r in good.collect()] == [("2", 7)]
    assert [tuple(r) for r in bad.collect()] == [(long_line, "bad_type:v")]


def test_null_credits_are_skipped(spark):
    df = spark.createDataFrame(
        [(1, [{"amount": 1.5}, {"amount": None}]), (2, None)], "id int, credits array<struct<amount:double>>")
    out = {r["id"]: float(r["s"]) for r in df.select("id", usage.sum_nested("credits", "amount").alias("s")).collect()}
    assert out == {1: 1.5, 2: 0.0}
    lab = spark.createDataFrame([(1, None)], "id int, labels array<struct<key:string,value:string>>")
    assert lab.select(usage.has_label("labels", "team").alias("x")).first()["x"] is False


def test_separator_inside_a_value_changes_the_hash(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("\\N", "c"), ("a\\", "|c"), ("a", "\\|c")]
    df = spark.createDataFrame(rows, "x string, y string").select(row_hash("x", "y").alias("h"))
    assert df.distinct().count() == len(rows)


def test_late_ack_counts_as_five_attempts(spark):
    rows = [("m", k, k == 7) for k in range(1, 8)]
    df = spark.createDataFrame(rows, "id string, attempt int, ok boolean")
    assert tuple(messaging.retry_or_dead_letter(df, "id", "ok").first()) == ("m", 5, "dead_letter")


def test_null_operation_replaces_the_row(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    changes = spark.createDataFrame([(1, 5, None, "new")], "k int, seq int, op string, v string")
    assert [tuple(r) for r in merge.apply_cdc(target, changes, "k", "seq").collect()] == [(1, "new")]


def test_null_event_time_is_in_no_session(spark):
    t = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([("a", t), ("a", None)], "k string, ts timestamp")
    assert windows.session(df, "ts", "30 minutes", ["k"]).count() == 1


def test_salted_join_refuses_right_joins(spark):
    df = spark.range(2).select(F.col("id").alias("k"))
    with pytest.raises(ValueError):
        joins.salted_join(df, df, "k", 4, "right")


def test_partition_guard_looks_at_the_plan(spark):
    path = scratch_dir(spark, "guard") + "/t"
    df = spark.range(30).select("id", F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") % 3).cast("int")).alias("m"))
    layout.write_partitioned(df, path, "m")
    for nothing in ("", "id > 3", "m = m OR 1 = 1", "m IS NOT NULL", "id > 3 OR m > DATE '2026-01-01'"):
        with pytest.raises(layout.MissingPartitionFilter):
            layout.guarded_read(spark, path, "m", nothing)
    assert layout.guarded_read(spark, path, "m", "m = DATE '2026-01-02' AND id > 3").count() == 9
    assert layout.guarded_read(spark, path, "m", "m >= DATE '2026-01-02'").count() == 20


def test_trailing_gate_counts_calendar_days(spark):
    days = [(dt.date(2026, 1, d), n) for d, n in ((1, 1000), (2, 10), (9, 10), (20, 99))]
    out = gates.gate_trailing(spark.createDataFrame(days, "d date, n long"), "d", "n", 7, 0.5)
    got = {r["d"].day: (r["trailing_avg"], r["passed"]) for r in out.collect()}
    assert got == {1: (None, True), 2: (1000.0, False), 9: (10.0, True), 20: (None, True)}


def test_hot_keys_are_counted_over_all_rows(spark):
    fact = spark.range(1000).select(F.when(F.col("id") < 300, "a").when(F.col("id") < 310, "b").when(
        F.col("id") < 700, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    assert sorted(joins.hot_keys(fact, "k")) == ["a", "b"]
    assert joins.hot_keys(fact, "k", 0.2) == ["a"] and joins.hot_keys(fact.where("false"), "k") == []


def test_bucket_counts_of_many_partitions(spark):
    df = spark.range(5000).select("id", F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 500).cast("int")).alias("d"))
    counts = {str(dt.date(2020, 1, 1) + dt.timedelta(days=k)): 10 for k in range(500)}
    out = files.bucketed_by_counts(df, "d", counts, rows_per_file=4)
    assert out.columns == df.columns and out.exceptAll(df).isEmpty() and out.count() == 5000


def test_bounded_stream_closes_its_last_windows(spark):
    src = scratch_dir(spark, "bounded") + "/in"
    at = [dt.datetime(2026, 1, 1, 10, 5), dt.datetime(2026, 1, 1, 10, 50), dt.datetime(2026, 1, 1, 11, 59)]
    for t in at:                                   # one file, so one micro-batch, per row
        spark.createDataFrame([(t, "a")], "t timestamp_ntz, k string").write.mode("append").parquet(src)
    stream = spark.readStream.schema("t timestamp_ntz, k string").option("maxFilesPerTrigger", 1).parquet(src)
    root = windows.run_to_end(spark, stream, lambda s: windows.windowed_counts(s, "t", "1 hour", ["k"], "2 hours"),
                              "t", "bounded")
    got = sorted((r["window_start"].hour, r["k"], r["n"]) for r in spark.read.parquet(root + "/out").collect())
    assert got == [(10, "a", 2), (11, "a", 1)]
