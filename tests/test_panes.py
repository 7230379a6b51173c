"""Golden case 2: early / on-time / late panes (accumulating, discarding, lateness 0)."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_dir
from tidemark.streaming.panes import paned_counts
from tidemark.streaming.windows import run_available

BASE = dt.datetime(2024, 1, 1)
# (key, event second): clicks 5 10, marker 20, clicks 15 25, marker 70, click 30, marker 90, click 40, marker 200
SEQ = [("clicks", 5), ("clicks", 10), ("marker", 20), ("clicks", 15), ("clicks", 25), ("marker", 70),
       ("clicks", 30), ("marker", 90), ("clicks", 40), ("marker", 200)]


def _feed(spark):
    src = scratch_dir(spark, "panes-src")
    for k, s in SEQ:
        spark.createDataFrame([(k, BASE + dt.timedelta(seconds=s), 1)], "key string, ts timestamp, v int") \
            .coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    return src


def _run(spark, src, lateness, accumulating):
    stream = spark.readStream.schema("key string, ts timestamp, v int").option("maxFilesPerTrigger", 1).parquet(src)
    panes = paned_counts(stream, "key", "ts", 60, 2, lateness, accumulating)
    root = run_available(spark, panes, "panes")
    out = spark.read.parquet(root + "/out").filter(F.col("key") == "clicks")
    return sorted((r["kind"], r["timing"], r["pane_index"], r["value"]) for r in out.collect())


@pytest.fixture(scope="module")
def src(spark):
    return _feed(spark)


def test_accumulating_lateness_60(spark, src):
    got = _run(spark, src, 60, True)
    assert [g for g in got if g[0] == "pane"] == sorted([
        ("pane", "EARLY", 0, 2), ("pane", "EARLY", 1, 4), ("pane", "ON_TIME", 2, 4),
        ("pane", "LATE", 3, 5), ("pane", "LATE", 4, 6)])
    # pane info "last": the window closes after pane 4 with a total of 6
    assert [g for g in got if g[0] == "closed"] == [("closed", "CLOSED", 4, 6)]


def test_discarding_lateness_60(spark, src):
    got = _run(spark, src, 60, False)
    assert [g for g in got if g[0] == "pane"] == sorted([
        ("pane", "EARLY", 0, 2), ("pane", "EARLY", 1, 2), ("pane", "ON_TIME", 2, 0),
        ("pane", "LATE", 3, 1), ("pane", "LATE", 4, 1)])


def test_accumulating_lateness_0_drops_late(spark, src):
    got = _run(spark, src, 0, True)
    assert [g for g in got if g[0] == "pane"] == sorted([
        ("pane", "EARLY", 0, 2), ("pane", "EARLY", 1, 4), ("pane", "ON_TIME", 2, 4)])
    assert len([g for g in got if g[0] == "late"]) == 2
