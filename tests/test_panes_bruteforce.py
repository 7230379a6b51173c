"""Panes (T8-T12) against a brute-force replay of the same rules, batch by batch,
on a small fixture with two keys, three windows and late arrivals."""

import datetime as dt
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_dir
from tidemark.streaming.panes import paned_counts
from tidemark.streaming.windows import run_available

BASE = dt.datetime(2024, 1, 1)
SIZE, EARLY_N, LATENESS = 60, 2, 60


def fixture_batches():
    rnd = random.Random(7)
    batches, clock = [], 0
    for _ in range(16):
        clock += rnd.randint(5, 25)
        rows = []
        for _ in range(rnd.randint(1, 3)):
            late = rnd.random() < 0.3
            ts = max(0, clock - (rnd.randint(20, 90) if late else rnd.randint(0, 5)))
            rows.append((rnd.choice(["a", "b"]), ts))
        batches.append(rows)
    return batches


def simulate(batches, accumulating):
    state, out, wm = {}, set(), -10 ** 15   # Spark starts at epoch 0, long before the fixture
    lat, end_of = LATENESS * 1000, lambda ws: (ws + SIZE) * 1000

    def call(k, ws, n_rows):
        end = end_of(ws)
        total, since, pane, fired, _ = state.get((k, ws), (0, 0, 0, False, None))
        exists = (k, ws) in state
        if exists and not fired and wm >= end - lat:
            out.add((k, ws, "pane", "ON_TIME", pane, total if accumulating else since))
            pane, since, fired = pane + 1, 0, True
        if wm >= end:
            for _ in range(n_rows):
                out.add((k, ws, "late", "DROPPED", None, 1))
            if exists:
                out.add((k, ws, "closed", "CLOSED", pane - 1, total))
            state.pop((k, ws), None)
            return
        for _ in range(n_rows):
            total, since = total + 1, since + 1
            if fired:
                out.add((k, ws, "pane", "LATE", pane, total if accumulating else since))
                pane, since = pane + 1, 0
            elif since >= EARLY_N:
                out.add((k, ws, "pane", "EARLY", pane, total if accumulating else since))
                pane, since = pane + 1, 0
        state[(k, ws)] = (total, since, pane, fired, max(end if fired else end - lat, wm + 1))

    def run_batch(rows):
        nonlocal wm
        groups = defaultdict(int)
        for k, ts in rows:
            groups[(k, ts - ts % SIZE)] += 1
        for (k, ws), n in groups.items():
            call(k, ws, n)
        for key in [key for key, st in list(state.items()) if key not in groups and wm > st[4]]:
            call(key[0], key[1], 0)
        if rows:
            wm = max(wm, max(ts for _, ts in rows) * 1000 - lat)

    for rows in batches:
        before = wm
        run_batch(rows)
    run_batch([])          # the no-data batch after the watermark moved
    return out


@pytest.fixture(scope="module")
def source(spark):
    src = scratch_dir(spark, "panes-bf")
    for rows in fixture_batches():
        spark.createDataFrame([(k, BASE + dt.timedelta(seconds=s)) for k, s in rows], "key string, ts timestamp") \
            .coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    return src


@pytest.mark.parametrize("accumulating", [True, False])
def test_panes_match_bruteforce(spark, source, accumulating):
    stream = spark.readStream.schema("key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(source)
    root = run_available(spark, paned_counts(stream, "key", "ts", SIZE, EARLY_N, LATENESS, accumulating), "panes-bf")
    got = set()
    for r in spark.read.parquet(root + "/out").collect():
        ws = int((r["window_start"] - BASE).total_seconds())
        got.add((r["key"], ws, r["kind"], r["timing"], r["pane_index"], r["value"]))
    assert got == simulate(fixture_batches(), accumulating)


def test_last_accumulating_equals_sum_of_discarding(spark, source):
    totals = {}
    for acc in (True, False):
        stream = spark.readStream.schema("key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(source)
        root = run_available(spark, paned_counts(stream, "key", "ts", SIZE, EARLY_N, LATENESS, acc), "panes-sum")
        panes = spark.read.parquet(root + "/out").filter(F.col("kind") == "pane")
        if acc:
            last = panes.groupBy("key", "window_start").agg(F.max_by("value", "pane_index").alias("v"))
        else:
            last = panes.groupBy("key", "window_start").agg(F.sum("value").alias("v"))
        totals[acc] = {(r["key"], r["window_start"]): r["v"] for r in last.collect()}
    assert totals[True] == totals[False] and totals[True]
