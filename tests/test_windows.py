"""Golden case 1: global, fixed, sliding and session windows over page views."""

import datetime as dt

import pytest

from tidemark.streaming import windows

BASE = dt.datetime(2024, 1, 1)
EVENTS = [("alice", 0), ("alice", 5), ("alice", 12), ("bob", 3), ("bob", 8), ("alice", 100), ("alice", 104),
          ("bob", 102)]


@pytest.fixture(scope="module")
def views(spark):
    rows = [(u, BASE + dt.timedelta(seconds=s)) for u, s in EVENTS]
    return spark.createDataFrame(rows, "user string, ts timestamp_ntz")


def _secs(ts):
    return int((ts - BASE).total_seconds())


def test_global(views):
    got = {r["user"]: r["n"] for r in windows.per_key(views, ["user"]).collect()}
    assert got == {"alice": 5, "bob": 3}


def test_fixed(views):
    got = {(r["user"], _secs(r["window_start"]), _secs(r["window_end"])): r["n"]
           for r in windows.tumbling(views, "ts", "60 seconds", ["user"]).collect()}
    assert got == {("alice", 0, 60): 3, ("alice", 60, 120): 2, ("bob", 0, 60): 2, ("bob", 60, 120): 1}


def test_sliding_each_event_in_two_windows(views):
    rows = windows.sliding(views, "ts", "60 seconds", "30 seconds", ["user"]).collect()
    assert sum(r["n"] for r in rows) == 2 * len(EVENTS)
    got = {(r["user"], _secs(r["window_start"])): r["n"] for r in rows}
    assert got[("alice", -30)] == 3 and got[("alice", 0)] == 3 and got[("bob", 90)] == 1


def test_session(views):
    got = sorted((r["user"], _secs(r["window_start"]), _secs(r["window_end"]), r["n"])
                 for r in windows.session(views, "ts", "30 seconds", ["user"]).collect())
    assert got == [("alice", 0, 42, 3), ("alice", 100, 134, 2), ("bob", 3, 38, 2), ("bob", 102, 132, 1)]
