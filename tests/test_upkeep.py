"""Late batches, views under retractions, scoped merges and replayed change feeds, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history, merge
from tidemark.operators.history import Dimension
from tidemark.operators.views import View
from tidemark.session import ensure_conf, scratch_dir
from tidemark.sources import files

DIM = Dimension.of(("k", "k2"), ("a", "b"))
SCHEMA = "k bigint, k2 string, a string, b int"
OPEN = dt.date(9999, 12, 31)


def day(n):
    return dt.date(2026, 1, n)


class Model:
    """What each date's batch said, replayed from scratch: versions per key by brute force."""

    def __init__(self):
        self.said = {}                          # key -> {date: state or None}, what was told
        self.pins = {}                          # key -> dates at which a version starts for good

    def versions(self):
        out = set()
        for key, told in self.said.items():
            events, state = [], None
            for d in sorted(told):
                if d in self.pins.get(key, ()) or told[d] != state:
                    events.append((d, told[d]))
                state = told[d]
            for i, (d, s) in enumerate(events):
                if s is not None:
                    out.add((*key, *s, d, events[i + 1][0] if i + 1 < len(events) else OPEN))
        return out

    def apply(self, d, batch, close_missing):
        alive = {v[:2] for v in self.versions() if v[4] < d <= v[5]}
        for key, told in self.said.items():     # the date is told anew
            told.pop(d, None)
            self.pins[key].discard(d)
        for key, state in batch.items():
            self.said.setdefault(key, {})[d] = state
        if close_missing:
            for key in alive - set(batch):
                self.said[key][d] = None
        # versions that are there now keep their start whatever is told later
        now = self.versions()
        self.pins = {key: set() for key in self.said}
        for v in now:
            self.pins.setdefault(v[:2], set()).add(v[4])
        # a telling that repeated what held is no event and is not remembered
        ends = {(v[:2], v[5]) for v in now}
        self.said = {key: {x: s for x, s in told.items() if x in self.pins.get(key, ()) or (s is None and (key, x) in ends)}
                     for key, told in self.said.items()}


@pytest.mark.parametrize("seed", range(2))
def test_batches_in_any_order_equal_brute_force(spark, seed):
    ensure_conf(spark)
    rng = random.Random(seed)
    path, model = scratch_dir(spark, "late") + "/dim", Model()
    keys = [(1, "x"), (1, "y"), (2, None), (None, "x"), (3, "#")]
    for step in range(5):
        d = day(1) if step == 0 else day(rng.randint(1, 6))
        batch = {k: (rng.choice(["p", "q", None]), rng.choice([1, None])) for k in keys if rng.random() < 0.7}
        whole = rng.random() < 0.3
        rows = [(*k, *s) for k, s in batch.items()]
        frame = spark.createDataFrame(rows, SCHEMA)
        before = {tuple(r)[1:] for r in files.external_parquet(spark, path).select(*DIM.columns).collect()} if step else set()
        done = history.apply_batch(path, frame, DIM, d, close_missing=whole)
        model.apply(d, batch, whole and step > 0)
        got = [tuple(r) for r in done.table.collect()]
        assert len(got) == len(set(got))
        assert {(*g[1:5], g[6], g[7]) for g in got} == model.versions(), (seed, step)
        assert all(g[8] == (g[7] == OPEN) for g in got)
        after = {g[1:] for g in got}
        assert {tuple(r)[1:] for r in done.added.collect()} == after - before
        assert {tuple(r)[1:] for r in done.removed.collect()} == before - after


def test_a_batch_once_more_writes_nothing(spark):
    ensure_conf(spark)
    path = scratch_dir(spark, "again") + "/dim"
    one = spark.createDataFrame([(1, "x", "p", 1), (2, "x", "q", 1)], SCHEMA)
    two = spark.createDataFrame([(1, "x", "r", 1)], SCHEMA)
    history.apply_batch(path, one, DIM, day(1))
    first = history.apply_batch(path, two, DIM, day(3))
    assert first.partitions == ["2026-01-03", "9999-12-31"]
    stamp = files.list_files(spark, path + "/valid_to=9999-12-31")
    again = history.apply_batch(path, two, DIM, day(3))
    assert again.partitions == [] and files.list_files(spark, path + "/valid_to=9999-12-31") == stamp


def test_late_batch_leaves_other_partitions_and_surrogate_keys(spark):
    ensure_conf(spark)
    path = scratch_dir(spark, "late-parts") + "/dim"
    for d, rows in ((1, [(1, "x", "p", 1), (2, "x", "q", 1)]), (5, [(1, "x", "r", 1)]), (9, [(1, "x", "s", 1), (2, "x", "t", 1)])):
        history.apply_batch(path, spark.createDataFrame(rows, SCHEMA), DIM, day(d))
    sks = {r["sk"] for r in files.external_parquet(spark, path).collect()}
    kept = files.list_files(spark, path + "/valid_to=2026-01-09")
    late = history.apply_batch(path, spark.createDataFrame([(1, "x", "z", 1)], SCHEMA), DIM, day(3))
    assert late.partitions == ["2026-01-03", "2026-01-05"]
    assert files.list_files(spark, path + "/valid_to=2026-01-09") == kept
    spans = sorted((r["a"], str(r["valid_from"])[-2:], str(r["valid_to"])[-2:]) for r in late.table.where("k = 1").collect())
    assert spans == [("p", "01", "03"), ("r", "05", "09"), ("s", "09", "31"), ("z", "03", "05")]
    assert sks < {r["sk"] for r in late.table.collect()}


def test_empty_batch(spark):
    ensure_conf(spark)
    path = scratch_dir(spark, "empty") + "/dim"
    history.apply_batch(path, spark.createDataFrame([(1, "x", "p", 1)], SCHEMA), DIM, day(1))
    nothing = spark.createDataFrame([], SCHEMA)
    assert history.apply_batch(path, nothing, DIM, day(2)).partitions == []
    closed = history.apply_batch(path, nothing, DIM, day(2), close_missing=True)
    assert [str(r["valid_to"]) for r in closed.table.collect()] == ["2026-01-02"]


# ------------------------------------------------------------------------- views
VIEW = View(groups=("g", "h"), sums={"total": "v"}, minima={"lo": "v"}, maxima={"hi": "w"})


@pytest.mark.parametrize("seed", range(2))
def test_view_from_changes_equals_recompute(spark, seed):
    rng = random.Random(seed)
    draw = lambda: (rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.randint(0, 20), rng.choice([None, rng.randint(0, 9)]))
    schema = "g string, h int, v bigint, w bigint"
    rows = [draw() for _ in range(30)]
    state = spark.createDataFrame([tuple(r) for r in VIEW.full(spark.createDataFrame(rows, schema)).collect()],
                                  "g string, h int, n bigint, total bigint, lo bigint, hi bigint")
    for _ in range(2):
        removed = [rows.pop(rng.randrange(len(rows))) for _ in range(rng.randint(0, 25))]
        added = [draw() for _ in range(rng.randint(0, 6))]
        rows += added
        base = spark.createDataFrame(rows, schema)
        state = VIEW.refresh(state, spark.createDataFrame(added, schema), spark.createDataFrame(removed, schema), base)
        got = sorted(map(repr, (tuple(r) for r in state.collect())))
        assert got == sorted(map(repr, (tuple(r) for r in VIEW.full(base).collect())))


def test_view_needs_no_table_unless_a_bound_goes(spark):
    schema = "g string, h int, v bigint, w bigint"
    old = [("a", 1, 3, 5), ("a", 1, 7, 9), ("a", 1, 5, 6)]
    state = VIEW.full(spark.createDataFrame(old, schema))
    out = VIEW.refresh(state, spark.createDataFrame([("a", 1, 1, 2), ("b", 1, 4, 4)], schema),
                       spark.createDataFrame([("a", 1, 5, 6)], schema), base=None)
    assert sorted(map(tuple, out.collect())) == [("a", 1, 3, 11, 1, 9), ("b", 1, 1, 4, 4, 4)]
    swapped = VIEW.refresh(state, spark.createDataFrame([("a", 1, 3, 9)], schema),
                           spark.createDataFrame([("a", 1, 3, 5)], schema), base=None)
    assert [tuple(r) for r in swapped.collect()] == [("a", 1, 3, 15, 3, 9)]
    with pytest.raises(ValueError):
        VIEW.refresh(state, spark.createDataFrame([], schema), spark.createDataFrame([("a", 1, 3, 5)], schema), base=None)


# ------------------------------------------------------------------------- merge
def table(spark, rows):
    ensure_conf(spark)
    path = scratch_dir(spark, "merge-test") + "/t"
    spark.createDataFrame(rows, "d string, c string, n int").write.partitionBy("d").parquet(path)
    return path


def content(spark, path):
    return sorted(map(repr, (tuple(r) for r in files.external_parquet(spark, path, schema="d string, c string, n int").select("d", "c", "n").collect())))


def test_merge_touches_only_what_changes(spark):
    path = table(spark, [("01", "GE", 1), ("02", "GE", 2), ("02", "DE", 3), ("02", None, 9), ("03", "US", 4), ("04", "GE", 5)])
    kept = {d: files.list_files(spark, "%s/d=%s" % (path, d)) for d in ("01", "03", "04")}
    source = spark.createDataFrame([("02", "GE", 20), ("02", "TR", 5), ("03", "US", 4), ("02", None, 9)], "d string, c string, n int")
    counts = merge.merge_table(path, source, ["d", "c"], "d", F.col("d").isin("02", "03"))
    assert counts == {"insert": 1, "update": 1, "delete": 1, "keep": 2}
    assert content(spark, path) == sorted(map(repr, [("01", "GE", 1), ("02", "GE", 20), ("02", "TR", 5), ("02", None, 9),
                                                     ("03", "US", 4), ("04", "GE", 5)]))
    assert {d: files.list_files(spark, "%s/d=%s" % (path, d)) for d in ("01", "03", "04")} == kept


def test_merge_moves_a_row_between_partitions_and_refuses_repeated_keys(spark):
    path = table(spark, [("a", "GE", 1), ("a", "DE", 2), ("b", "US", 3)])
    source = spark.createDataFrame([("b", "GE", 1)], "d string, c string, n int")
    counts = merge.merge_table(path, source, ["c"], "d", F.lit(False))
    assert counts == {"insert": 0, "update": 1, "delete": 0, "keep": 0}
    assert content(spark, path) == sorted(map(repr, [("a", "DE", 2), ("b", "GE", 1), ("b", "US", 3)]))
    with pytest.raises(merge.MergeError):
        merge.merge_table(path, source.union(source), ["c"], "d", F.lit(False))


def test_merge_that_empties_a_partition(spark):
    path = table(spark, [("a", "GE", 1), ("b", "US", 3)])
    source = spark.createDataFrame([], "d string, c string, n int")
    assert merge.merge_table(path, source, ["d", "c"], "d", F.col("d") == "a")["delete"] == 1
    assert content(spark, path) == [repr(("b", "US", 3))]


# ------------------------------------------------------------------- change feed
def test_changes_again_and_out_of_order_are_no_ops(spark):
    state = merge.cdc_state(spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "k int, v string"))
    schema = "k int, seq bigint, op string, v string"
    feed = [(1, 5, "U", "new"), (2, 6, "D", "old"), (4, 7, "I", "in"), (5, 8, None, "in"), (1, 3, "U", "stale"), (6, None, "I", "x")]
    one = merge.apply_changes(state, spark.createDataFrame(feed, schema), ["k"], "seq").cache()
    want = [(1, "new"), (3, "old"), (4, "in"), (5, "in")]
    assert sorted(map(tuple, merge.visible(one).collect())) == want
    replay = [(1, 4, "U", "stale"), (2, 2, "U", "back"), (4, 7, "I", "in"), (2, 6, "D", "old")]
    two = merge.apply_changes(one, spark.createDataFrame(replay, schema), ["k"], "seq").cache()
    assert sorted(map(tuple, merge.visible(two).collect())) == want
    three = merge.apply_changes(two, spark.createDataFrame([(2, 9, "I", "again")], schema), ["k"], "seq")
    assert sorted(map(tuple, merge.visible(three).collect())) == [(1, "new"), (2, "again"), (3, "old"), (4, "in"), (5, "in")]
    gone = merge.apply_changes(two, spark.createDataFrame([], schema), ["k"], "seq", forget_before=100)
    assert gone.where("is_deleted").count() == 0 and merge.visible(gone).count() == 4
