"""Golden cases 4, 5, 6: SCD2 in one merge, recovery, row policy and authorized view."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import govern, scd2, versions
from tidemark.session import scratch_dir

DAY1 = [(1, "Alice", "Tbilisi", "SILVER"), (2, "Bob", "Batumi", "GOLD"), (3, "Carol", "Kutaisi", "SILVER"),
        (4, "Dave", "Rustavi", "BRONZE")]
DAY2 = [(1, "Alice", "Tbilisi", "SILVER"), (2, "Bob", "Batumi", "PLATINUM"), (3, "Carol", "Batumi", "SILVER"),
        (5, "Eve", "Gori", "GOLD")]
SCHEMA = "customer_id bigint, name string, city string, tier string"
ATTRS = ["name", "city", "tier"]


@pytest.fixture(scope="module")
def dim(spark):
    d1 = scd2.scd2_init(spark.createDataFrame(DAY1, SCHEMA), "customer_id", ATTRS, dt.date(2026, 1, 1))
    return scd2.scd2_merge(d1, spark.createDataFrame(DAY2, SCHEMA), "customer_id", ATTRS, dt.date(2026, 1, 2))


def test_scd2_rows(dim):
    rows = sorted((r["customer_id"], r["tier"], r["city"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"])
                  for r in dim.collect())
    assert rows == sorted([
        (1, "SILVER", "Tbilisi", "2026-01-01", "9999-12-31", True),
        (2, "GOLD", "Batumi", "2026-01-01", "2026-01-02", False),
        (2, "PLATINUM", "Batumi", "2026-01-02", "9999-12-31", True),
        (3, "SILVER", "Kutaisi", "2026-01-01", "2026-01-02", False),
        (3, "SILVER", "Batumi", "2026-01-02", "9999-12-31", True),
        (4, "BRONZE", "Rustavi", "2026-01-01", "9999-12-31", True),
        (5, "GOLD", "Gori", "2026-01-02", "9999-12-31", True)])


def test_one_current_version_and_no_overlap(dim):
    cur = dim.filter("is_current").groupBy("customer_id").count().filter("count > 1").count()
    assert cur == 0
    bad = dim.filter(F.col("valid_from") >= F.col("valid_to")).count()
    assert bad == 0


def test_reapply_is_noop(spark, dim):
    again = scd2.scd2_merge(dim, spark.createDataFrame(DAY2, SCHEMA), "customer_id", ATTRS, dt.date(2026, 1, 2))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, dim.collect()))


def test_null_attribute_is_a_change(spark, dim):
    nulled = scd2.scd2_merge(dim, spark.createDataFrame([(1, "Alice", None, "SILVER")], SCHEMA),
                             "customer_id", ATTRS, dt.date(2026, 1, 3))
    assert nulled.filter("customer_id = 1").count() == 2


def test_close_missing_option(spark, dim):
    closed = scd2.scd2_merge(dim, spark.createDataFrame(DAY2, SCHEMA), "customer_id", ATTRS, dt.date(2026, 1, 3),
                             close_missing=True)
    assert closed.filter("customer_id = 4 AND is_current").count() == 0


def test_as_of_and_tiers(dim):
    assert scd2.as_of(dim, dt.date(2026, 1, 1)).count() == 4
    got = {r["tier"]: r["n"] for r in scd2.tier_summary(dim, 3).collect()}
    assert got == {"GOLD": 1, "PLATINUM": 1}


def test_recovery(spark, dim):
    root = scratch_dir(spark, "recovery")
    vt = versions.VersionedTable(spark, root + "/dim")
    vt.commit(dim, committed_at=1_000)
    snap = vt.snapshot(root + "/snap", committed_at=1_500)
    vt.delete(F.col("customer_id") == 2, committed_at=2_000)
    assert vt.read().count() == 5
    assert vt.read_as_of(1_700).count() == 7
    with pytest.raises(versions.ReadOnlyTable):
        snap.commit(dim)
    vt.restore(snap, F.col("customer_id") == 2, committed_at=3_000)
    assert vt.read().count() == 7
    vt.rollback(2, committed_at=4_000)
    assert vt.read().count() == 5


def test_row_policy_and_view(dim):
    pol = [("analyst", "city = 'Batumi'"), ("owner", "TRUE")]
    assert govern.apply_row_policy(dim, pol, "analyst").count() == 3
    assert govern.apply_row_policy(dim, pol, "owner").count() == 7
    assert govern.apply_row_policy(dim, pol, "nobody").count() == 0
    assert govern.apply_row_policy(dim, [], "nobody").count() == 7
    view = govern.governed_view(dim, ["customer_id", "name", "tier"], "is_current", pol, "analyst")
    assert sorted(r["name"] for r in view.collect()) == ["Bob", "Carol"]


def test_column_policy(dim):
    with pytest.raises(govern.AccessDenied):
        govern.apply_column_policy(dim, {"name": "pii"}, {}, "analyst", mode="deny")
    masked = govern.apply_column_policy(dim, {"name": "pii"}, {"owner": {"pii"}}, "analyst")
    assert "Alice" not in {r["name"] for r in masked.collect()}
    assert "Alice" in {r["name"] for r in govern.apply_column_policy(dim, {"name": "pii"}, {"owner": {"pii"}}, "owner").collect()}


def test_publish_summary_and_empty_gate(spark, dim):
    from tidemark.operators.gates import GateFailed
    root = scratch_dir(spark, "summary")
    path = scd2.publish_summary(dim, root + "/s")
    got = {r["tier"]: r["customers"] for r in spark.read.parquet(path).collect()}
    assert got == {"SILVER": 2, "PLATINUM": 1, "BRONZE": 1, "GOLD": 1}
    with pytest.raises(GateFailed):
        scd2.publish_summary(dim.filter(F.lit(False)), root + "/empty")


def test_gate_helpers(spark, dim):
    from tidemark.operators import gates
    cur = dim.filter("is_current")
    assert gates.gate_volume(cur, 1, 10).first()["passed"]
    assert gates.gate_unique(cur, "customer_id").first()["passed"]
    assert not gates.gate_unique(dim, "customer_id").first()["passed"]
    assert not gates.gate_valid(cur, {"platinum": "tier = 'PLATINUM'"}).first()["passed"]


def test_scd2_publish_partitioned_and_idempotent(spark):
    from tidemark.sources import files
    path = scratch_dir(spark, "scd2-pub") + "/dim"
    d1 = spark.createDataFrame(DAY1, SCHEMA)
    d2 = spark.createDataFrame(DAY2, SCHEMA)
    scd2.scd2_publish(path, d1, "customer_id", ATTRS, dt.date(2026, 1, 1))
    once = scd2.scd2_publish(path, d2, "customer_id", ATTRS, dt.date(2026, 1, 2))
    rows = sorted(map(tuple, once.collect()))
    assert len(rows) == 7
    assert files.list_partition_values(spark, path, "valid_to") == ["2026-01-02", "9999-12-31"]
    twice = scd2.scd2_publish(path, d2, "customer_id", ATTRS, dt.date(2026, 1, 2))
    assert sorted(map(tuple, twice.collect())) == rows


def test_mv_refresh_equals_recompute(spark, dim):
    d1 = scd2.scd2_init(spark.createDataFrame(DAY1, SCHEMA), "customer_id", ATTRS, dt.date(2026, 1, 1))
    added = dim.filter(F.col("valid_from") == F.lit(dt.date(2026, 1, 2)))
    got = sorted(map(tuple, scd2.refresh_tier_counts(scd2.tier_counts(d1), added).collect()))
    assert got == sorted(map(tuple, scd2.tier_counts(dim).collect()))
    # with a delete: Bob's versions removed, first_seen re-derived for touched tiers
    removed = dim.filter("customer_id = 2")
    after = dim.filter("customer_id != 2")
    got = sorted(map(tuple, scd2.refresh_tier_counts(scd2.tier_counts(dim), after.limit(0), removed, after).collect()))
    assert got == sorted(map(tuple, scd2.tier_counts(after).collect()))


def test_policy_table_semi_join(spark, dim):
    pol = spark.createDataFrame([("analyst", "Batumi"), ("analyst", "Gori"), ("other", "Tbilisi")],
                                "principal string, value string")
    got = govern.apply_policy_table(dim, pol, "analyst", "city")
    assert sorted(r["name"] for r in got.collect()) == ["Bob", "Bob", "Carol", "Eve"]


def test_sql_functions_match_column_functions(spark, dim):
    from tidemark.functions.hashing import u01
    scd2.register_sql_functions(spark)
    a = sorted(map(tuple, spark.sql("SELECT tier, tier_rank(tier) AS r FROM {d}", d=dim).collect()))
    b = sorted(map(tuple, dim.select("tier", scd2.tier_rank("tier").alias("r")).collect()))
    assert a == b
    x = spark.range(50).select(F.expr("u01(id, 'cust')").alias("s"), u01(F.col("id"), "cust").alias("c"))
    assert x.filter("s != c").count() == 0


def test_snapshot_expiry_and_clone_is_writable(spark, dim):
    root = scratch_dir(spark, "expiry")
    vt = versions.VersionedTable(spark, root + "/t")
    vt.commit(dim, committed_at=1_000)
    snap = vt.snapshot(root + "/snap", expire_after_micros=500, committed_at=2_000)
    assert snap.read(now_micros=2_400).count() == 7
    with pytest.raises(versions.ReadOnlyTable):
        snap.read(now_micros=2_600)
    clone = vt.clone(root + "/clone", committed_at=3_000)
    clone.commit(dim.filter("customer_id = 1"), mode="append", committed_at=4_000)
    assert clone.read().count() == 8 and vt.read().count() == 7


def test_merge_scoped_updates_inserts_and_deletes_only_in_scope(spark):
    from tidemark.operators import merge
    target = spark.createDataFrame([("2026-08-01", "GE", 1), ("2026-08-02", "GE", 2), ("2026-08-02", "DE", 3),
                                    ("2026-08-03", "US", 4)], "d string, c string, n int")
    source = spark.createDataFrame([("2026-08-02", "GE", 20), ("2026-08-02", "TR", 5)], "d string, c string, n int")
    out = merge.merge_scoped(target, source, F.col("d") == "2026-08-02")
    assert sorted(map(tuple, out.collect())) == [("2026-08-01", "GE", 1), ("2026-08-02", "GE", 20),
                                                 ("2026-08-02", "TR", 5), ("2026-08-03", "US", 4)]
