"""Plan assertions: pruning reaches the scan, dedup combines map-side, broadcasts are
size-checked, the per-key latest uses one exchange."""

import datetime as dt
import re

from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.operators.latest import latest_per_key
from tidemark.plans import medallion
from tidemark.plans.lakebuild import build_lake
from tidemark.sources.layout import plan_text


def test_rebuild_scan_is_pruned(spark, sf):
    lake, parts, _ = build_lake(spark, sf)
    silver = spark.read.parquet(lake.silver)
    plan = plan_text(medallion.rebuild_input(silver, [dt.date(1995, 1, 20), dt.date(1995, 1, 22)], "day"))
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and ">= 1995-01-20" in plan
    assert "In(order_date, [1995-01-20,1995-01-22])" in plan
    assert "ReadSchema: struct<order_id:string,country:string,amount:double,updated_at:timestamp,order_date:date>" in plan


def test_latest_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    plan = plan_text(latest_per_key(df, ["k"], ["v"]))
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1
    assert "partial_max" in plan


def test_window_form_uses_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    plan = plan_text(latest_per_key(df, ["k"], ["v"], method="window"))
    assert "WindowGroupLimit" in plan


def test_broadcast_only_when_proven_small(spark):
    small = spark.range(10)
    big = spark.range(100)
    assert joins.has_at_most(small, 10) and not joins.has_at_most(big, 10)
    assert "BroadcastHashJoin" in plan_text(big.join(joins.maybe_broadcast(small, 10), "id"))


import pytest


@pytest.mark.parametrize("max_rows", [1_000_000, 100, 0])   # broadcast all / split + broadcast hot / split + salt
def test_skew_join_equals_plain_join(spark, max_rows):
    fact = spark.range(10000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    dim = fact.distinct().withColumn("label", F.col("k") * 2)
    a = joins.skew_join(fact, dim, "k", min_share=0.1, max_hot_dim_rows=max_rows, salt_buckets=4)
    b = fact.join(dim, "k")
    assert a.count() == b.count() == 10000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_latest_with_map_payload_falls_back_to_window(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2}), (2, 5, {"c": 3})], "k int, v int, m map<string,int>")
    got = sorted((r["k"], r["v"]) for r in latest_per_key(df, ["k"], ["v"]).collect())
    assert got == [(1, 2), (2, 5)]


def test_layout_scan_evidence(spark):
    from tidemark.plans import catalog_misc
    got = {(name, p): (m, w) for name, p, m, w in catalog_misc.layout_scans(spark, "/root/testdata/sf0.01")}
    days, whole = got["part", "A_days"]
    assert days["partitions_read"] == 11 and whole["partitions_read"] == 81         # one partition a day
    assert days["files_read"] < whole["files_read"] and days["bytes_read"] < whole["bytes_read"]
    owner, whole = got["clust", "B_owner"]
    assert owner["files_read"] == whole["files_read"] and owner["rows_read"] < whole["rows_read"] / 5
    # the wrong layout for the question: an owner spread over many day partitions
    assert got["part", "B_owner"][0]["files_read"] == got["part", "B_owner"][1]["files_read"]
    assert got["part", "B_owner"][0]["rows_read"] > owner["rows_read"]
    assert len({m["rows"] for (lay, p), (m, w) in got.items() if p == "B_owner"}) == 1   # same answer everywhere


def test_metadata_count_uses_footers(spark):
    from tidemark.sources.layout import metadata_count
    n, pushed = metadata_count(spark, "/root/testdata/sf0.01/lineitem.parquet")
    assert n == spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").count() and pushed
    n2, pushed2 = metadata_count(spark, "/root/testdata/sf0.01/lineitem.parquet", "l_quantity > 40")
    assert n2 < n and not pushed2
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")   # session settings restored
