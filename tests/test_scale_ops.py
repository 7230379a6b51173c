"""Skewed joins of every type, stored sketches, measured scans, sized layouts and least squares."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins, model, relational
from tidemark.session import ensure_conf, scratch_dir
from tidemark.sources import files, layout

HOWS = ["inner", "left", "right", "full", "left_semi", "left_anti"]


@pytest.fixture(scope="module")
def skewed(spark):
    fact = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"))
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n"), (4, "d"), (10**9, "z")], "k bigint, l string")
    return fact, dim


@pytest.mark.parametrize("how", HOWS)
def test_salted_joins_equal_the_plain_join(skewed, how):
    fact, dim = skewed
    want = fact.join(dim, "k", how)
    for got in (joins.weighted_salt_join(fact, dim, "k", how, rows_per_task=400),
                joins.skew_join(fact, dim, "k", how, min_share=0.1, max_hot_dim_rows=1, salt_buckets=5)):
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_every_heavy_key_has_its_own_number_of_salts(spark):
    keys = [(k,) for k, n in (("a", 500), ("b", 210), ("c", 90)) for _ in range(n)] + [(None,)] * 700
    fact = spark.createDataFrame(keys, "k string").repartition(6)
    assert joins.heavy_hitters(fact, "k", 100) == {"a": 5, "b": 3}
    j = joins.weighted_salt_join(fact, spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), "k", rows_per_task=100)
    assert j.count() == 710
    # rows alike in every column do not share a salt either
    plan = layout.plan_text(j)
    assert "SPARK_PARTITION_ID" in plan.upper()


def test_sketches_are_made_anew_for_changed_groups_only(spark):
    ensure_conf(spark)
    path = scratch_dir(spark, "sk") + "/s"
    df = spark.range(40000).select((F.col("id") % 4).cast("int").alias("g"), (F.col("id") % 9000).alias("v"))
    relational.keep_sketches(path, df.where("g < 3"), "g", "v")
    kept = {g: files.list_files(spark, "%s/g=%d" % (path, g)) for g in (0, 1)}
    now = relational.keep_sketches(path, df.where("g != 2"), "g", "v", changed=[2, 3])
    assert {g: files.list_files(spark, "%s/g=%d" % (path, g)) for g in (0, 1)} == kept
    assert sorted(r["g"] for r in now.collect()) == [0, 1, 3]
    exact = df.where("g != 2").agg(F.count_distinct("v")).first()[0]
    assert abs(relational.hll_union_estimate(now).first()["approx"] - exact) <= 0.02 * exact


def test_estimate_sends_no_values_to_the_shuffle(spark):
    df = spark.range(1000).select(F.col("id").alias("v"), F.lit(1).alias("g"))
    for q in (relational.distinct_approx(df, "v"), relational.hll_union_estimate(relational.hll_sketches(df, "g", "v"))):
        plan = layout.plan_text(q)
        assert "Expand" not in plan and "hashpartitioning(v" not in plan


# ----------------------------------------------------------------------- layouts
def posts(spark, n=6000):
    return spark.range(n).select(
        F.col("id"), (F.col("id") * 7919 % 50).alias("owner"), F.lit("x" * 20).alias("body"),
        F.date_add(F.lit("2026-01-01").cast("date"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 12).cast("int"))
        .alias("day"))


def test_measured_scan_reads_what_the_predicate_needs(spark):
    ensure_conf(spark)
    root = scratch_dir(spark, "scan")
    df = posts(spark)
    layout.write_partitioned(df, root + "/part", "day")
    layout.write_clustered(df, root + "/clust", ["owner"], file_bytes=30_000)
    whole = layout.measured_scan(files.external_parquet(spark, root + "/part"))
    one = layout.measured_scan(files.external_parquet(spark, root + "/part").where("day = DATE '2026-01-05'"))
    assert whole["rows"] == whole["rows_read"] == 6000 and whole["partitions_read"] == 9
    assert one["partitions_read"] == 1 and one["files_read"] < whole["files_read"]
    assert 0 < one["bytes_read"] < whole["bytes_read"] and one["rows"] == one["rows_read"] < 6000
    owner = layout.measured_scan(spark.read.parquet(root + "/clust").where("owner = 7"))
    assert owner["rows"] == 120 and owner["rows_read"] < 2000           # row groups of other owners are skipped
    joined = spark.read.parquet(root + "/clust").select("owner").join(spark.read.parquet(root + "/part").select("owner", "day"), "owner")
    assert layout.measured_scan(joined.where("owner = 7"))["rows"] == 120 * 120


def test_file_count_follows_size(spark):
    ensure_conf(spark)
    root = scratch_dir(spark, "sized")
    small, large = posts(spark, 500), posts(spark, 6000)
    assert layout.files_for(small, 30_000) < layout.files_for(large, 30_000)
    layout.write_clustered(large, root + "/clust", ["owner"], file_bytes=30_000)
    assert len([f for f in files.list_files(spark, root + "/clust") if f.endswith(".parquet")]) == layout.files_for(large, 30_000)
    # the day with over a third of the rows spans several files, and each covers its own owners
    layout.write_partitioned_clustered(large, root + "/pc", "day", None, ["owner"], file_bytes=30_000)
    got = spark.read.parquet(root + "/pc")
    hot = got.where("day = DATE '2026-01-01'").groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("owner").alias("lo"), F.max("owner").alias("hi")).orderBy("lo").collect()
    assert len(hot) >= 2 and all(a["hi"] <= b["lo"] for a, b in zip(hot, hot[1:]))
    assert got.count() == 6000
    layout.write_partitioned(large, root + "/p", "day", file_bytes=30_000)
    assert len(files.list_files(spark, root + "/p/day=2026-01-01")) >= 2
    empty = layout.write_clustered(small.limit(0), root + "/none", ["owner"])
    assert spark.read.schema(small.schema).parquet(empty).count() == 0


def test_guard_reads_the_scan_not_its_text(spark):
    ensure_conf(spark)
    path = layout.write_partitioned(posts(spark, 300), scratch_dir(spark, "guard") + "/p", "day")
    long = " or ".join("day = DATE '2026-01-%02d'" % (1 + i % 12) for i in range(200))
    assert layout.guarded_read(spark, path, "day", "(%s)" % long).count() == 300
    for refused in ("id > 5", "day = day or 1 = 1", "day is not null", ""):
        with pytest.raises(layout.MissingPartitionFilter):
            layout.guarded_read(spark, path, "day", refused)


# ----------------------------------------------------------------- least squares
def test_least_squares_equals_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1000, 3, (400, 3))
    y = x @ [2.0, -1.0, 0.5] + 7 + rng.normal(0, 1, 400)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows + [(None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None)], "a double, b double, c double, y double")
    fit = model.least_squares(df, ["a", "b", "c"], "y")
    want, *_ = np.linalg.lstsq(np.column_stack([x, np.ones(400)]), y, rcond=None)
    assert fit["n"] == 400
    assert np.allclose([*fit["coefficients"], fit["intercept"]], want, rtol=1e-5)
    ev = model.scores(df.where("y is not null and a is not null"), model.fitted(fit, ["a", "b", "c"]), "y").first()
    assert ev["n"] == 400 and abs(ev["r2"] - fit["r2"]) < 1e-6
    resid = y - np.column_stack([x, np.ones(400)]) @ want
    assert abs(ev["mae"] - np.abs(resid).mean()) < 1e-6


def test_least_squares_without_an_answer(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 1.0), (3.0, 6.0, 5.0)], "a double, b double, y double")
    assert model.least_squares(df, ["a", "b"], "y") is None             # b is twice a
    assert model.least_squares(df.limit(0), ["a"], "y") is None
    groups = model.gram(df.withColumn("g", F.lit("x")), ["a"], "y", by=["g"]).collect()
    assert abs(model.solve(groups[0], 1)["coefficients"][0] - 1.0) < 1e-9


def test_noise_is_bounded_and_repeats(spark):
    a = [r[0] for r in spark.range(500).select(model.noise("id", "s", 5.0)).collect()]
    assert a == [r[0] for r in spark.range(500).select(model.noise("id", "s", 5.0)).collect()]
    assert min(a) >= -5 and max(a) < 5 and abs(sum(a) / 500) < 0.6
