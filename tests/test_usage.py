"""Usage reports on tiny fixtures: nested labels and credits, zero guards, skew."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from tidemark.operators import usage

LABELS = "array<struct<key:string,value:string>>"


def test_labels_and_chargeback(spark):
    jobs = spark.createDataFrame([
        (1, "QUERY", "DONE", 100 * 1024 ** 2, 10, [("pipeline", "orders_etl"), ("owner", "me")]),
        (2, "QUERY", "DONE", 50 * 1024 ** 2, 5, [("pipeline", "orders_etl")]),
        (3, "QUERY", "DONE", 10 * 1024 ** 2, 1, [("owner", "me")]),
        (4, "QUERY", "DONE", 10 * 1024 ** 2, 1, []),
        (5, "LOAD", "DONE", 10 * 1024 ** 2, 1, [("pipeline", "orders_etl")])],
        "job_id int, job_type string, state string, total_bytes_billed bigint, total_slot_ms bigint, labels %s" % LABELS)
    got = {r["job_id"]: (r["p"], r["has"]) for r in jobs.select(
        "job_id", usage.label_value("labels", "pipeline").alias("p"), usage.has_label("labels", "pipeline").alias("has")
    ).collect()}
    assert got[1] == ("orders_etl", True) and got[3] == (None, False) and got[4] == (None, False)
    cb = usage.chargeback(jobs).collect()
    assert len(cb) == 1 and cb[0]["jobs"] == 2 and cb[0]["mb_billed"] == 150.0 and cb[0]["slot_ms"] == 15


def test_credits_and_spend(spark):
    credits = "array<struct<type:string,amount:decimal(18,7)>>"
    bill = spark.createDataFrame([
        (("warehouse",), 1.5, [("PROMOTION", D("-1.0")), ("SUSTAINED_USAGE", D("-0.25"))], dt.datetime(2026, 1, 1, 3)),
        (("warehouse",), 0.5, [], dt.datetime(2026, 1, 2, 3)),
        (("compute",), 0.0, [("PROMOTION", D("0"))], dt.datetime(2026, 1, 2, 4))],
        "service struct<description:string>, cost double, credits %s, usage_start_time timestamp" % credits)
    by_service = {r["service"]: (r["gross_usd"], r["trial_credits"], r["net_usd"]) for r in usage.spend_by_service(bill).collect()}
    assert by_service == {"warehouse": (2.0, -1.0, 0.75)}          # HAVING gross > 0 drops 'compute'
    by_day = sorted((str(r["day"]), r["gross_usd"]) for r in usage.spend_by_day(bill).collect())
    assert by_day == [("2026-01-01", 1.5), ("2026-01-02", 0.5)]


def test_ratio_zero_guard_and_skew(spark):
    from tidemark.operators.relational import safe_ratio
    df = spark.createDataFrame([(10, 2), (10, 0)], "a int, b int")
    assert [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [5.0, None]
    skew = spark.range(100).select(F.when(F.col("id") < 70, F.lit(0)).otherwise(F.col("id")).alias("k"))
    r = usage.skew_report(skew, "k").first()
    assert r["keys"] == 31 and r["max_rows"] == 70 and r["alert"]
