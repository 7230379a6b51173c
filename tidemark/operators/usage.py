"""Usage, cost and alerting reports over job,
billing and storage metadata (ordinary DataFrames with those schemas).

Nested arrays are handled with higher-order functions inside the row (``exists``,
``filter``, ``aggregate``) - no correlated subquery, no explode + re-group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import snippet

MB = float(1024 ** 2)
GB = float(1024 ** 3)
TB = float(1024 ** 4)
# On-demand price per TiB and the free tier used by the reports.
USD_PER_TIB = 6.25
FREE_TIER_TIB = 1.0


def has_label(labels: Column | str, key: str) -> Column:
    """EXISTS (SELECT 1 FROM UNNEST(labels) WHERE key = k)."""
    arr = F.col(labels) if isinstance(labels, str) else labels
    return F.coalesce(F.exists(arr, lambda x: F.coalesce(x["key"] == F.lit(key), F.lit(False))), F.lit(False))


def label_value(labels: Column | str, key: str) -> Column:
    """(SELECT value FROM UNNEST(labels) WHERE key = k) - NULL when absent."""
    arr = F.col(labels) if isinstance(labels, str) else labels
    return F.try_element_at(F.filter(arr, lambda x: x["key"] == F.lit(key)), F.lit(1))["value"]


def sum_nested(arr: Column | str, field: str, pred=None, acc_type: str = "decimal(18,7)") -> Column:
    """(SELECT IFNULL(SUM(c.field), 0) FROM UNNEST(arr) c WHERE pred), exact decimals.
    NULL elements are skipped; a NULL array sums to 0."""
    a = F.col(arr) if isinstance(arr, str) else arr
    if pred is not None:
        a = F.filter(a, pred)
    total = F.aggregate(a, F.lit(0).cast(acc_type),
                        lambda acc, x: (acc + F.coalesce(x[field], F.lit(0))).cast(acc_type))
    return F.coalesce(total, F.lit(0).cast(acc_type))


def done_queries(jobs: DataFrame) -> DataFrame:
    return jobs.filter((F.col("job_type") == "QUERY") & (F.col("state") == "DONE"))


def top_jobs(jobs: DataFrame, n: int = 10) -> DataFrame:
    """Q11: the n most expensive queries (distributed top-N, total order)."""
    j = done_queries(jobs).filter(F.col("total_bytes_billed") > 0)
    out = j.select(
        F.date_format("creation_time", "MM-dd HH:mm").alias("run_at"),
        F.round(F.col("total_bytes_billed") / MB, 1).alias("mb_billed"),
        F.round(F.col("total_bytes_billed") / TB * USD_PER_TIB, 4).alias("usd_on_demand"),
        "total_slot_ms", "cache_hit", snippet("query", 60).alias("query_start"),
        "total_bytes_billed", "creation_time")
    return (out.orderBy(F.col("total_bytes_billed").desc(), F.col("creation_time"), F.col("query_start"))
            .limit(n).drop("total_bytes_billed", "creation_time"))


def usage_total(jobs: DataFrame) -> DataFrame:
    """Q12: totals against the free tier."""
    j = done_queries(jobs)
    return j.agg(F.count(F.lit(1)).alias("queries"),
                 F.round(F.sum("total_bytes_billed") / GB, 2).alias("gib_billed"),
                 F.round(F.sum("total_bytes_billed") / (TB * FREE_TIER_TIB) * 100, 2).alias("pct_of_free_tier"),
                 F.round(F.sum("total_slot_ms") / 1000 / 3600, 2).alias("slot_hours"))


def cost_ratio(jobs: DataFrame, min_bytes: int = 100_000_000, n: int = 6) -> DataFrame:
    """Slot time per MB billed, zero-guarded, top n."""
    j = done_queries(jobs).filter(F.col("total_bytes_billed") > min_bytes)
    ratio = F.col("total_slot_ms") / F.nullif(F.col("total_bytes_billed") / MB, F.lit(0.0))
    out = j.select(snippet("query", 45).alias("q"), F.round(F.col("total_bytes_billed") / MB).alias("mb_billed"),
                   F.round(F.col("total_slot_ms") / 1000).alias("slot_sec"), F.round(ratio).alias("slot_ms_per_mb"))
    return out.orderBy(F.col("slot_ms_per_mb").desc(), F.col("q")).limit(n)


def storage_report(storage: DataFrame, schema: str) -> DataFrame:
    """Q14: logical vs physical, long-term, compression ratio."""
    s = storage.filter(F.col("table_schema") == schema)
    return s.select("table_name",
                    F.round(F.col("active_logical_bytes") / MB, 1).alias("active_logical_mb"),
                    F.round(F.col("long_term_logical_bytes") / MB, 1).alias("longterm_mb"),
                    F.round(F.col("total_physical_bytes") / MB, 1).alias("physical_mb"),
                    F.round(F.col("total_logical_bytes") / F.nullif(F.col("total_physical_bytes"), F.lit(0)), 2)
                    .alias("compression_x"))


def chargeback(jobs: DataFrame, key: str = "pipeline") -> DataFrame:
    """Q17 / A10: cost per label value (any label key)."""
    j = done_queries(jobs).filter(has_label("labels", key))
    return (j.groupBy(label_value("labels", key).alias(key))
            .agg(F.count(F.lit(1)).alias("jobs"),
                 F.round(F.sum("total_bytes_billed") / MB, 1).alias("mb_billed"),
                 F.round(F.sum("total_bytes_billed") / TB * USD_PER_TIB, 6).alias("usd_on_demand"),
                 F.sum("total_slot_ms").alias("slot_ms")))


def spend_by_service(billing: DataFrame) -> DataFrame:
    """Q18: gross, promotional credits and net per service; HAVING gross > 0.

    Money is summed as decimals (exact, order independent)."""
    promo = sum_nested("credits", "amount", lambda c: c["type"] == F.lit("PROMOTION"))
    all_credits = sum_nested("credits", "amount")
    b = billing.select(F.col("service.description").alias("service"),
                       F.col("cost").cast("decimal(18,5)").alias("cost"),
                       promo.alias("promo"), all_credits.alias("credits_total"))
    g = b.groupBy("service").agg(F.round(F.sum("cost"), 4).alias("gross"),
                                 F.round(F.sum("promo"), 4).alias("trial"),
                                 F.round(F.sum("cost") + F.sum("credits_total"), 4).alias("net"))
    return g.filter(F.col("gross") > 0).select(
        "service", F.col("gross").cast("double").alias("gross_usd"),
        F.col("trial").cast("double").alias("trial_credits"), F.col("net").cast("double").alias("net_usd"))


def spend_by_day(billing: DataFrame) -> DataFrame:
    """Gross spend per calendar day; HAVING gross > 0."""
    g = billing.groupBy(F.to_date("usage_start_time").alias("day")).agg(
        F.round(F.sum(F.col("cost").cast("decimal(18,5)")), 4).alias("gross"))
    return g.filter(F.col("gross") > 0).select("day", F.col("gross").cast("double").alias("gross_usd"))


def threshold_alerts(events: DataFrame, ts: str, value: str, threshold: float, window: str = "5 minutes") -> DataFrame:
    """Q20: events above a threshold counted per window; alert where the count > 0."""
    big = events.filter(F.col(value) > threshold)
    g = big.groupBy(F.window(F.col(ts), window).alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return g.filter(F.col("events") > 0).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "events", F.lit(True).alias("alert"))


def skew_report(df: DataFrame, key: str, alert_ratio: float = 3.0) -> DataFrame:
    """Q15: work per key - max / avg - alert above ``alert_ratio``."""
    c = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    a = c.agg(F.count(F.lit(1)).alias("keys"), F.max("_n").alias("max_rows"), F.avg("_n").alias("avg_rows"))
    ratio = F.col("max_rows") / F.col("avg_rows")
    return a.select("keys", "max_rows", F.round("avg_rows", 4).alias("avg_rows"),
                    F.round(ratio, 4).alias("max_over_avg"), (ratio > alert_ratio).alias("alert"))


def by_label(jobs: DataFrame, key: str, measures: dict[str, Column]) -> DataFrame:
    """A10: group by the value of one label (rows without the label are skipped)."""
    j = jobs.filter(has_label("labels", key))
    return j.groupBy(label_value("labels", key).alias(key)).agg(*[m.alias(n) for n, m in measures.items()])
