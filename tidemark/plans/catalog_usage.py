"""Registered usage / cost / observability queries.

Job metadata is derived from ``orders`` (one job per order: bytes from the price,
labels from priority and status), billing rows from ``lineitem`` (cost from the
extended price, credits from discount and tax), table-storage rows from ``lineitem``
grouped per supplier, freshness metadata from ``orders`` per priority.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import u01
from tidemark.operators import gates, usage
from tidemark.plans.oracle_feed import U
from tidemark.sources.tables import Tables

LABELS_T = "array<struct<key:string,value:string>>"
FRESHNESS_NOW = "2001-08-01 02:00:00"


def jobs_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    n = F.col("o_orderkey")
    lab = u01(n, "lab")
    owner = F.struct(F.lit("owner").alias("key"), F.concat(F.lit("team-"), F.col("o_orderstatus")).alias("value"))
    pipe = F.struct(F.lit("pipeline").alias("key"), F.concat(F.lit("p_"), F.col("o_orderpriority")).alias("value"))
    labels = (F.when(lab < 0.1, F.array().cast(LABELS_T)).when(lab < 0.2, F.array(owner))
              .otherwise(F.array(pipe, owner)))
    query = F.concat(F.lit("/* job "), n.cast("string"), F.lit(" */  SELECT *\n  FROM   orders\tWHERE o_custkey = "),
                     F.col("o_custkey").cast("string"), F.lit("\n  AND status = '"), F.col("o_orderstatus"), F.lit("'"))
    return o.select(
        n.alias("job_id"),
        F.timestamp_add("SECOND", F.floor(u01(n, "jsec") * 86400).cast("int"), F.col("o_orderdate")).alias("creation_time"),
        F.when(u01(n, "jt") < 0.9, "QUERY").otherwise("LOAD").alias("job_type"),
        F.when(u01(n, "st") < 0.95, "DONE").otherwise("RUNNING").alias("state"),
        query.alias("query"),
        (F.round(F.col("o_totalprice") * 100).cast("bigint") * 10).alias("total_bytes_billed"),
        F.pmod(n * 7919, F.lit(100000)).alias("total_slot_ms"),
        (u01(n, "cache") < 0.2).alias("cache_hit"),
        labels.alias("labels"))


def billing_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    dp = F.round(F.col("l_discount") * 100).cast("bigint")
    tp = F.round(F.col("l_tax") * 100).cast("bigint")
    credit = lambda t, pct: F.struct(F.lit(t).alias("type"),
                                     (-(cents * pct) / 10000000.0).cast("decimal(18,7)").alias("amount"))
    service = (F.when(F.col("l_returnflag") == "A", "warehouse").when(F.col("l_returnflag") == "N", "compute")
               .otherwise("storage"))
    uid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return li.select("l_orderkey", "l_linenumber", F.struct(service.alias("description")).alias("service"),
                     (cents / 100000.0).alias("cost"),
                     F.array(credit("PROMOTION", dp), credit("SUSTAINED_USAGE", tp)).alias("credits"),
                     F.timestamp_add("SECOND", F.floor(u01(uid, "use") * 86400).cast("int"),
                                     F.col("l_shipdate")).alias("usage_start_time"))


def storage_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 'table' per (return flag, supplier): the flag names the dataset."""
    li = Tables(spark, sf_dir).lineitem
    g = li.groupBy("l_returnflag", "l_suppkey").agg(
        F.sum("l_quantity").cast("bigint").alias("q"), F.count(F.lit(1)).alias("c"),
        F.sum("l_linenumber").cast("bigint").alias("ln"))
    return g.select(F.concat(F.lit("ds_"), F.col("l_returnflag")).alias("table_schema"),
                    F.concat(F.lit("t_"), F.col("l_suppkey").cast("string")).alias("table_name"),
                    (F.col("q") * 40960).alias("active_logical_bytes"), (F.col("c") * 5120).alias("long_term_logical_bytes"),
                    (F.col("ln") * 10240).alias("total_physical_bytes"),
                    (F.col("q") * 40960 + F.col("c") * 5120).alias("total_logical_bytes"))


def top_n_expensive(spark, sf_dir):
    """Q11 / O2: ten most expensive queries."""
    return usage.top_jobs(jobs_frame(spark, sf_dir), 10)


def usage_total(spark, sf_dir):
    """Q12: totals against the free tier."""
    return usage.usage_total(jobs_frame(spark, sf_dir))


def ratio_per_mb(spark, sf_dir):
    """Slot ms per MB billed, NULLIF-guarded, top 6."""
    return usage.cost_ratio(jobs_frame(spark, sf_dir))


def storage_report(spark, sf_dir):
    """Q14: storage per table in one dataset."""
    return usage.storage_report(storage_frame(spark, sf_dir), "ds_N")


def chargeback(spark, sf_dir):
    """Q17 / A10: cost per pipeline label."""
    return usage.chargeback(jobs_frame(spark, sf_dir), "pipeline")


def label_exists(spark, sf_dir):
    """EXISTS over the labels array."""
    j = jobs_frame(spark, sf_dir)
    return j.select("job_id", usage.has_label("labels", "pipeline").alias("has_pipeline"))


def label_value(spark, sf_dir):
    """Scalar pick of one label value (NULL when absent)."""
    j = jobs_frame(spark, sf_dir)
    return j.select("job_id", usage.label_value("labels", "pipeline").alias("pipeline"),
                    usage.label_value("labels", "owner").alias("owner"))


def nested_credit_sum(spark, sf_dir):
    """Filtered and total sums over the credits array, per billing row."""
    b = billing_frame(spark, sf_dir)
    return b.select("l_orderkey", "l_linenumber",
                    usage.sum_nested("credits", "amount", lambda c: c["type"] == F.lit("PROMOTION"))
                    .cast("double").alias("promo"),
                    usage.sum_nested("credits", "amount").cast("double").alias("all_credits"))


def spend_by_service(spark, sf_dir):
    """Q18: gross, promotional credits, net per service."""
    return usage.spend_by_service(billing_frame(spark, sf_dir))


def spend_by_day(spark, sf_dir):
    """Gross spend per day."""
    return usage.spend_by_day(billing_frame(spark, sf_dir))


def threshold_alerts(spark, sf_dir):
    """Q20: jobs above 100 MB counted per 5-minute window; alert where count > 0."""
    return usage.threshold_alerts(jobs_frame(spark, sf_dir), "creation_time", "total_bytes_billed", 100_000_000)


def skew_report(spark, sf_dir):
    """Q15: work per key of the skewed lineitem key: max / avg and the > 3 alert."""
    li = Tables(spark, sf_dir).lineitem
    k = F.when(F.pmod(F.col("l_orderkey"), F.lit(10)) > 0, F.lit(1).cast("bigint")).otherwise(F.col("l_orderkey"))
    return usage.skew_report(li.select(k.alias("k")), "k")


def freshness_report(spark, sf_dir):
    """Q8: per table, last modified (epoch ms), minutes stale against a 60-minute SLA."""
    o = Tables(spark, sf_dir).orders
    meta = o.groupBy("o_orderpriority").agg(
        (F.unix_millis(F.max("o_orderdate").cast("timestamp")) + 1000 * F.pmod(F.count(F.lit(1)), F.lit(7200)))
        .alias("last_modified_time"))
    meta = meta.select(F.lower(F.regexp_replace("o_orderpriority", "[^A-Za-z0-9]", "_")).alias("table_id"),
                       "last_modified_time")
    return gates.freshness_report(meta, "table_id", "last_modified_time", FRESHNESS_NOW, 60)


QUERIES = {f.__name__: f for f in [
    top_n_expensive, usage_total, ratio_per_mb, storage_report, chargeback, label_exists, label_value,
    nested_credit_sum, spend_by_service, spend_by_day, threshold_alerts, skew_report, freshness_report]}

JOBS_CTE = """WITH jobs AS (
  SELECT o_orderkey AS job_id,
         o_orderdate + to_seconds(CAST(floor(%(jsec)s * 86400) AS BIGINT)) AS creation_time,
         CASE WHEN %(jt)s < 0.9 THEN 'QUERY' ELSE 'LOAD' END AS job_type,
         CASE WHEN %(st)s < 0.95 THEN 'DONE' ELSE 'RUNNING' END AS state,
         '/* job ' || CAST(o_orderkey AS VARCHAR) || ' */  SELECT *' || chr(10) || '  FROM   orders' || chr(9) ||
           'WHERE o_custkey = ' || CAST(o_custkey AS VARCHAR) || chr(10) || '  AND status = ''' || o_orderstatus || '''' AS query,
         CAST(round(o_totalprice * 100) AS BIGINT) * 10 AS total_bytes_billed,
         (o_orderkey * 7919) %% 100000 AS total_slot_ms,
         %(cache)s < 0.2 AS cache_hit,
         CASE WHEN %(lab)s < 0.1 THEN []::STRUCT(key VARCHAR, value VARCHAR)[]
              WHEN %(lab)s < 0.2 THEN [{'key': 'owner', 'value': 'team-' || o_orderstatus}]
              ELSE [{'key': 'pipeline', 'value': 'p_' || o_orderpriority}, {'key': 'owner', 'value': 'team-' || o_orderstatus}]
         END AS labels
  FROM orders),
done AS (SELECT * FROM jobs WHERE job_type = 'QUERY' AND state = 'DONE')
""" % {"jsec": U("o_orderkey", "jsec"), "jt": U("o_orderkey", "jt"), "st": U("o_orderkey", "st"),
       "cache": U("o_orderkey", "cache"), "lab": U("o_orderkey", "lab")}

BILLING_CTE = """WITH billing AS (
  SELECT l_orderkey, l_linenumber,
         {'description': CASE l_returnflag WHEN 'A' THEN 'warehouse' WHEN 'N' THEN 'compute'
                         ELSE 'storage' END} AS service,
         CAST(round(l_extendedprice * 100) AS BIGINT) / 100000.0 AS cost,
         [{'type': 'PROMOTION',
           'amount': CAST(-(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT)) / 10000000.0 AS DECIMAL(18,7))},
          {'type': 'SUSTAINED_USAGE',
           'amount': CAST(-(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT)) / 10000000.0 AS DECIMAL(18,7))}]
           AS credits,
         l_shipdate + to_seconds(CAST(floor(%(use)s * 86400) AS BIGINT)) AS usage_start_time
  FROM lineitem)
""" % {"use": U("(l_orderkey * 10 + l_linenumber)", "use")}

_WS = "'[ \\t\\n\\r\\f]+'"

ORACLE = {
    "top_n_expensive": JOBS_CTE + """
SELECT strftime(creation_time, '%%m-%%d %%H:%%M') AS run_at, round(total_bytes_billed / 1048576.0, 1) AS mb_billed,
       round(total_bytes_billed / 1099511627776.0 * 6.25, 4) AS usd_on_demand, total_slot_ms, cache_hit,
       substr(regexp_replace(query, %(ws)s, ' ', 'g'), 1, 60) AS query_start
FROM done WHERE total_bytes_billed > 0
ORDER BY total_bytes_billed DESC, creation_time, query_start LIMIT 10""" % {"ws": _WS},
    "usage_total": JOBS_CTE + """
SELECT count(*) AS queries, round(sum(total_bytes_billed) / 1073741824.0, 2) AS gib_billed,
       round(sum(total_bytes_billed) / 1099511627776.0 * 100, 2) AS pct_of_free_tier,
       round(sum(total_slot_ms) / 1000 / 3600, 2) AS slot_hours FROM done""",
    "ratio_per_mb": JOBS_CTE + """
SELECT substr(regexp_replace(query, %(ws)s, ' ', 'g'), 1, 45) AS q, round(total_bytes_billed / 1048576.0) AS mb_billed,
       round(total_slot_ms / 1000) AS slot_sec,
       round(total_slot_ms / nullif(total_bytes_billed / 1048576.0, 0)) AS slot_ms_per_mb
FROM done WHERE total_bytes_billed > 100000000 ORDER BY slot_ms_per_mb DESC, q LIMIT 6""" % {"ws": _WS},
    "storage_report": """WITH s AS (
  SELECT 'ds_' || l_returnflag AS table_schema, 't_' || CAST(l_suppkey AS VARCHAR) AS table_name,
         CAST(sum(l_quantity) AS BIGINT) * 40960 AS active_logical_bytes, count(*) * 5120 AS long_term_logical_bytes,
         CAST(sum(l_linenumber) AS BIGINT) * 10240 AS total_physical_bytes,
         CAST(sum(l_quantity) AS BIGINT) * 40960 + count(*) * 5120 AS total_logical_bytes
  FROM lineitem GROUP BY l_returnflag, l_suppkey)
SELECT table_name, round(active_logical_bytes / 1048576.0, 1) AS active_logical_mb,
       round(long_term_logical_bytes / 1048576.0, 1) AS longterm_mb, round(total_physical_bytes / 1048576.0, 1) AS physical_mb,
       round(total_logical_bytes / nullif(total_physical_bytes, 0), 2) AS compression_x
FROM s WHERE table_schema = 'ds_N'""",
    "chargeback": JOBS_CTE + """
SELECT list_filter(labels, lambda x: x.key = 'pipeline')[1].value AS pipeline, count(*) AS jobs,
       round(sum(total_bytes_billed) / 1048576.0, 1) AS mb_billed,
       round(sum(total_bytes_billed) / 1099511627776.0 * 6.25, 6) AS usd_on_demand,
       CAST(sum(total_slot_ms) AS BIGINT) AS slot_ms
FROM done WHERE len(list_filter(labels, lambda x: x.key = 'pipeline')) > 0 GROUP BY 1""",
    "label_exists": JOBS_CTE + """
SELECT job_id, len(list_filter(labels, lambda x: x.key = 'pipeline')) > 0 AS has_pipeline FROM jobs""",
    "label_value": JOBS_CTE + """
SELECT job_id, list_filter(labels, lambda x: x.key = 'pipeline')[1].value AS pipeline,
       list_filter(labels, lambda x: x.key = 'owner')[1].value AS owner FROM jobs""",
    "nested_credit_sum": BILLING_CTE + """
SELECT l_orderkey, l_linenumber,
       CAST(coalesce(list_sum(list_transform(list_filter(credits, lambda c: c.type = 'PROMOTION'), lambda c: c.amount)), 0) AS DOUBLE) AS promo,
       CAST(coalesce(list_sum(list_transform(credits, lambda c: c.amount)), 0) AS DOUBLE) AS all_credits FROM billing""",
    "spend_by_service": BILLING_CTE + """
, b AS (SELECT service.description AS service, CAST(cost AS DECIMAL(18,5)) AS cost,
        coalesce(list_sum(list_transform(list_filter(credits, lambda c: c.type = 'PROMOTION'), lambda c: c.amount)), 0) AS promo,
        coalesce(list_sum(list_transform(credits, lambda c: c.amount)), 0) AS credits_total FROM billing)
SELECT service, CAST(round(sum(cost), 4) AS DOUBLE) AS gross_usd, CAST(round(sum(promo), 4) AS DOUBLE) AS trial_credits,
       CAST(round(sum(cost) + sum(credits_total), 4) AS DOUBLE) AS net_usd
FROM b GROUP BY service HAVING round(sum(cost), 4) > 0""",
    "spend_by_day": BILLING_CTE + """
SELECT CAST(usage_start_time AS DATE) AS day, CAST(round(sum(CAST(cost AS DECIMAL(18,5))), 4) AS DOUBLE) AS gross_usd
FROM billing GROUP BY 1 HAVING round(sum(CAST(cost AS DECIMAL(18,5))), 4) > 0""",
    "threshold_alerts": JOBS_CTE + """
SELECT time_bucket(INTERVAL 5 MINUTE, creation_time) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, creation_time) + INTERVAL 5 MINUTE AS window_end,
       count(*) AS events, TRUE AS alert
FROM jobs WHERE total_bytes_billed > 100000000 GROUP BY 1""",
    "skew_report": """WITH c AS (SELECT CASE WHEN l_orderkey % 10 > 0 THEN 1 ELSE l_orderkey END AS k, count(*) AS n
        FROM lineitem GROUP BY 1)
SELECT count(*) AS keys, max(n) AS max_rows, round(avg(n), 4) AS avg_rows, round(max(n) / avg(n), 4) AS max_over_avg,
       max(n) / avg(n) > 3 AS alert FROM c""",
    "freshness_report": """WITH m AS (
  SELECT lower(regexp_replace(o_orderpriority, '[^A-Za-z0-9]', '_', 'g')) AS table_id,
         epoch_ms(max(o_orderdate)) + 1000 * (count(*) %% 7200) AS last_modified_time FROM orders GROUP BY o_orderpriority)
SELECT table_id, epoch_ms(last_modified_time) AS last_updated,
       date_sub('minute', epoch_ms(last_modified_time), TIMESTAMP '%s') AS minutes_stale,
       CASE WHEN date_sub('minute', epoch_ms(last_modified_time), TIMESTAMP '%s') > 60 THEN 'STALE - ALERT' ELSE 'ok' END AS status
FROM m""" % (FRESHNESS_NOW, FRESHNESS_NOW),
}
