"""DuckDB oracle SQL for the lakehouse queries (see ``catalog_lake``)."""

from __future__ import annotations

from tidemark.plans.oracle_feed import feed_ctes, with_feed, with_raw

#: The last whole day of orders, and the layers as they are when it is the last partition processed.
_DAY = "(SELECT max(order_date) - 1 FROM silver)"
_UNTIL = """,
silver_until AS (SELECT * FROM silver WHERE ingest_date <= %s),
latest_until AS (
  SELECT * FROM silver_until
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, ingest_date DESC) = 1),
gold_until AS (
  SELECT order_date, country, count(*) AS orders,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
         ((2 * sum(CAST(round(amount * 100) AS BIGINT)) + count(*)) // (2 * count(*))) / 100.0 AS avg_order_value
  FROM latest_until GROUP BY order_date, country)
""" % _DAY


def oracle() -> dict[str, str]:
    q = {}
    q["raw_json_read"] = with_raw("""
SELECT order_id, customer_id, country, items, amount, order_ts, updated_at, _corrupt_record, ingest_date FROM raw""")
    q["partition_range_read"] = with_feed("""
SELECT ingest_date, count(*) AS lines FROM scored
WHERE ingest_date BETWEEN DATE '1995-01-08' AND DATE '1995-01-21' GROUP BY ingest_date""")
    q["partition_from_path"] = with_feed("""
SELECT ingest_date, count(*) AS lines FROM scored GROUP BY ingest_date""")
    q["export_json_roundtrip"] = with_feed("""
SELECT ingest_date, count(*) AS lines, count(*) FILTER (WHERE reject_reason = 'malformed_json') AS malformed
FROM scored GROUP BY ingest_date""")
    q["safe_cast"] = with_feed("""
SELECT ingest_date,
       CASE WHEN junk < 0.001 THEN NULL ELSE order_id END AS order_id,
       CASE WHEN junk < 0.001 THEN NULL ELSE items_i END AS items,
       CASE WHEN junk < 0.001 THEN NULL ELSE amount_d END AS amount,
       CASE WHEN junk < 0.001 THEN NULL ELSE order_ts END AS order_ts,
       CASE WHEN junk < 0.001 THEN NULL ELSE updated_at END AS updated_at
FROM scored""")
    q["reject_reason"] = with_feed("""
SELECT ingest_date, CASE WHEN junk < 0.001 THEN NULL ELSE order_id END AS order_id, reject_reason FROM scored""")
    q["valid_rows"] = with_feed("""
SELECT ingest_date, order_id, country, items_i AS items, amount_d AS amount, order_ts, updated_at
FROM scored WHERE reject_reason IS NULL""")
    q["quarantine_rows"] = with_raw("""
SELECT order_id, customer_id, country, items, amount, order_ts, updated_at, _corrupt_record, reject_reason, ingest_date
FROM raw WHERE reject_reason IS NOT NULL""")
    q["outcome_profile"] = with_feed("""
SELECT reject_reason, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
       count(*) / sum(count(*)) OVER () AS share
FROM scored GROUP BY reject_reason""")
    q["breaker_decision"] = with_feed("""
SELECT ingest_date, count(*) AS rows_in, count(reject_reason) AS rejected,
       count(reject_reason) / count(*) AS reject_rate, count(reject_reason) / count(*) > 0.05 AS tripped
FROM scored GROUP BY ingest_date""")
    silver = with_feed("""
SELECT order_id, customer_id, country, items, amount, order_ts, updated_at, order_date, ingest_date FROM silver""")
    q["bronze_to_silver"] = silver
    q["dedup_within_day"] = silver
    q["idempotent_overwrite"] = silver
    q["idempotent_rerun"] = with_feed(_UNTIL + """
SELECT order_id, customer_id, country, items, amount, order_ts, updated_at, order_date, ingest_date FROM silver_until""")
    q["current_state"] = with_feed("""
SELECT order_id, order_date, country, amount, updated_at, ingest_date FROM latest""")
    q["affected_dates"] = with_feed("""
SELECT DISTINCT order_date FROM silver WHERE ingest_date = %s""" % _DAY)
    q["gold_rebuild"] = with_feed("""
SELECT order_id, order_date, country, amount FROM latest
WHERE order_date IN (SELECT order_date FROM silver WHERE ingest_date = %s)""" % _DAY)
    gold = with_feed("""
SELECT order_date, country, orders, revenue, avg_order_value FROM gold""")
    q["silver_to_gold"] = gold
    q["backfill_equals_daily"] = gold
    q["daily_run"] = with_feed(_UNTIL + """
SELECT order_date, country, orders, revenue, avg_order_value FROM gold_until""")
    q["spanning_orders"] = with_feed("""
SELECT l.order_id, m.versions, m.first_ingest, l.amount, l.updated_at, l.ingest_date
FROM latest l JOIN (SELECT order_id, count(*) AS versions, min(ingest_date) AS first_ingest FROM silver
                    GROUP BY order_id HAVING count(*) > 1) m ON m.order_id = l.order_id""")
    q["reconcile_last_day"] = with_feed(_UNTIL + """,
t AS (
  SELECT order_date, country, count(*) AS orders,
         sum(CASE WHEN corr < 0.02 AND arrival_date + 1 <= {d} THEN (amount_cents * (8000000 + 4 * kadj) + 5000000) // 10000000
                  ELSE amount_cents END) / 100.0 AS revenue
  FROM uni_p WHERE bad >= 0.010 AND junk >= 0.002 AND ingest_date <= {d}
  GROUP BY order_date, country)
SELECT order_date, country, t.orders AS truth_orders, t.revenue AS truth_revenue,
       g.orders AS gold_orders, g.revenue AS gold_revenue
FROM t FULL OUTER JOIN gold_until g USING (order_date, country)""".format(d=_DAY))
    q["emptied_dates"] = with_feed(_UNTIL + """,
kept AS (
  SELECT order_id, order_date, country, amount, updated_at, ingest_date FROM silver_until WHERE ingest_date < {d}
  UNION ALL
  SELECT 'ORD-999999999', {d}, 'REDELIVERED', 1.0, CAST({d} AS TIMESTAMP) + INTERVAL 1 HOUR, {d}),
now AS (
  SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, ingest_date DESC) = 1)
SELECT order_date, country, count(*) AS orders,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       ((2 * sum(CAST(round(amount * 100) AS BIGINT)) + count(*)) // (2 * count(*))) / 100.0 AS avg_order_value
FROM now GROUP BY order_date, country""".format(d=_DAY))
    q["volume_gates"] = with_feed("""
, days AS (SELECT ingest_date, count(*) AS n FROM silver GROUP BY ingest_date),
w AS (SELECT ingest_date, n, count(*) OVER p AS k, avg(n) OVER p AS mean FROM days
      WINDOW p AS (ORDER BY ingest_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
b AS (SELECT ingest_date, n,
             CASE WHEN k >= 3 THEN greatest(1, CAST(floor(mean * (1 - 0.6)) AS BIGINT)) ELSE 1 END AS lo,
             CASE WHEN k >= 3 THEN CAST(ceil(mean * (1 + 0.6)) AS BIGINT) ELSE 9223372036854775807 END AS hi FROM w)
SELECT ingest_date, n, lo, hi, n BETWEEN lo AND hi AS passed FROM b""")
    q["compact_files"] = with_feed("""
SELECT ingest_date, count(*) AS rows FROM silver GROUP BY ingest_date""")
    q["assert_gold_counts"] = with_feed("""
SELECT g.gold_orders, s.silver_orders, g.gold_orders = s.silver_orders AS ok
FROM (SELECT CAST(coalesce(sum(orders), 0) AS BIGINT) AS gold_orders FROM gold) g,
     (SELECT count(DISTINCT order_id) AS silver_orders FROM silver) s""")
    q["run_metrics"] = with_feed("""
SELECT (SELECT min(ingest_date) FROM ev) AS ingest_from, (SELECT max(ingest_date) FROM ev) AS ingest_to,
       (SELECT count(*) FROM scored) AS rows_in,
       (SELECT count(*) FROM scored WHERE reject_reason IS NULL) AS valid,
       (SELECT count(*) FROM scored WHERE reject_reason IS NOT NULL) AS rejected,
       (SELECT string_agg(reject_reason || ':' || n, ',' ORDER BY reject_reason) FROM (
          SELECT reject_reason, count(*) AS n FROM scored WHERE reject_reason IS NOT NULL GROUP BY reject_reason)) AS reject_reasons,
       (SELECT count(*) FROM scored WHERE reject_reason IS NULL) - (SELECT count(*) FROM silver) AS duplicates_removed,
       (SELECT count(*) FROM silver) AS silver_rows,
       (SELECT count(DISTINCT order_date) FROM silver) AS affected_order_dates,
       (SELECT min(order_date) FROM silver) AS first_affected, (SELECT max(order_date) FROM silver) AS last_affected""")
    q["truth_daily"] = with_feed("""
SELECT order_date, country, orders, revenue FROM truth""")
    q["reconcile_full_outer"] = with_feed("""
SELECT order_date, country, t.orders AS truth_orders, t.revenue AS truth_revenue,
       g.orders AS gold_orders, g.revenue AS gold_revenue
FROM truth t FULL OUTER JOIN gold g USING (order_date, country)""")
    q["reconcile_summary"] = "WITH " + feed_ctes("month", 1) + """
SELECT count(*) AS cells_compared,
       count(*) FILTER (WHERE g.orders IS NULL OR t.orders IS NULL) AS cells_missing_on_one_side,
       count(*) FILTER (WHERE g.orders != t.orders) AS order_count_mismatches,
       count(*) FILTER (WHERE abs(g.revenue - t.revenue) > 0.01) AS revenue_mismatches_over_1_cent,
       round(coalesce(max(abs(g.revenue - t.revenue)), 0.0), 6) AS max_revenue_diff,
       CAST(sum(t.orders) AS BIGINT) AS truth_orders, CAST(sum(g.orders) AS BIGINT) AS gold_orders
FROM truth t FULL OUTER JOIN gold g USING (order_date, country)"""
    q["gen_universe"] = with_feed("""
SELECT n, order_id, customer_id, country, items, amount_cents / 100.0 AS amount, order_date, order_ts,
       arrival_date, ingest_date, bad, dup, corr FROM uni_p""")
    q["gen_events"] = with_feed("""
SELECT order_id, ingest_date, kind, items, amount_cents / 100.0 AS amount, order_ts, updated_at FROM ev""")
    q["gate_results"] = with_feed_extra("""p AS (SELECT * FROM silver WHERE ingest_date = %s),
m AS (SELECT count(*) / 7.0 AS mean FROM silver WHERE ingest_date < {d} AND ingest_date >= {d} - 7)""".format(d=_DAY).replace("%s", _DAY), """
SELECT 'volume' AS gate, count(*) AS value, count(*) BETWEEN floor(any_value(mean) * 0.4) AND ceil(any_value(mean) * 1.6) AS passed
FROM p, m
UNION ALL SELECT 'no_negative_amount', count(*) FILTER (WHERE amount < 0), count(*) FILTER (WHERE amount < 0) = 0 FROM p
UNION ALL SELECT 'no_non_positive_items', count(*) FILTER (WHERE items <= 0), count(*) FILTER (WHERE items <= 0) = 0 FROM p
UNION ALL SELECT 'no_missing_order_ts', count(*) FILTER (WHERE order_ts IS NULL), count(*) FILTER (WHERE order_ts IS NULL) = 0 FROM p
UNION ALL SELECT 'unique_order_id', count(*) - count(DISTINCT order_id),
                 count(*) = count(DISTINCT order_id) AND count(order_id) = count(*) FROM p
UNION ALL SELECT 'non_empty', count(*), count(*) > 0 FROM p""")
    q["gold_freshness"] = with_feed("""
SELECT max(TIMESTAMP '2026-08-31 06:00:00') AS last_built,
       CAST(date_diff('minute', max(TIMESTAMP '2026-08-31 06:00:00'), TIMESTAMP '2026-08-31 06:45:00') AS BIGINT)
         AS minutes_stale,
       max(TIMESTAMP '2026-08-31 06:00:00') IS NULL
         OR date_diff('minute', max(TIMESTAMP '2026-08-31 06:00:00'), TIMESTAMP '2026-08-31 06:45:00') > 60 AS stale
FROM gold""")
    return q


def with_feed_extra(extra_cte: str, select_sql: str) -> str:
    from tidemark.plans.oracle_feed import feed_ctes
    return "WITH " + feed_ctes() + ", " + extra_cte + select_sql
