"""DuckDB SQL that recomputes the order feed and its layers from the driver tables.

This is the independent side of the correctness check: it never reads anything
Spark wrote. The CTEs mirror the *definitions* in ``generate.py`` (rates, hashes,
encodings) and the *semantics* of C1/C2 (first failing rule, latest version).
"""

from __future__ import annotations


def U(n: str, salt: str) -> str:
    return ("(((('0x' || substr(md5(CAST(%s AS VARCHAR) || ':%s'), 1, 15))::BIGINT) %% 1000000) / 1000000.0)"
            % (n, salt))


def K(n: str, salt: str) -> str:
    return "((('0x' || substr(md5(CAST(%s AS VARCHAR) || ':%s'), 1, 15))::BIGINT) %% 1000000)" % (n, salt)


def CENTS_TEXT(c: str) -> str:
    return ("CASE WHEN {c} IS NULL THEN NULL WHEN {c} < 0 THEN '-' || printf('%d.%02d', (-{c}) // 100, (-{c}) % 100) "
            "ELSE printf('%d.%02d', {c} // 100, {c} % 100) END").format(c=c)


def GRAIN(d: str, grain: str) -> str:
    return d if grain == "day" else "CAST(date_trunc('%s', %s) AS DATE)" % (grain, d)


def PACED(d: str, pace: int) -> str:
    return d if pace == 1 else ("CAST(DATE '1995-01-01' + CAST(floor(date_diff('day', DATE '1995-01-01', %s) / %d) AS INTEGER) "
                                "AS DATE)" % (d, pace))


def feed_ctes(grain: str = "day", pace: int = 60) -> str:
    """CTEs: uni (GN1), ev (GN2, typed), scored (P4+P5), silver (W1), latest (W2), gold (A2)."""
    return """
uni0 AS (
  SELECT o.o_orderkey AS n, o.o_custkey, o.o_totalprice, %(day)s AS o_orderdate, cn.n_name AS country
  FROM orders o
  LEFT JOIN (SELECT c.c_custkey, nn.n_name FROM customer c JOIN nation nn ON nn.n_nationkey = c.c_nationkey) cn
    ON cn.c_custkey = o.o_custkey),
uni AS (
  SELECT n, printf('ORD-%%09d', n) AS order_id, printf('CUST-%%06d', o_custkey) AS customer_id, country,
         CAST(1 + floor(%(u_items)s * 6) AS INTEGER) AS items,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(floor(%(u_sec)s * 86400) AS BIGINT)) AS order_ts,
         CAST(o_orderdate AS DATE) + CAST(CASE WHEN %(u_late)s < 0.03 THEN 1 + floor(%(u_lag)s * 5) ELSE 0 END AS INTEGER)
           AS arrival_date,
         %(u_bad)s AS bad, %(u_dup)s AS dup, %(u_corr)s AS corr, %(u_junk)s AS junk,
         %(k_cadj)s AS kadj, %(u_csec)s AS csec
  FROM uni0),
uni_p AS (SELECT *, %(ingest)s AS ingest_date FROM uni),
base AS (
  SELECT n, order_id, customer_id, country, ingest_date, junk, 0 AS kind,
         CASE WHEN bad >= 0.004 AND bad < 0.007 THEN 0 ELSE items END AS items,
         CASE WHEN bad < 0.004 THEN -amount_cents WHEN bad >= 0.009 AND bad < 0.010 THEN NULL
              ELSE amount_cents END AS amount_cents,
         CASE WHEN bad >= 0.007 AND bad < 0.009 THEN NULL ELSE order_ts END AS order_ts,
         CASE WHEN bad >= 0.007 AND bad < 0.009 THEN NULL ELSE order_ts END AS updated_at,
         dup
  FROM uni_p),
ev AS (
  SELECT n, order_id, customer_id, country, ingest_date, junk, kind, items, amount_cents, order_ts, updated_at
  FROM base
  UNION ALL
  SELECT n, order_id, customer_id, country, ingest_date, junk, 1, items, amount_cents, order_ts, updated_at
  FROM base WHERE dup < 0.005
  UNION ALL
  SELECT n, order_id, customer_id, country, %(corr_ingest)s, 1.0, 2, items,
         (amount_cents * (8000000 + 4 * kadj) + 5000000) // 10000000,
         order_ts,
         CAST(arrival_date + 1 AS TIMESTAMP) + to_seconds(CAST(floor(csec * 86400) AS BIGINT))
  FROM uni_p WHERE corr < 0.02 AND bad >= 0.010 AND junk >= 0.002),
scored AS (
  SELECT *,
         CASE WHEN junk >= 0.001 AND junk < 0.002 THEN NULL ELSE items END AS items_i,
         amount_cents / 100.0 AS amount_d,
         CASE WHEN junk < 0.001 THEN 'malformed_json'
              WHEN order_id IS NULL THEN 'missing_order_id'
              WHEN country IS NULL THEN 'missing_country'
              WHEN order_ts IS NULL THEN 'bad_or_missing_order_ts'
              WHEN updated_at IS NULL THEN 'bad_or_missing_updated_at'
              WHEN amount_cents IS NULL THEN 'bad_or_missing_amount'
              WHEN amount_cents < 0 THEN 'negative_amount'
              WHEN junk >= 0.001 AND junk < 0.002 THEN 'bad_or_missing_items'
              WHEN items <= 0 THEN 'non_positive_items' END AS reject_reason
  FROM ev),
silver AS (
  SELECT order_id, customer_id, country, items_i AS items, amount_d AS amount, order_ts, updated_at,
         CAST(order_ts AS DATE) AS order_date, ingest_date
  FROM scored WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY ingest_date, order_id ORDER BY updated_at DESC) = 1),
latest AS (
  SELECT * FROM silver
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, ingest_date DESC) = 1),
gold AS (
  SELECT order_date, country, count(*) AS orders,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
         ((2 * sum(CAST(round(amount * 100) AS BIGINT)) + count(*)) // (2 * count(*))) / 100.0 AS avg_order_value
  FROM latest GROUP BY order_date, country),
truth AS (
  SELECT order_date, country, count(*) AS orders,
         sum(CASE WHEN corr < 0.02 THEN (amount_cents * (8000000 + 4 * kadj) + 5000000) // 10000000
                  ELSE amount_cents END) / 100.0 AS revenue
  FROM uni WHERE bad >= 0.010 AND junk >= 0.002
  GROUP BY order_date, country)
""" % {
        "u_items": U("n", "items"), "u_sec": U("n", "sec"), "u_late": U("n", "late"), "u_lag": U("n", "lag"),
        "u_bad": U("n", "bad"), "u_dup": U("n", "dup"), "u_corr": U("n", "corr"), "u_junk": U("n", "junk"),
        "k_cadj": K("n", "cadj"), "u_csec": U("n", "csec"),
        "day": PACED("CAST(o.o_orderdate AS DATE)", pace), "ingest": GRAIN("arrival_date", grain), "corr_ingest": GRAIN("arrival_date + 1", grain),
    }


def with_feed(select_sql: str) -> str:
    return "WITH " + feed_ctes() + select_sql


RAW_TEXT_SELECT = """
raw AS (
  SELECT ingest_date,
         CASE WHEN junk < 0.001 THEN NULL ELSE order_id END AS order_id,
         CASE WHEN junk < 0.001 THEN NULL ELSE customer_id END AS customer_id,
         CASE WHEN junk < 0.001 THEN NULL ELSE country END AS country,
         CASE WHEN junk < 0.001 THEN NULL
              WHEN junk >= 0.001 AND junk < 0.002 THEN CAST(items AS VARCHAR) || 'x'
              ELSE CAST(items AS VARCHAR) END AS items,
         CASE WHEN junk < 0.001 THEN NULL ELSE %(cents)s END AS amount,
         CASE WHEN junk < 0.001 THEN NULL ELSE strftime(order_ts, '%%Y-%%m-%%dT%%H:%%M:%%SZ') END AS order_ts,
         CASE WHEN junk < 0.001 THEN NULL ELSE strftime(updated_at, '%%Y-%%m-%%dT%%H:%%M:%%SZ') END AS updated_at,
         CASE WHEN junk < 0.001 THEN '{"order_id":"' || order_id || '","amount":' END AS _corrupt_record,
         reject_reason
  FROM scored)
""" % {"cents": CENTS_TEXT("amount_cents")}


def with_raw(select_sql: str) -> str:
    return "WITH " + feed_ctes() + "," + RAW_TEXT_SELECT + select_sql
