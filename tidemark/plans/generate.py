"""GN1-GN3: deterministic dirty order feed and its independent truth.

The feed is derived from the driver tables (``orders`` joined to ``customer`` and
``nation``), so its size grows with them. Every defect is a pure function of the
order key through ``u01`` (F8), which is what lets the truth be recomputed without
touching the pipeline.

Money is carried as integer cents, so sums and rounding are exact in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import u01, u01_bucket
from tidemark.operators.joins import join_dimension

# Defect rates of the synthetic feed (share of orders).
LATE_RATE = 0.03          # order arrives 1-5 days after it was placed
MAX_LAG_DAYS = 5
REPLAY_RATE = 0.005       # exact duplicate delivery
CORRECTION_RATE = 0.02    # valid order re-sent next day with a new amount
NEGATIVE_BELOW = 0.004    # bad < 0.004: negative amount
ZERO_ITEMS_BELOW = 0.007  # 0.004 <= bad < 0.007: zero items
MISSING_TS_BELOW = 0.009  # 0.007 <= bad < 0.009: no order_ts / updated_at
INVALID_BELOW = 0.010     # 0.009 <= bad < 0.010: no amount
MALFORMED_BELOW = 0.001   # junk < 0.001: truncated JSON line (broken producer)
BAD_ITEMS_BELOW = 0.002   # 0.001 <= junk < 0.002: items text that is not a number

#: First day of the feed's calendar.
EPOCH = "1995-01-01"
RAW_FIELDS = ["order_id", "customer_id", "country", "items", "amount", "order_ts", "updated_at"]
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _grain_start(d: Column, grain: str) -> Column:
    return d if grain == "day" else F.trunc(d, grain)


def paced(day: Column, pace: int) -> Column:
    """A calendar that runs ``pace`` times as fast: the day it is there on ``day`` here. All rows stay;
    a day just holds what ``pace`` days hold here."""
    if pace == 1:
        return F.to_date(day)
    return F.date_add(F.lit(EPOCH).cast("date"), F.floor(F.datediff(day, F.lit(EPOCH)) / pace).cast("int"))


def order_universe(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                   grain: str = "month", pace: int = 1) -> DataFrame:
    """GN1: the clean canonical version of every order plus its defect draws.

    ``arrival_date`` = order date + lag (late orders); ``ingest_date`` is the bronze
    partition the order lands in (``arrival_date`` truncated to ``grain``)."""
    cust = customer.select("c_custkey", "c_nationkey")
    nat = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    cust_nat = join_dimension(cust, nat, "c_nationkey", max_dim_rows=1_000_000).drop("c_nationkey")
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    o = join_dimension(o, cust_nat.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", how="left")
    n = F.col("o_orderkey")
    late = u01(n, "late") < LATE_RATE
    lag = F.when(late, 1 + F.floor(u01(n, "lag") * MAX_LAG_DAYS).cast("int")).otherwise(F.lit(0))
    order_date = paced(F.col("o_orderdate"), pace)
    return (o.select(
        n.alias("n"),
        F.format_string("ORD-%09d", n).alias("order_id"),
        F.format_string("CUST-%06d", F.col("o_custkey")).alias("customer_id"),
        F.col("country"),
        (1 + F.floor(u01(n, "items") * 6)).cast("int").alias("items"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount_cents"),
        order_date.alias("order_date"),
        F.timestamp_add("SECOND", F.floor(u01(n, "sec") * 86400).cast("int"),
                        order_date.cast("timestamp_ntz")).alias("order_ts"),
        F.date_add(order_date, lag).alias("arrival_date"),
        u01(n, "bad").alias("bad"), u01(n, "dup").alias("dup"),
        u01(n, "corr").alias("corr"), u01(n, "junk").alias("junk"))
        .withColumn("ingest_date", _grain_start(F.col("arrival_date"), grain)))


def idiv(a: Column, b: int) -> Column:
    """Floor division of integers, exact (no floating rounding)."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("bigint")


def corrected_cents(cents: Column, k: Column) -> Column:
    """amount * (0.8 + 0.4 * k / 1e6), rounded half-up to the cent, in integers."""
    return idiv(cents * (8000000 + 4 * k) + 5000000, 10000000)


def _cents_text(c: Column) -> Column:
    """Exact decimal text of integer cents (``-12.05``), identical in any engine."""
    a = F.abs(c)
    body = F.format_string("%d.%02d", idiv(a, 100), F.pmod(a, F.lit(100)))
    return F.when(c.isNull(), F.lit(None).cast("string")).when(c < 0, F.concat(F.lit("-"), body)).otherwise(body)


def feed_events(universe: DataFrame, grain: str = "month") -> DataFrame:
    """GN2: every event that lands in bronze (typed, before JSON encoding).

    One pass over the universe: each order emits an array of 1-3 events - the base
    row (carrying the invalid share), an exact replay, a next-day correction of a
    valid order - and ``explode`` flattens it (a Generate, no union re-scan)."""
    bad, junk = F.col("bad"), F.col("junk")
    missing_ts = (bad >= ZERO_ITEMS_BELOW) & (bad < MISSING_TS_BELOW)
    base_items = F.when((bad >= NEGATIVE_BELOW) & (bad < ZERO_ITEMS_BELOW), F.lit(0)).otherwise(F.col("items"))
    base_cents = (F.when(bad < NEGATIVE_BELOW, -F.col("amount_cents"))
                  .when((bad >= MISSING_TS_BELOW) & (bad < INVALID_BELOW), F.lit(None).cast("bigint"))
                  .otherwise(F.col("amount_cents")))
    base_ts = F.when(missing_ts, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("order_ts"))

    def event(kind: int, ingest, j, items, cents, order_ts, updated_at):
        return F.struct(F.lit(kind).alias("kind"), ingest.alias("ingest_date"), j.alias("junk"),
                        items.cast("int").alias("items"), cents.cast("bigint").alias("amount_cents"),
                        order_ts.cast("timestamp_ntz").alias("order_ts"),
                        updated_at.cast("timestamp_ntz").alias("updated_at"))

    k = u01_bucket("n", "cadj")
    corr_day = F.date_add(F.col("arrival_date"), 1)
    base = event(0, F.col("ingest_date"), junk, base_items, base_cents, base_ts, base_ts)
    replay = F.when(F.col("dup") < REPLAY_RATE, event(1, F.col("ingest_date"), junk, base_items, base_cents,
                                                      base_ts, base_ts))
    correction = F.when((F.col("corr") < CORRECTION_RATE) & (bad >= INVALID_BELOW) & (junk >= BAD_ITEMS_BELOW),
                        event(2, _grain_start(corr_day, grain), F.lit(1.0), F.col("items"),
                              corrected_cents(F.col("amount_cents"), k), F.col("order_ts"),
                              F.timestamp_add("SECOND", F.floor(u01("n", "csec") * 86400).cast("int"),
                                              corr_day.cast("timestamp_ntz"))))
    events = F.filter(F.array(base, replay, correction), lambda e: e.isNotNull())
    return (universe.select("n", "order_id", "customer_id", "country", F.explode(events).alias("e"))
            .select("n", "order_id", "customer_id", "country", "e.*"))


def bronze_lines(events: DataFrame) -> DataFrame:
    """Encode events as JSON lines (``value``) with the drift real feeds carry:
    items as a string for even keys and a number for odd keys, amounts as numbers,
    timestamps as ISO-8601 text, absent fields omitted; broken producer lines are
    truncated JSON, and some items are not numbers at all."""
    junk = F.col("junk")
    items_tok = (F.when((junk >= MALFORMED_BELOW) & (junk < BAD_ITEMS_BELOW),
                        F.concat(F.lit('"'), F.col("items").cast("string"), F.lit('x"')))
                 .when(F.pmod(F.col("n"), F.lit(2)) == 0,
                       F.concat(F.lit('"'), F.col("items").cast("string"), F.lit('"')))
                 .otherwise(F.col("items").cast("string")))

    def kv(name: str, token: Column) -> Column:
        return F.concat(F.lit('"%s":' % name), token)

    def q(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    pairs = F.array(
        kv("order_id", q(F.col("order_id"))),
        kv("customer_id", q(F.col("customer_id"))),
        kv("country", q(F.col("country"))),
        kv("items", items_tok),
        kv("amount", _cents_text(F.col("amount_cents"))),
        kv("order_ts", q(F.date_format("order_ts", TS_TEXT))),
        kv("updated_at", q(F.date_format("updated_at", TS_TEXT))))
    good = F.concat(F.lit("{"), F.array_join(F.filter(pairs, lambda x: x.isNotNull()), ","), F.lit("}"))
    broken = F.concat(F.lit('{"order_id":"'), F.col("order_id"), F.lit('","amount":'))
    line = F.when(junk < MALFORMED_BELOW, broken).otherwise(good)
    return events.select(line.alias("value"), "ingest_date")


def bronze_feed(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                grain: str = "month", pace: int = 1) -> DataFrame:
    """Raw JSON lines per ingest partition, ready for ``export_json``."""
    return bronze_lines(feed_events(order_universe(orders, customer, nation, grain, pace), grain))


def truth_daily(universe: DataFrame, last_day=None, grain: str = "month") -> DataFrame:
    """GN3: expected gold recomputed from the generator's definitions alone.

    Valid orders only; a corrected order counts with its corrected amount. With ``last_day`` (the
    last ingest partition that was processed) an order counts if it had arrived by then, and its
    correction if that had."""
    n = F.col("n")
    k = u01_bucket(n, "cadj")
    valid = universe.filter((F.col("bad") >= INVALID_BELOW) & (F.col("junk") >= BAD_ITEMS_BELOW))
    corrected = F.col("corr") < CORRECTION_RATE
    if last_day is not None:
        last = F.lit(str(last_day)).cast("date")
        valid = valid.filter(F.col("ingest_date") <= last)
        corrected = corrected & (_grain_start(F.date_add("arrival_date", 1), grain) <= last)
    cents = F.when(corrected, corrected_cents(F.col("amount_cents"), k)).otherwise(F.col("amount_cents"))
    return (valid.groupBy("order_date", "country")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum(cents).alias("revenue_cents")))


# SURVEY names for the generator steps
dirty_feed = feed_events
truth = truth_daily
