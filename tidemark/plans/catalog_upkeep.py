"""Registered queries that keep tables up to date: versioned dimensions under late batches
(M4), views kept from changes (U4), scoped merges (M1) and change feeds (M13).

The customer dimension gets three batches, the second of which arrives last; a part
dimension with a key of two columns gets three and one of them a second time. All rows
come from the driver tables; what differs between batches is drawn by hash from the keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import u01
from tidemark.operators import history, joins, merge
from tidemark.operators.history import Dimension
from tidemark.operators.views import View
from tidemark.plans import catalog_dims
from tidemark.plans.catalog_dims import ATTRS, KEY, staging_day1, staging_day2
from tidemark.plans.oracle_feed import U
from tidemark.session import ensure_conf, scratch_dir
from tidemark.sources import files
from tidemark.sources.tables import Tables

CUSTOMERS = Dimension.of(KEY, ATTRS)
PARTS = Dimension.of(("p_brand", "p_partkey"), ("p_type", "p_size", "price_cents"))
FIRST, LATE, SECOND, THIRD = (dt.date(2026, 1, d) for d in (1, 2, 3, 4))
CITY_VIEW = View(groups=("city",), count="n", sums={"key_sum": KEY}, minima={"first_seen": "valid_from"},
                 maxima={"last_seen": "valid_from"})


# --------------------------------------------------------------------- customers
def late_customers(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    """The batch of 2 January: part of the customers, some as they were, some moved, some
    never seen before. ``again``: as it is sent the second time, with fewer moves."""
    draw, moved = u01(KEY, "late2"), 0.03 if again else 0.08
    d1 = staging_day1(spark, sf_dir).filter(draw < 0.30)
    known = d1.select(KEY, "name", F.when(draw < moved, F.concat("city", F.lit("-L"))).otherwise(F.col("city")).alias("city"),
                      F.when((draw >= 0.20) & (draw < 0.25), F.lit("GOLD")).otherwise(F.col("tier")).alias("tier"))
    new = d1.filter((draw >= 0.10) & (draw < (0.12 if again else 0.15))).select(
        (F.col(KEY) + 2 * catalog_dims.NEW_KEY_OFFSET).alias(KEY), "name", F.concat("city", F.lit("-L")).alias("city"), "tier")
    return known.unionByName(new)


def customer_batches(spark, sf_dir):
    """(date, batch) in the order of arrival."""
    return [(FIRST, staging_day1(spark, sf_dir)), (SECOND, staging_day2(spark, sf_dir)),
            (LATE, late_customers(spark, sf_dir)), (LATE, late_customers(spark, sf_dir, again=True))]


def scd2_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: 1 January, 3 January, then the late batch of 2 January, and that once more corrected."""
    ensure_conf(spark)
    path = scratch_dir(spark, "dim-late") + "/dim_customer"
    for day, batch in customer_batches(spark, sf_dir):
        done = history.apply_batch(path, batch, CUSTOMERS, day)
    return done.table


def mv_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: the view per city, kept from each batch's removed and added versions alone; the
    table is read only for cities whose first or last version was withdrawn."""
    ensure_conf(spark)
    root = scratch_dir(spark, "dim-view")
    state = None
    for i, (day, batch) in enumerate(customer_batches(spark, sf_dir)):
        done = history.apply_batch(root + "/dim_customer", batch, CUSTOMERS, day)
        new = CITY_VIEW.full(done.added) if state is None else CITY_VIEW.refresh(state, done.added, done.removed, done.table)
        state = spark.read.parquet(files.replace_table(new, "%s/view-%d" % (root, i)))
    return state


# ------------------------------------------------------------------------- parts
def part_batch(spark: SparkSession, sf_dir: str, salt: str, share: float, dearer: float) -> DataFrame:
    """Parts drawn with ``salt``; of those a share is dearer or of no known type."""
    p = Tables(spark, sf_dir).part
    draw, change = u01("p_partkey", salt), u01("p_partkey", salt + "-change")
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return p.filter(draw < share).select(
        "p_brand", "p_partkey", F.when(change < 0.02, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("p_type"),
        "p_size", F.when(change >= 1 - dearer, cents + 100).otherwise(cents).alias("price_cents"))


def part_batches(spark, sf_dir):
    return [(FIRST, part_batch(spark, sf_dir, "p1", 0.9, 0.0), False),
            (THIRD, part_batch(spark, sf_dir, "p4", 0.8, 0.3), True),
            (LATE, part_batch(spark, sf_dir, "p2", 0.5, 0.2), False),
            (THIRD, part_batch(spark, sf_dir, "p4", 0.8, 0.3), True)]


def scd2_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 / D10 for a key of two columns: the batch of 4 January closes parts that it lacks, the batch
    of 2 January comes after it, and that of 4 January once more."""
    ensure_conf(spark)
    path = scratch_dir(spark, "dim-parts") + "/dim_part"
    for day, batch, whole in part_batches(spark, sf_dir):
        done = history.apply_batch(path, batch, PARTS, day, close_missing=whole)
    return done.table


# ------------------------------------------------------------------ scoped merge
def _cells(spark, sf_dir, before: bool) -> DataFrame:
    """Orders and revenue per (order date, country). Before: a tenth of the orders is not
    there yet, some of the others have no known country, and some are counted twice."""
    t = Tables(spark, sf_dir)
    nat = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    c = joins.join_dimension(t.customer.select("c_custkey", "c_nationkey"), nat, "c_nationkey")
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("order_date"),
                        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    j = o.join(c.select("c_custkey", "country"), "c_custkey")
    if before:
        draw = u01("o_orderkey", "was")
        j = j.filter(draw >= 0.10).withColumn("country", F.when(draw < 0.20, F.lit("UNKNOWN")).otherwise(F.col("country")))
        j = j.withColumn("cents", F.when(draw >= 0.95, F.col("cents") * 2).otherwise(F.col("cents")))
    cells = j.groupBy("order_date", "country").agg(F.count(F.lit(1)).alias("orders"), F.sum("cents").alias("revenue_cents"))
    return cells.withColumn("order_month", F.trunc("order_date", "month"))


MERGE_FROM, MERGE_TO = dt.date(1996, 6, 15), dt.date(1998, 3, 1)


def _merged(spark, sf_dir):
    ensure_conf(spark)
    path = scratch_dir(spark, "gold-merge") + "/gold"
    files.replace_partitions(_cells(spark, sf_dir, before=True), path, "order_month")
    scope = (F.col("order_date") >= F.lit(MERGE_FROM)) & (F.col("order_date") < F.lit(MERGE_TO))
    source = _cells(spark, sf_dir, before=False).filter(scope)
    counts = merge.merge_table(path, source, ["order_date", "country"], "order_month", scope)
    return spark.read.parquet(path), counts


def gold_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the gold table after the affected dates were rebuilt and merged: cells updated, inserted
    and (their orders found their country) deleted, cells of other dates as they were."""
    return _merged(spark, sf_dir)[0].select("order_date", "country", "orders", "revenue_cents")


def merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: cells per action of that merge."""
    _, counts = _merged(spark, sf_dir)
    return spark.createDataFrame([(a, n) for a, n in counts.items()], "action string, cells long")


# ------------------------------------------------------------------- change feed
def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed that leads from day 1 to day 2: inserts, updates (each after a superseded one) and deletes."""
    d1, d2 = staging_day1(spark, sf_dir), staging_day2(spark, sf_dir)
    both = d1.select(KEY, *[F.col(a).alias("_o_" + a) for a in ATTRS]).join(d2, KEY, "full")
    was, is_ = F.col("_o_name").isNotNull(), F.col("name").isNotNull()

    def change(seq, op, name, city, tier):
        return F.struct(F.lit(seq).cast("bigint").alias("seq"), op.alias("op"), name.alias("name"), city.alias("city"),
                        tier.alias("tier"))
    old = [F.col("_o_name"), F.lit("stale"), F.col("_o_tier")]
    new = [F.col("name"), F.col("city"), F.col("tier")]
    return both.select(KEY, F.explode(F.array(
        F.when(was, change(1, F.lit("U"), *old)), F.when(is_, change(2, F.when(was, "U").otherwise("I"), *new)),
        F.when(was & ~is_, change(3, F.lit("D"), *old)))).alias("c")).filter("c is not null").select(KEY, "c.*")


def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 1, the feed in two batches, and then a third batch that replays old changes (updates
    from before the deletes among them): the state knows what it has applied, and the result is day 2."""
    ensure_conf(spark)
    root = scratch_dir(spark, "cdc")
    changes, draw = customer_changes(spark, sf_dir), u01(KEY, "half")
    state = merge.cdc_state(staging_day1(spark, sf_dir))
    for i, batch in enumerate([changes.filter((draw < 0.5) | (F.col("seq") == 1)), changes.filter(draw >= 0.5),
                               changes.filter("seq = 1 or (seq = 2 and op = 'U')")]):
        state = merge.apply_changes(state, batch, [KEY], "seq")
        state = spark.read.schema(state.schema).parquet(files.replace_table(state, "%s/state-%d" % (root, i)))
    return merge.visible(state)


QUERIES = {f.__name__: f for f in [scd2_late, mv_refresh, scd2_parts, gold_merge, merge_actions, cdc_apply]}


# ------------------------------------------------------------------------ oracle
def _sql_chain(key: list[str], attrs: list[str]) -> str:
    """CTEs ``marks`` to ``versions`` over ``says``: the state per key and day it is told for
    (``gone``: not there from then on), ``pin`` where a version starts whatever it says."""
    k, cols = ", ".join(key), ", ".join(attrs)
    h = "md5(concat_ws('|', %s))" % ", ".join("coalesce(CAST(%s AS VARCHAR), '\\N')" % a for a in attrs)
    sk = "md5(concat_ws('#', %s, strftime(day, '%%Y-%%m-%%d')))" % ", ".join(
        "replace(CAST(%s AS VARCHAR), '#', '\\#')" % c for c in key)
    return """
marks AS (SELECT *, CASE WHEN gone THEN NULL ELSE {h} END AS row_hash FROM says),
news AS (
  SELECT *, lag(row_hash) OVER (PARTITION BY {k} ORDER BY day) AS before_hash FROM marks),
kept AS (SELECT * FROM news WHERE pin OR row_hash IS DISTINCT FROM before_hash),
spans AS (SELECT *, lead(day) OVER (PARTITION BY {k} ORDER BY day) AS next_at FROM kept),
versions AS (
  SELECT {sk} AS sk, {k}, {cols}, row_hash, day AS valid_from, coalesce(next_at, DATE '9999-12-31') AS valid_to,
         next_at IS NULL AS is_current
  FROM spans WHERE NOT gone)""".format(k=k, h=h, sk=sk, cols=cols)


_D1_D2 = catalog_dims.DIM_CTES.split("h1 AS (SELECT")[0]
# what 3 January changed is a version that starts whatever the late batch says
_LATE = _D1_D2 + """
drawn AS (SELECT *, {draw} AS draw FROM d1),
late AS (
  SELECT customer_id, name, CASE WHEN draw < 0.03 THEN city || '-L' ELSE city END AS city,
         CASE WHEN draw >= 0.20 AND draw < 0.25 THEN 'GOLD' ELSE tier END AS tier
  FROM drawn WHERE draw < 0.30
  UNION ALL
  SELECT customer_id + 2000000000, name, city || '-L', tier FROM drawn WHERE draw >= 0.10 AND draw < 0.12),
says AS (
  SELECT *, DATE '2026-01-01' AS day, FALSE AS gone, FALSE AS pin FROM d1
  UNION ALL SELECT *, DATE '2026-01-02', FALSE, FALSE FROM late
  UNION ALL
  SELECT d2.*, DATE '2026-01-03', FALSE, d1.customer_id IS NULL OR d1.city IS DISTINCT FROM d2.city OR d1.tier <> d2.tier
  FROM d2 LEFT JOIN d1 ON d1.customer_id = d2.customer_id
  WHERE d1.customer_id IS NULL OR d1.city IS DISTINCT FROM d2.city OR d1.tier <> d2.tier),""".format(
    draw=U("customer_id", "late2")) + _sql_chain(["customer_id"], ATTRS)

_PARTS = """WITH p AS (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part),
{batches},
everything AS (
  SELECT *, DATE '2026-01-01' AS day, FALSE AS gone FROM b1 UNION ALL
  SELECT *, DATE '2026-01-02', FALSE FROM b2 UNION ALL
  SELECT *, DATE '2026-01-04', FALSE FROM b4),
lost AS (
  SELECT k.p_brand, k.p_partkey, NULL, NULL, NULL, DATE '2026-01-04' AS day, TRUE AS gone
  FROM (SELECT p_brand, p_partkey FROM b1 UNION SELECT p_brand, p_partkey FROM b2) k
  WHERE k.p_partkey NOT IN (SELECT p_partkey FROM b4)),
says AS (SELECT *, FALSE AS pin FROM (SELECT * FROM everything UNION ALL SELECT * FROM lost)),""".format(
    batches=",\n".join("""b{n} AS (
  SELECT p_brand, p_partkey, CASE WHEN {c} < 0.02 THEN NULL ELSE p_type END AS p_type, p_size,
         CASE WHEN {c} >= {top} THEN cents + 100 ELSE cents END AS price_cents
  FROM p WHERE {d} < {share})""".format(n=n, c=U("p_partkey", "p%d-change" % n), d=U("p_partkey", "p%d" % n), top=1 - dear,
                                       share=share)
                       for n, share, dear in ((1, 0.9, 0.0), (2, 0.5, 0.2), (4, 0.8, 0.3)))
    ) + _sql_chain(list(PARTS.keys), list(PARTS.attrs))

_CELLS = """WITH j AS (
  SELECT CAST(o_orderdate AS DATE) AS order_date, n_name AS country, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         {draw} AS draw
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
before AS (
  SELECT order_date, CASE WHEN draw < 0.20 THEN 'UNKNOWN' ELSE country END AS country, count(*) AS orders,
         CAST(sum(CASE WHEN draw >= 0.95 THEN 2 * cents ELSE cents END) AS BIGINT) AS revenue_cents
  FROM j WHERE draw >= 0.10 GROUP BY 1, 2),
after AS (
  SELECT order_date, country, count(*) AS orders, CAST(sum(cents) AS BIGINT) AS revenue_cents FROM j GROUP BY 1, 2),
scope AS (SELECT DATE '1996-06-15' AS lo, DATE '1998-03-01' AS hi)""".format(draw=U("o_orderkey", "was"))

ORACLE = {
    "scd2_late": _LATE + "\nSELECT * FROM versions",
    "mv_refresh": _LATE + """
SELECT city, count(*) AS n, CAST(sum(customer_id) AS BIGINT) AS key_sum, min(valid_from) AS first_seen,
       max(valid_from) AS last_seen FROM versions GROUP BY city""",
    "scd2_parts": _PARTS + "\nSELECT * FROM versions",
    "gold_merge": _CELLS + """
SELECT before.* FROM before, scope WHERE NOT (order_date >= lo AND order_date < hi)
UNION ALL SELECT after.* FROM after, scope WHERE order_date >= lo AND order_date < hi""",
    "merge_actions": _CELLS + """,
b AS (SELECT before.* FROM before, scope WHERE order_date >= lo AND order_date < hi),
a AS (SELECT after.* FROM after, scope WHERE order_date >= lo AND order_date < hi),
months AS (SELECT DISTINCT date_trunc('month', order_date) AS m FROM a),
tagged AS (
  SELECT CASE WHEN b.orders IS NULL THEN 'insert' WHEN a.orders IS NULL THEN 'delete'
              WHEN a.orders = b.orders AND a.revenue_cents = b.revenue_cents THEN 'keep' ELSE 'update' END AS action
  FROM a FULL JOIN b ON a.order_date = b.order_date AND a.country = b.country)
SELECT names.action, count(tagged.action) AS cells
FROM (SELECT unnest(['insert', 'update', 'delete', 'keep']) AS action) names
LEFT JOIN tagged ON tagged.action = names.action GROUP BY names.action""",
    "cdc_apply": _D1_D2.rstrip().rstrip(",") + "\nSELECT customer_id, name, city, tier FROM d2",
}
