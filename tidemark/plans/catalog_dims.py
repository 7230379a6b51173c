"""Registered dimension / recovery / governance queries.

The customer dimension comes from the driver tables: day 1 is ``customer`` joined to
``nation`` (name, city = nation name, tier = market segment); day 2 is derived from
day 1 by hash draws on the key - 5% absent, 10% new tier, 5% new city, 2% city
unknown (NULL, which must still count as a change), 5% new customers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import u01
from tidemark.operators import govern, joins, scd2, versions
from tidemark.operators.gates import GateFailed
from tidemark.plans.oracle_feed import U, with_feed
from tidemark.session import ensure_conf, scratch_dir
from tidemark.sources.tables import Tables

KEY = "customer_id"
ATTRS = ["name", "city", "tier"]
DAY1, DAY2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
NEW_KEY_OFFSET = 1_000_000_000
POLICIES = [("analyst", "city = 'NATION_1'"), ("owner", "TRUE")]
# commit instants (epoch micros) of the versioned-table scenario
T_V1, T_V2, T_V3 = 1767225600000000, 1767229200000000, 1767232800000000


def staging_day1(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    nat = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    c = joins.join_dimension(t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), nat,
                             "c_nationkey")
    return c.select(F.col("c_custkey").alias(KEY), F.col("c_name").alias("name"), "city",
                    F.col("c_mktsegment").alias("tier"))


def staging_day2(spark: SparkSession, sf_dir: str) -> DataFrame:
    d1 = staging_day1(spark, sf_dir)
    chg = u01(KEY, "chg")
    kept = d1.filter(u01(KEY, "gone") >= 0.05).select(
        KEY, "name",
        F.when((chg >= 0.10) & (chg < 0.15), F.concat(F.col("city"), F.lit("-N")))
         .when((chg >= 0.15) & (chg < 0.17), F.lit(None).cast("string")).otherwise(F.col("city")).alias("city"),
        F.when(chg < 0.10, F.lit("PLATINUM")).otherwise(F.col("tier")).alias("tier"))
    new = d1.filter(u01(KEY, "new") < 0.05).select(
        (F.col(KEY) + NEW_KEY_OFFSET).alias(KEY), F.concat(F.col("name"), F.lit("-B")).alias("name"), "city", "tier")
    return kept.unionByName(new)


def dim_day1(spark, sf_dir) -> DataFrame:
    return scd2.scd2_init(staging_day1(spark, sf_dir), KEY, ATTRS, DAY1)


def dim_day2(spark, sf_dir) -> DataFrame:
    return scd2.scd2_merge(dim_day1(spark, sf_dir), staging_day2(spark, sf_dir), KEY, ATTRS, DAY2)


# ------------------------------------------------------------------ SCD2
def scd2_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: initial load."""
    return dim_day1(spark, sf_dir)


def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: day-1 load then the day-2 batch merged into a dimension table partitioned by
    ``valid_to`` (only the current partition and the day's closed versions are rewritten)."""
    ensure_conf(spark)
    path = scratch_dir(spark, "dim-scd2") + "/dim_customer"
    scd2.scd2_publish(path, staging_day1(spark, sf_dir), KEY, ATTRS, DAY1)
    return scd2.scd2_publish(path, staging_day2(spark, sf_dir), KEY, ATTRS, DAY2)


def scd2_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New or changed staging rows (null-safe hash comparison)."""
    ins, _ = scd2.detect_changes(staging_day2(spark, sf_dir), dim_day1(spark, sf_dir), KEY, ATTRS)
    return ins


def scd2_expires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current versions that the day-2 changes expire."""
    _, exp = scd2.detect_changes(staging_day2(spark, sf_dir), dim_day1(spark, sf_dir), KEY, ATTRS)
    return exp


def dim_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as it was on 2026-01-01."""
    return scd2.as_of(dim_day2(spark, sf_dir), DAY1).select(KEY, *ATTRS)


def fact_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order joined to the customer version valid at its as-of date."""
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", F.col("o_custkey").alias(KEY),
        F.date_add(F.lit(DAY1), F.pmod(F.col("o_orderkey"), F.lit(2)).cast("int")).alias("as_of"))
    j = joins.as_of_join(o, dim_day2(spark, sf_dir).select(KEY, "tier", "city", "valid_from", "valid_to"),
                         KEY, "as_of")
    return j.select("o_orderkey", KEY, "as_of", "tier", "city")


def tier_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar SQL function (``CREATE TEMPORARY FUNCTION``) over current rows."""
    scd2.register_sql_functions(spark)
    return spark.sql("SELECT customer_id, name, tier, tier_rank(tier) AS rank FROM {d} WHERE is_current",
                     d=dim_day2(spark, sf_dir))


def tier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 'procedure' as parametrised SQL with IN parameter min_rank = 3
    (same result as ``scd2.tier_summary``, the Column form)."""
    scd2.register_sql_functions(spark)
    return spark.sql("SELECT tier, count(*) AS n FROM {d} WHERE is_current AND tier_rank(tier) >= :min_rank "
                     "GROUP BY tier", args={"min_rank": 3}, d=dim_day2(spark, sf_dir))


# ------------------------------------------------------------- versions
def _versioned(spark, sf_dir):
    """v1 = day-2 dimension, snapshot of v1, v2 = PLATINUM rows deleted."""
    ensure_conf(spark)
    root = scratch_dir(spark, "dim-versions")
    vt = versions.VersionedTable(spark, root + "/dim_customer")
    vt.commit(dim_day2(spark, sf_dir), committed_at=T_V1)
    snap = vt.snapshot(root + "/dim_snapshot", expire_after_micros=2 * 86400 * 10**6, committed_at=T_V1 + 1)
    vt.delete(F.col("tier") == "PLATINUM", committed_at=T_V2)
    return vt, snap, root


def delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: keyed delete (copy-on-write into a new version)."""
    vt, _, _ = _versioned(spark, sf_dir)
    return vt.read()


def snapshot_clone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: the snapshot still shows the rows deleted afterwards from the table."""
    _, snap, _ = _versioned(spark, sf_dir)
    return snap.read()


def as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: time travel to an instant between the load and the delete."""
    vt, _, _ = _versioned(spark, sf_dir)
    return vt.read_as_of(T_V1 + 1000)


def restore_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: deleted rows restored from the snapshot (append of filtered snapshot rows)."""
    vt, snap, _ = _versioned(spark, sf_dir)
    vt.restore(snap, F.col("tier") == "PLATINUM", committed_at=T_V3)
    return vt.read()


def rollback_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite by mistake, then roll back to version 1 (manifest only)."""
    vt, _, _ = _versioned(spark, sf_dir)
    vt.commit(dim_day1(spark, sf_dir).filter(F.lit(False)), committed_at=T_V3)   # a mistaken empty overwrite
    vt.rollback(1, committed_at=T_V3 + 1)
    return vt.read()


def as_of_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 on an append log: current state of silver orders as known at 1995-01-25."""
    from tidemark.plans.lakebuild import build_lake
    lake, _, _ = build_lake(spark, sf_dir)
    s = spark.read.parquet(lake.silver).select("order_id", "amount", "updated_at", "ingest_date")
    out = versions.log_as_of(s, ["order_id"], ["updated_at", "ingest_date"], "updated_at", "1995-01-25 00:00:00")
    return out.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def published_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary per tier, published twice; an empty dimension is refused and the table stays."""
    ensure_conf(spark)
    path = scratch_dir(spark, "summary") + "/tiers"
    dim = dim_day2(spark, sf_dir)
    scd2.publish_summary(dim_day1(spark, sf_dir), path)
    scd2.publish_summary(dim, path)
    try:
        scd2.publish_summary(dim.filter(F.lit(False)), path)
        raise AssertionError("an empty summary was published")
    except GateFailed:
        return spark.read.parquet(path)


# ----------------------------------------------------------- governance
def plain_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view over the current rows, queried by name."""
    govern.create_view(spark, "current_customers", dim_day2(spark, sf_dir).filter("is_current").drop("is_current", "valid_to"))
    return spark.sql("SELECT city, count(*) AS customers, max(valid_from) AS newest FROM current_customers GROUP BY city")


def row_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: the analyst's policy (city = 'NATION_1') over the whole dimension."""
    return govern.apply_row_policy(dim_day2(spark, sf_dir), POLICIES, "analyst")


def authorized_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows, safe columns, the base table's row policy still applied."""
    return govern.governed_view(dim_day2(spark, sf_dir), [KEY, "name", "tier"], "is_current", POLICIES, "analyst")


def column_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged column ``name`` masked for a principal without the grant."""
    d = dim_day2(spark, sf_dir).filter("is_current").select(KEY, "name", "tier")
    return govern.apply_column_policy(d, {"name": "pii"}, {"owner": {"pii"}}, "analyst", mode="mask")


QUERIES = {f.__name__: f for f in [
    scd2_init, scd2_apply, scd2_inserts, scd2_expires, dim_as_of, fact_as_of_join, tier_rank, tier_summary,
    delete_rows, snapshot_clone, as_of_version, restore_rows, rollback_version, as_of_log,
    row_policy, authorized_view, column_mask, published_summary, plain_view]}


def _h(*cols):
    return "md5(concat_ws('|', %s))" % ", ".join("coalesce(CAST(%s AS VARCHAR), '\\N')" % c for c in cols)


def _sk(key, d):
    return "md5(concat_ws('#', CAST(%s AS VARCHAR), '%s'))" % (key, d)


DIM_CTES = """WITH d1 AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS name, n.n_name AS city, c.c_mktsegment AS tier
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
d2 AS (
  SELECT customer_id, name,
         CASE WHEN chg >= 0.10 AND chg < 0.15 THEN city || '-N' WHEN chg >= 0.15 AND chg < 0.17 THEN NULL
              ELSE city END AS city,
         CASE WHEN chg < 0.10 THEN 'PLATINUM' ELSE tier END AS tier
  FROM (SELECT *, %(chg)s AS chg, %(gone)s AS gone FROM d1) WHERE gone >= 0.05
  UNION ALL
  SELECT customer_id + 1000000000, name || '-B', city, tier FROM d1 WHERE %(new)s < 0.05),
h1 AS (SELECT *, %(h)s AS row_hash FROM d1),
h2 AS (SELECT *, %(h)s AS h FROM d2),
changed AS (SELECT h1.customer_id FROM h1 JOIN h2 ON h1.customer_id = h2.customer_id
            WHERE h1.row_hash IS DISTINCT FROM h2.h),
dim1 AS (
  SELECT %(sk1)s AS sk, customer_id, name, city, tier, row_hash, DATE '2026-01-01' AS valid_from,
         DATE '9999-12-31' AS valid_to, TRUE AS is_current FROM h1),
dim AS (
  SELECT sk, customer_id, name, city, tier, row_hash, valid_from,
         CASE WHEN customer_id IN (SELECT customer_id FROM changed) THEN DATE '2026-01-02' ELSE valid_to END AS valid_to,
         customer_id NOT IN (SELECT customer_id FROM changed) AS is_current
  FROM dim1
  UNION ALL
  SELECT %(sk2)s, customer_id, name, city, tier, h, DATE '2026-01-02', DATE '9999-12-31', TRUE
  FROM h2 WHERE customer_id IN (SELECT customer_id FROM changed)
             OR customer_id NOT IN (SELECT customer_id FROM h1))
""" % {"chg": U("customer_id", "chg"), "gone": U("customer_id", "gone"), "new": U("customer_id", "new"),
       "h": _h("name", "city", "tier"), "sk1": _sk("customer_id", "2026-01-01"), "sk2": _sk("customer_id", "2026-01-02")}
DIM_COLS = "sk, customer_id, name, city, tier, row_hash, valid_from, valid_to, is_current"

ORACLE = {
    "scd2_init": DIM_CTES + "SELECT %s FROM dim1" % DIM_COLS,
    "scd2_apply": DIM_CTES + "SELECT %s FROM dim" % DIM_COLS,
    "scd2_inserts": DIM_CTES + """SELECT h2.customer_id, h2.name, h2.city, h2.tier, h2.h FROM h2
        LEFT JOIN h1 ON h1.customer_id = h2.customer_id
        WHERE h1.customer_id IS NULL OR h1.row_hash IS DISTINCT FROM h2.h""",
    "scd2_expires": DIM_CTES + "SELECT %s FROM dim1 WHERE customer_id IN (SELECT customer_id FROM changed)" % DIM_COLS,
    "dim_as_of": DIM_CTES + """SELECT customer_id, name, city, tier FROM dim
        WHERE valid_from <= DATE '2026-01-01' AND DATE '2026-01-01' < valid_to""",
    "fact_as_of_join": DIM_CTES + """, o AS (SELECT o_orderkey, o_custkey AS customer_id,
            DATE '2026-01-01' + CAST(o_orderkey %% 2 AS INTEGER) AS as_of FROM orders)
        SELECT o.o_orderkey, o.customer_id, o.as_of, d.tier, d.city FROM o LEFT JOIN dim d
        ON o.customer_id = d.customer_id AND o.as_of >= d.valid_from AND o.as_of < d.valid_to""".replace("%%", "%"),
    "tier_rank": DIM_CTES + """SELECT customer_id, name, tier,
        CASE tier WHEN 'PLATINUM' THEN 4 WHEN 'GOLD' THEN 3 WHEN 'SILVER' THEN 2 ELSE 1 END AS rank
        FROM dim WHERE is_current""",
    "tier_summary": DIM_CTES + """SELECT tier, count(*) AS n FROM dim WHERE is_current
        AND CASE tier WHEN 'PLATINUM' THEN 4 WHEN 'GOLD' THEN 3 WHEN 'SILVER' THEN 2 ELSE 1 END >= 3 GROUP BY tier""",
    "delete_rows": DIM_CTES + "SELECT %s FROM dim WHERE tier IS DISTINCT FROM 'PLATINUM'" % DIM_COLS,
    "snapshot_clone": DIM_CTES + "SELECT %s FROM dim" % DIM_COLS,
    "as_of_version": DIM_CTES + "SELECT %s FROM dim" % DIM_COLS,
    "restore_rows": DIM_CTES + "SELECT %s FROM dim" % DIM_COLS,
    "rollback_version": DIM_CTES + "SELECT %s FROM dim" % DIM_COLS,
    "published_summary": DIM_CTES + "SELECT tier, count(*) AS customers FROM dim WHERE is_current GROUP BY tier",
    "plain_view": DIM_CTES + """SELECT city, count(*) AS customers, max(valid_from) AS newest FROM dim
        WHERE is_current GROUP BY city""",
    "row_policy": DIM_CTES + "SELECT %s FROM dim WHERE city = 'NATION_1'" % DIM_COLS,
    "authorized_view": DIM_CTES + "SELECT customer_id, name, tier FROM dim WHERE city = 'NATION_1' AND is_current",
    "column_mask": DIM_CTES + "SELECT customer_id, md5(name) AS name, tier FROM dim WHERE is_current",
    "as_of_log": with_feed("""
SELECT order_id, amount, updated_at, ingest_date FROM silver WHERE updated_at <= TIMESTAMP '1995-01-25 00:00:00'
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, ingest_date DESC) = 1"""),
}
