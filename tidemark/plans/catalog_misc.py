"""Registered layout, load, write, rollup, model and trend-gate queries
(SURVEY S5-S7, S10-S16, Q16, C8, C9, ML1-ML3, Q21, Q22)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import gates, model, relational
from tidemark.plans.catalog_dims import staging_day1
from tidemark.plans.oracle_feed import U
from tidemark.session import ensure_conf, scratch_dir
from tidemark.sources import files, layout
from tidemark.sources.tables import Tables

#: The posts' calendar runs thirty times as fast as that of the orders: every day holds a month of orders, so
#: that day partitions of the small driver tables hold more than a handful of rows.
PACE, EPOCH = 30, "1995-01-01"
DAYS_A = ("1995-01-25", "1995-02-05")
DAYS_C = ("1995-02-01", "1995-03-01")
USER_B = 7


def _posts(spark, sf_dir) -> DataFrame:
    """The layout fixture: orders as 'posts' (id, created, owner, score)."""
    o = Tables(spark, sf_dir).orders
    day = F.date_add(F.lit(EPOCH).cast("date"), F.floor(F.datediff("o_orderdate", F.lit(EPOCH)) / PACE).cast("int"))
    return o.select(F.col("o_orderkey").alias("id"), day.cast("timestamp_ntz").alias("creation_date"),
                    F.col("o_custkey").alias("owner_user_id"), F.col("o_totalprice").alias("score"))


def _summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 4).alias("avg_score"))


# ------------------------------------------------------------------ loads
def _csv(spark, sf_dir) -> str:
    path = scratch_dir(spark, "csv") + "/customers_day1"
    staging_day1(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return path


def csv_load(spark, sf_dir):
    """CSV with header and inferred schema, copied (replace) into Parquet."""
    ensure_conf(spark)
    path = _csv(spark, sf_dir)
    df = files.load_csv(spark, path, path + "_table")
    return df.select(F.col("customer_id").cast("bigint"), "name", "city", "tier")


def csv_external(spark, sf_dir):
    """The same CSV queried in place through a view with a declared schema."""
    ensure_conf(spark)
    files.external_csv(spark, _csv(spark, sf_dir), "ext_customers",
                       "customer_id bigint, name string, city string, tier string")
    return spark.sql("SELECT tier, count(*) AS n FROM ext_customers GROUP BY tier")


def ctas_slice(spark, sf_dir):
    """CREATE OR REPLACE TABLE AS SELECT (one year of orders), read back."""
    ensure_conf(spark)
    path = scratch_dir(spark, "ctas") + "/t"
    o = Tables(spark, sf_dir).orders.filter((F.col("o_orderdate") >= "1997-01-01") & (F.col("o_orderdate") < "1998-01-01"))
    files.replace_table(o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), path)
    files.replace_table(o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), path)  # idempotent
    return spark.read.parquet(path)


def append_insert(spark, sf_dir):
    """INSERT ... SELECT twice into one table (1996, then 1997)."""
    ensure_conf(spark)
    path = scratch_dir(spark, "append") + "/t"
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    files.append(o.filter(F.year("o_orderdate") == 1996), path)
    files.append(o.filter(F.year("o_orderdate") == 1997), path)
    return spark.read.parquet(path)


# ----------------------------------------------------------------- layouts
#: Least bytes per file of the clustered copies: small, so that the driver tables fill several; and the files
#: beyond which a larger table has larger ones.
LAYOUT_FILE_BYTES = 24 * 1024
LAYOUT_FILES = 256
_LAYOUTS: dict = {}


def _layouts(spark, sf_dir) -> dict:
    """The four copies of a posts table, written once per session and input."""
    ensure_conf(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _LAYOUTS and files.path_exists(spark, _LAYOUTS[key]["plain"]):
        return _LAYOUTS[key]
    root = scratch_dir(spark, "layouts")
    p = _posts(spark, sf_dir)
    out = {"plain": root + "/t_plain", "part": root + "/t_part", "part_clust": root + "/t_part_clust",
           "clust": root + "/t_clust"}
    files.replace_table(p, out["plain"])
    day = F.to_date("creation_date")
    size = layout.file_bytes_for(p.withColumn("creation_day", day), LAYOUT_FILE_BYTES, LAYOUT_FILES)
    layout.write_partitioned(p, out["part"], "creation_day", day)
    layout.write_partitioned_clustered(p, out["part_clust"], "creation_day", day, ["owner_user_id"], file_bytes=size)
    layout.write_clustered(p, out["clust"], ["owner_user_id"], file_bytes=size)
    _LAYOUTS[key] = out
    return out


def _days(lo: str, hi: str):
    return (F.col("creation_day") >= F.lit(lo).cast("date")) & (F.col("creation_day") < F.lit(hi).cast("date"))


def layout_partitioned(spark, sf_dir):
    """A range of days from the day-partitioned copy (partition pruning)."""
    return _summary(files.external_parquet(spark, _layouts(spark, sf_dir)["part"]).filter(_days(*DAYS_A)))


def layout_clustered(spark, sf_dir):
    """One owner from the clustered copy (row-group skipping)."""
    d = spark.read.parquet(_layouts(spark, sf_dir)["clust"]).filter(F.col("owner_user_id") == USER_B)
    return _summary(d)


def layout_part_clust(spark, sf_dir):
    """Some days + one owner from the copy partitioned by day and clustered by owner."""
    d = files.external_parquet(spark, _layouts(spark, sf_dir)["part_clust"]).filter(
        _days(*DAYS_C) & (F.col("owner_user_id") == USER_B))
    return _summary(d)


def guarded_scan(spark, sf_dir):
    """The guarded read accepts a partition predicate (and refuses none)."""
    lay = _layouts(spark, sf_dir)
    d = layout.guarded_read(spark, lay["part"], "creation_day",
                            "creation_day >= DATE '%s' AND creation_day < DATE '%s'" % DAYS_C)
    return _summary(d)


def partition_stats(spark, sf_dir):
    """Partition count, first and last partition of the day-partitioned copy, from the listing."""
    return layout.partition_stats(spark, _layouts(spark, sf_dir)["part"], "creation_day")


def layout_scans(spark, sf_dir) -> list[tuple]:
    """(layout, predicate, what the scan took, what a scan of that whole layout takes)."""
    lay = _layouts(spark, sf_dir)
    owner = F.col("owner_user_id") == USER_B
    stamp = lambda lo, hi: (F.col("creation_date") >= lo) & (F.col("creation_date") < hi)                  # noqa: E731
    out = []
    for name, path in lay.items():
        base = files.external_parquet(spark, path)
        by_day = name in ("part", "part_clust")
        preds = {"A_days": _days(*DAYS_A) if by_day else stamp(*DAYS_A), "B_owner": owner,
                 "C_days_owner": (_days(*DAYS_C) if by_day else stamp(*DAYS_C)) & owner}
        whole = layout.measured_scan(base.select("id"))
        out += [(name, p, layout.measured_scan(base.filter(cond).select("id", "score")), whole) for p, cond in preds.items()]
    return out


def scan_files_touched(spark, sf_dir):
    """Four layouts, three predicates: rows found, and whether the executed scan opened fewer
    files, fewer bytes and gave fewer rows than a scan of the whole layout (the figures: ``layout_scans``)."""
    rows = [(name, p, m["rows"], m["files_read"] < w["files_read"], m["bytes_read"] < w["bytes_read"],
             m["rows_read"] < w["rows_read"]) for name, p, m, w in layout_scans(spark, sf_dir)]
    return spark.createDataFrame(rows, "layout string, predicate string, rows bigint, fewer_files boolean, "
                                       "fewer_bytes boolean, fewer_rows_read boolean")


# ------------------------------------------------------------ weekday rollup
def ml_orders(spark, sf_dir) -> DataFrame:
    """Order lines as (order_id, weekday, items, unit_price, total_value)."""
    li = Tables(spark, sf_dir).lineitem
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    qty = F.col("l_quantity").cast("bigint")
    unit_cents = ((cents - F.pmod(cents, qty)) / qty).cast("bigint")
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
                     F.pmod(F.col("l_orderkey"), F.lit(7)).alias("weekday"), qty.alias("items"),
                     (unit_cents / 100.0).alias("unit_price"), F.col("l_extendedprice").alias("total_value"))


def _rollup_frame(spark, sf_dir) -> DataFrame:
    o = ml_orders(spark, sf_dir)
    rev = F.col("items").cast("decimal(18,0)") * F.col("unit_price").cast("decimal(18,2)")
    tv = F.col("total_value").cast("decimal(18,2)")
    g = o.groupBy("weekday").agg(F.count(F.lit(1)).alias("orders"), F.sum(rev).alias("rev"), F.sum(tv).alias("tv"),
                                 F.max("total_value").alias("max_order_value"))
    return g.select("weekday", "orders", F.round("rev", 2).cast("double").alias("revenue"),
                    F.round(F.col("tv") / F.col("orders"), 2).cast("double").alias("avg_order_value"),
                    "max_order_value")


def _rollup_written(spark, sf_dir) -> str:
    ensure_conf(spark)
    path = scratch_dir(spark, "weekday") + "/orders_by_weekday"
    files.replace_partitions(_rollup_frame(spark, sf_dir), path, "weekday")
    return path


ROLLUP_SCHEMA = "orders bigint, revenue double, avg_order_value double, max_order_value double, weekday bigint"


def weekday_rollup(spark, sf_dir):
    """Derived revenue, rollup by weekday, written partitioned by weekday, read back."""
    return files.external_parquet(spark, _rollup_written(spark, sf_dir), schema=ROLLUP_SCHEMA).select(
        "weekday", "orders", "revenue", "avg_order_value", "max_order_value")


def hive_external_rollup(spark, sf_dir):
    """External table over the hive-partitioned rollup (partition column typed)."""
    path = _rollup_written(spark, sf_dir)
    files.external_parquet(spark, path, "orders_by_weekday", schema=ROLLUP_SCHEMA)   # partition column typed
    return spark.sql("SELECT weekday, orders, ROUND(revenue, 0) AS revenue FROM orders_by_weekday")


def sketch_orders(spark, sf_dir):
    """A5: distinct customers per order year and over all years, from one stored sketch per order
    month; July 1997 arrives again and only its sketch is made anew. The exact counts beside it are the check."""
    ensure_conf(spark)
    o = Tables(spark, sf_dir).orders.select("o_custkey", F.trunc("o_orderdate", "month").alias("order_month"))
    path = scratch_dir(spark, "sketches") + "/customers_by_month"
    relational.keep_sketches(path, o.where("order_month != DATE '1997-07-01' or o_custkey % 2 = 0"), "order_month", "o_custkey")
    kept = relational.keep_sketches(path, o, "order_month", "o_custkey", changed=[dt.date(1997, 7, 1)])
    year = F.year("order_month").alias("order_year")
    est = relational.hll_union_estimate(kept.withColumn("order_year", F.year("order_month")), "order_year")
    est = est.unionByName(relational.hll_union_estimate(kept).withColumn("order_year", F.lit(0)))
    exact = o.groupBy(year).agg(F.count_distinct("o_custkey").alias("exact"))
    exact = exact.unionByName(o.agg(F.count_distinct("o_custkey").alias("exact")).withColumn("order_year", F.lit(0)))
    return exact.join(est, "order_year").select(
        "order_year", "exact", (relational.relative_error(F.col("approx"), F.col("exact")) <= 0.02).alias("within_2_percent"))


# -------------------------------------------------------------------- model
def _lin_frame(spark, sf_dir) -> DataFrame:
    return Tables(spark, sf_dir).lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                                                 F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))


def linreg_fit(spark, sf_dir):
    """ML1 (one feature, closed form checkable): slope and intercept."""
    m = model.train_value_model(_lin_frame(spark, sf_dir), ["x"], "y")
    (slope,), intercept = model.coefficients(m)
    return spark.createDataFrame([(round(slope, 3), round(intercept, 3))], "slope double, intercept double")


def linreg_eval(spark, sf_dir):
    """ML2: MAE and R² of the one-feature model on its data."""
    d = _lin_frame(spark, sf_dir)
    m = model.train_value_model(d, ["x"], "y")
    ev = model.evaluate(m, d, "y")
    return spark.createDataFrame([(round(ev["mae"], 3), round(ev["r2"], 6))], "mae double, r2 double")


def linreg_predict(spark, sf_dir):
    """ML3: predictions for every row, summarised."""
    d = _lin_frame(spark, sf_dir)
    p = model.predict(model.train_value_model(d, ["x"], "y"), d)
    return p.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 2).alias("avg_pred"),
                 F.round(F.min("prediction"), 2).alias("min_pred"), F.round(F.max("prediction"), 2).alias("max_pred"))


FEATURES = ["weekday", "items", "unit_price"]


def _noisy_orders(spark, sf_dir) -> DataFrame:
    """the order lines, their value off by up to 50 in a way drawn from the line's id."""
    o = ml_orders(spark, sf_dir)
    return o.withColumn("total_value", F.col("total_value") + model.noise("order_id", "noise", 50.0))


def linreg_multi(spark, sf_dir):
    """ML1 / ML2 / F11: noisy label, hash split, three features; coefficients and held-out MAE / R²."""
    train, test = model.split(_noisy_orders(spark, sf_dir), "order_id")
    fit = model.least_squares(train, FEATURES, "total_value")
    ev = model.scores(test, model.fitted(fit, FEATURES), "total_value")
    c = fit["coefficients"]
    return ev.select(F.lit(fit["n"]).cast("bigint").alias("trained_on"), F.col("n").alias("tested_on"),
                     *[F.lit(round(x, 3)).alias("b_" + f) for f, x in zip(FEATURES, c)],
                     F.lit(round(fit["intercept"], 2)).alias("intercept"), F.round("mae", 2).alias("mae"),
                     F.round("r2", 5).alias("r2"))


# -------------------------------------------------------------- trend gates
def gate_trailing(spark, sf_dir):
    """Q21: daily order volume against the average of the 7 previous days (±50%)."""
    o = Tables(spark, sf_dir).orders
    daily = o.groupBy(F.to_date("o_orderdate").alias("order_date")).agg(F.count(F.lit(1)).alias("n"))
    g = gates.gate_trailing(daily, "order_date", "n", 7, 0.5)
    return g.withColumn("trailing_avg", F.round("trailing_avg", 4))


def gate_distribution(spark, sf_dir):
    """Q22: event-type shares of the last week against the weeks before (±5 points)."""
    ev = Tables(spark, sf_dir).events
    cut = F.lit("2024-01-24 00:00:00").cast("timestamp_ntz")
    g = gates.gate_distribution(ev.filter(F.col("ts") >= cut), ev.filter(F.col("ts") < cut), "event_type", 0.05)
    return g.withColumn("share", F.round("share", 6)).withColumn("baseline_share", F.round("baseline_share", 6))


QUERIES = {f.__name__: f for f in [
    csv_load, csv_external, ctas_slice, append_insert, layout_partitioned, layout_clustered, layout_part_clust,
    guarded_scan, partition_stats, scan_files_touched, weekday_rollup, hive_external_rollup, linreg_fit,
    linreg_eval, linreg_predict, linreg_multi, sketch_orders, gate_trailing, gate_distribution]}

_POSTS = """(SELECT o_orderkey AS id, CAST(DATE '%s' + CAST(floor(date_diff('day', DATE '%s', CAST(o_orderdate AS DATE)) / %d)
            AS INTEGER) AS TIMESTAMP) AS creation_date, o_custkey AS owner_user_id, o_totalprice AS score FROM orders)""" % (
    EPOCH, EPOCH, PACE)


def _posted(days) -> str:
    return "creation_date >= TIMESTAMP '%s' AND creation_date < TIMESTAMP '%s'" % days


_ML = """(SELECT l_orderkey * 10 + l_linenumber AS order_id, l_orderkey % 7 AS weekday,
          CAST(l_quantity AS BIGINT) AS items,
          (CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) / 100.0 AS unit_price,
          l_extendedprice AS total_value,
          CAST(round(l_extendedprice * 100) AS BIGINT) AS tv_cents FROM lineitem)"""
_ROLLUP = """SELECT weekday, count(*) AS orders,
       CAST(round(sum(CAST(items AS DECIMAL(18,0)) * CAST(unit_price AS DECIMAL(18,2))), 2) AS DOUBLE) AS revenue,
       ((2 * sum(tv_cents) + count(*)) // (2 * count(*))) / 100.0 AS avg_order_value,
       max(total_value) AS max_order_value FROM %s GROUP BY weekday""" % _ML

def _det(a: list[list[str]]) -> str:
    """A 3 x 3 determinant as SQL."""
    (p, q, r), (s, t, u), (v, w, x) = a
    return "({p}*({t}*{x}-{u}*{w}) - {q}*({s}*{x}-{u}*{v}) + {r}*({s}*{w}-{t}*{v}))".format(
        p=p, q=q, r=r, s=s, t=t, u=u, v=v, w=w, x=x)


def _linreg_sql() -> str:
    """Three features by Cramer's rule on the covariances of the training rows."""
    m = [["covar_pop(%s, %s)" % (a, b) for b in FEATURES] for a in FEATURES]
    y = ["covar_pop(%s, y)" % a for a in FEATURES]
    cov = ", ".join("%s AS m%d%d" % (m[i][j], i, j) for i in range(3) for j in range(3))
    cov += ", " + ", ".join("%s AS y%d" % (y[i], i) for i in range(3))
    base = [["m%d%d" % (i, j) for j in range(3)] for i in range(3)]
    swap = [[["y%d" % i if j == k else base[i][j] for j in range(3)] for i in range(3)] for k in range(3)]
    return """WITH d AS (
      SELECT weekday, items, unit_price, total_value + (%s * 2 - 1) * 50.0 AS y, %s AS part FROM %s),
    c AS (SELECT %s, count(*) AS n, avg(weekday) AS a0, avg(items) AS a1, avg(unit_price) AS a2, avg(y) AS ay
          FROM d WHERE part < 0.8),
    b AS (SELECT n, a0, a1, a2, ay, %s AS b0, %s AS b1, %s AS b2 FROM c),
    f AS (SELECT n, b0, b1, b2, ay - b0 * a0 - b1 * a1 - b2 * a2 AS b3 FROM b)
    SELECT any_value(f.n) AS trained_on, count(*) AS tested_on, round(any_value(b0), 3) AS b_weekday,
           round(any_value(b1), 3) AS b_items, round(any_value(b2), 3) AS b_unit_price, round(any_value(b3), 2) AS intercept,
           round(avg(abs(y - (b3 + b0 * weekday + b1 * items + b2 * unit_price))), 2) AS mae,
           round(1 - sum(power(y - (b3 + b0 * weekday + b1 * items + b2 * unit_price), 2)) / (var_pop(y) * count(*)), 5) AS r2
    FROM d, f WHERE part >= 0.8""" % ((U("order_id", "noise"), U("order_id", "split"), _ML, cov) + tuple(
        "%s / %s" % (_det(x), _det(base)) for x in swap))


_LINREG = _linreg_sql()

ORACLE = {
    "csv_load": """SELECT c.c_custkey AS customer_id, c.c_name AS name, n.n_name AS city, c.c_mktsegment AS tier
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "csv_external": """SELECT c.c_mktsegment AS tier, count(*) AS n FROM customer c JOIN nation n
        ON c.c_nationkey = n.n_nationkey GROUP BY 1""",
    "ctas_slice": """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
    "append_insert": """SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
        WHERE year(o_orderdate) IN (1996, 1997)""",
    "layout_partitioned": "SELECT count(*) AS n, round(avg(score), 4) AS avg_score FROM %s WHERE %s" % (_POSTS, _posted(DAYS_A)),
    "layout_clustered": "SELECT count(*) AS n, round(avg(score), 4) AS avg_score FROM %s WHERE owner_user_id = 7" % _POSTS,
    "layout_part_clust": "SELECT count(*) AS n, round(avg(score), 4) AS avg_score FROM %s WHERE %s AND owner_user_id = 7" % (
        _POSTS, _posted(DAYS_C)),
    "guarded_scan": "SELECT count(*) AS n, round(avg(score), 4) AS avg_score FROM %s WHERE %s" % (_POSTS, _posted(DAYS_C)),
    "partition_stats": """SELECT count(DISTINCT CAST(creation_date AS DATE)) AS partitions,
        min(CAST(creation_date AS DATE)) AS first, max(CAST(creation_date AS DATE)) AS last FROM %s""" % _POSTS,
    # partitioned copies open fewer files for a range of days; clustered ones skip row groups of other owners
    "scan_files_touched": """WITH p AS (SELECT * FROM %s),
        n AS (
          SELECT 'A_days' AS predicate, count(*) AS rows FROM p WHERE %s
          UNION ALL SELECT 'B_owner', count(*) FROM p WHERE owner_user_id = 7
          UNION ALL SELECT 'C_days_owner', count(*) FROM p WHERE %s AND owner_user_id = 7)
        SELECT layout, n.predicate, n.rows, by_day AND n.predicate <> 'B_owner' AS fewer_files,
               by_day AND n.predicate <> 'B_owner' AS fewer_bytes,
               (by_day AND n.predicate <> 'B_owner') OR (by_owner AND n.predicate <> 'A_days') AS fewer_rows_read
        FROM n, (VALUES ('plain', FALSE, FALSE), ('part', TRUE, TRUE), ('part_clust', TRUE, TRUE),
                        ('clust', FALSE, TRUE)) l(layout, by_day, by_owner)""" % (
        _POSTS, _posted(DAYS_A), _posted(DAYS_C)),
    "sketch_orders": """WITH o AS (SELECT o_custkey, year(o_orderdate) AS y FROM orders)
        SELECT CAST(y AS INTEGER) AS order_year, count(DISTINCT o_custkey) AS exact, TRUE AS within_2_percent FROM o GROUP BY y
        UNION ALL SELECT 0, count(DISTINCT o_custkey), TRUE FROM o""",
    "weekday_rollup": _ROLLUP,
    "hive_external_rollup": "SELECT weekday, orders, round(revenue, 0) AS revenue FROM (%s)" % _ROLLUP,
    "linreg_fit": """SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
        round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem""",
    "linreg_eval": """WITH c AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b,
            regr_intercept(l_extendedprice, l_quantity) AS a, regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem)
        SELECT round(avg(abs(l_extendedprice - (c.a + c.b * l_quantity))), 3) AS mae, round(max(c.r2), 6) AS r2
        FROM lineitem, c""",
    "linreg_predict": """WITH c AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b,
            regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
        SELECT count(*) AS n, round(avg(c.a + c.b * l_quantity), 2) AS avg_pred,
               round(min(c.a + c.b * l_quantity), 2) AS min_pred, round(max(c.a + c.b * l_quantity), 2) AS max_pred
        FROM lineitem, c""",
    "linreg_multi": _LINREG,
    "gate_trailing": """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS n FROM orders GROUP BY 1),
        w AS (SELECT order_date, n, avg(n) OVER (ORDER BY order_date RANGE BETWEEN INTERVAL 7 DAYS PRECEDING
                AND INTERVAL 1 DAY PRECEDING) AS a FROM d)
        SELECT order_date, n, round(a, 4) AS trailing_avg,
               a IS NULL OR (n >= a * 0.5 AND n <= a * 1.5) AS passed FROM w""",
    "gate_distribution": """WITH r AS (SELECT event_type, count(*) / sum(count(*)) OVER () AS share FROM events
            WHERE ts >= TIMESTAMP '2024-01-24' GROUP BY 1),
        b AS (SELECT event_type, count(*) / sum(count(*)) OVER () AS baseline_share FROM events
            WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1)
        SELECT event_type, round(coalesce(share, 0.0), 6) AS share, round(coalesce(baseline_share, 0.0), 6) AS baseline_share,
               abs(coalesce(share, 0.0) - coalesce(baseline_share, 0.0)) <= 0.05 AS passed
        FROM r FULL OUTER JOIN b USING (event_type)""",
}
