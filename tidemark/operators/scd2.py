"""Versioned (SCD type 2) dimensions.

First load, change detection, as-of reads and the tier reports; batches are merged by
``operators.history`` (any key, any attributes, late batches) and the tier view is kept by
``operators.views``.

Rules: the change hash is null-safe (D9); surrogate keys are md5(key, valid_from),
so re-applying a batch is a no-op; keys missing from the batch stay current unless
``close_missing=True`` (D10, reference behaviour is the default).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash, surrogate_key
from tidemark.operators import history
from tidemark.operators.history import OPEN_END, Dimension
from tidemark.operators.views import View


# Tier ranking of the customer dimension.
TIER_RANKS = [("PLATINUM", 4), ("GOLD", 3), ("SILVER", 2)]


def scd2_init(staging: DataFrame, key: str, attrs: list[str], effective) -> DataFrame:
    """M5: first load - every staging row becomes the current version."""
    eff = F.lit(effective).cast("date")
    return staging.select(
        surrogate_key(F.col(key), eff).alias("sk"), F.col(key), *[F.col(a) for a in attrs],
        row_hash(*attrs).alias("row_hash"), eff.alias("valid_from"),
        F.lit(OPEN_END).alias("valid_to"), F.lit(True).alias("is_current"))


def detect_changes(staging: DataFrame, dim: DataFrame, key: str, attrs: list[str]):
    """(new-or-changed staging rows, current rows those changes expire)."""
    s = staging.withColumn("h", row_hash(*attrs))
    cur = dim.filter(F.col("is_current")).select(F.col(key).alias("_ck"), F.col("row_hash").alias("_ch"), "sk")
    j = s.join(cur, s[key] == cur["_ck"], "left")
    inserts = j.filter(F.col("_ck").isNull() | ~F.col("h").eqNullSafe(F.col("_ch"))).select(key, *attrs, "h")
    expires = (dim.filter(F.col("is_current")).join(s.select(F.col(key).alias("_sk2"), "h"),
                                                    F.col(key) == F.col("_sk2"), "inner")
               .filter(~F.col("row_hash").eqNullSafe(F.col("h"))).drop("_sk2", "h"))
    return inserts, expires


def scd2_merge(dim: DataFrame, staging: DataFrame, key, attrs: list[str], effective,
               close_missing: bool = False) -> DataFrame:
    """M4: the dimension after the batch of ``effective``, late batches spliced in (``operators.history``)."""
    return history.spliced(dim, staging, Dimension.of(key, attrs), effective, close_missing)


def as_of(dim: DataFrame, date) -> DataFrame:
    """The dimension as it was on ``date`` (``valid_from <= d < valid_to``)."""
    d = F.lit(date).cast("date")
    return dim.filter((F.col("valid_from") <= d) & (d < F.col("valid_to")))


def tier_rank(tier: Column | str) -> Column:
    """CASE t WHEN 'PLATINUM' THEN 4 WHEN 'GOLD' THEN 3 WHEN 'SILVER' THEN 2 ELSE 1 END."""
    t = F.col(tier) if isinstance(tier, str) else tier
    out = None
    for name, rank in TIER_RANKS:
        out = F.when(t == name, F.lit(rank)) if out is None else out.when(t == name, F.lit(rank))
    return out.otherwise(F.lit(1))


def tier_summary(dim: DataFrame, min_rank: int = 3) -> DataFrame:
    """Current rows with rank >= min_rank, counted per tier."""
    cur = dim.filter(F.col("is_current") & (tier_rank("tier") >= min_rank))
    return cur.groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


#: U4 (materialized view body): versions per tier and first valid_from.
TIER_COUNTS = View(groups=("tier",), minima={"first_seen": "valid_from"})


def tier_counts(dim: DataFrame) -> DataFrame:
    """U4: the view over the whole dimension."""
    return TIER_COUNTS.full(dim)


def refresh_tier_counts(previous: DataFrame, added: DataFrame, removed: DataFrame | None = None,
                        new_dim: DataFrame | None = None) -> DataFrame:
    """U4: the view after versions were added and removed, from those and ``previous``
    (``new_dim`` is read for tiers whose first version was withdrawn, and only then)."""
    return TIER_COUNTS.refresh(previous, added, added.limit(0) if removed is None else removed, new_dim)


def publish_summary(dim: DataFrame, target: str) -> str:
    """Current rows counted per tier; a non-empty gate (Q4) refuses an empty summary before the
    whole table is replaced (S10), so the last good one stays."""
    from tidemark.operators.gates import GateFailed, gate_nonempty
    from tidemark.sources import files
    summary = dim.filter(F.col("is_current")).groupBy("tier").agg(F.count(F.lit(1)).alias("customers"))
    if not gate_nonempty(summary):
        raise GateFailed("no current rows: the summary at %s is left as it is" % target)
    return files.replace_table(summary, target)


def scd2_publish(dim_path: str, staging: DataFrame, key, attrs: list[str], effective,
                 close_missing: bool = False) -> DataFrame:
    """M4 as table maintenance that rewrites only what changes: the table is partitioned by
    ``valid_to``, so a batch of the newest day replaces the open versions and those closed that
    day, and one that comes late the partitions in which it changed a version."""
    return history.apply_batch(dim_path, staging, Dimension.of(key, attrs), effective, close_missing).table


def register_sql_functions(spark) -> None:
    """U1 as SQL: temporary SQL scalar functions (inlined by the optimizer, no Python),
    for users who write Spark SQL rather than Column expressions."""
    cases = " ".join("WHEN '%s' THEN %d" % (name, rank) for name, rank in TIER_RANKS)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tier_rank(t STRING) RETURNS INT "
              "RETURN CASE t %s ELSE 1 END" % cases)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION u01(n BIGINT, salt STRING) RETURNS DOUBLE RETURN "
              "pmod(CAST(conv(substring(md5(concat(CAST(n AS STRING), ':', salt)), 1, 15), 16, 10) AS BIGINT), "
              "1000000) / 1000000.0")
