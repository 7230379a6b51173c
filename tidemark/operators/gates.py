"""Q1-Q4, Q8, Q9, Q21, Q22: quality gates and freshness as distributed aggregates.

All gates of a run share ONE aggregate pass over the new partition; the result is a
small frame (one row per gate) that a caller may collect and act on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateFailed(RuntimeError):
    pass


def run_gates(df: DataFrame, volume: tuple[int, int] | None = None, key: str | None = None,
              invalid: dict[str, str] | None = None) -> DataFrame:
    """Q1 volume in [lo, hi], Q2 no invalid rows, Q3 key unique, Q4 non-empty.

    Output: gate, value (bigint), passed (boolean) - one row per gate."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if key:
        aggs.append(F.count_distinct(F.col(key)).alias("distinct_keys"))
        aggs.append(F.count(F.col(key)).alias("keyed_rows"))
    for name, pred in (invalid or {}).items():
        aggs.append(F.count_if(F.coalesce(F.expr(pred), F.lit(False))).alias("inv_" + name))
    a = df.agg(*aggs)
    rows = []
    if volume:
        lo, hi = volume
        rows.append((F.lit("volume"), F.col("rows"), (F.col("rows") >= lo) & (F.col("rows") <= hi)))
    for name in (invalid or {}):
        rows.append((F.lit("no_" + name), F.col("inv_" + name), F.col("inv_" + name) == 0))
    if key:
        rows.append((F.lit("unique_" + key), F.col("rows") - F.col("distinct_keys"),
                     (F.col("rows") == F.col("distinct_keys")) & (F.col("keyed_rows") == F.col("rows"))))
    rows.append((F.lit("non_empty"), F.col("rows"), F.col("rows") > 0))
    arr = F.array(*[F.struct(g.alias("gate"), v.cast("bigint").alias("value"), p.alias("passed"))
                    for g, v, p in rows])
    return a.select(F.inline(arr))


def enforce(gates_df: DataFrame) -> None:
    """Raise when any gate failed (the result is one row per gate: tiny)."""
    failed = [r["gate"] for r in gates_df.filter(~F.col("passed")).collect()]
    if failed:
        raise GateFailed("gates failed: %s" % ", ".join(failed))


def gate_nonempty(df: DataFrame) -> bool:
    """Q4: refuse to publish an empty table."""
    return not df.isEmpty()


def minutes_between(start: Column, end: Column) -> Column:
    """TIMESTAMP_DIFF(end, start, MINUTE): whole minutes, truncated."""
    return F.timestamp_diff("MINUTE", start, end)


def freshness_report(meta: DataFrame, table_col: str, modified_ms_col: str, now: str,
                     sla_minutes: int = 60) -> DataFrame:
    """Q8: per table, last update (from epoch ms), minutes stale and status.

    ``now`` is an argument (never CURRENT_TIMESTAMP) so the report is reproducible."""
    last = F.timestamp_millis(F.col(modified_ms_col)).cast("timestamp_ntz")
    stale = minutes_between(last, F.lit(now).cast("timestamp_ntz"))
    return meta.select(F.col(table_col).alias("table_id"), last.alias("last_updated"),
                       stale.alias("minutes_stale"),
                       F.when(stale > sla_minutes, F.lit("STALE - ALERT")).otherwise(F.lit("ok")).alias("status"))


def freshness_of(df: DataFrame, built_col: str, now: str, sla_minutes: int = 60) -> DataFrame:
    """Q9: minutes since ``max(built_col)``; stale when above the SLA or empty."""
    a = df.agg(F.max(F.col(built_col).cast("timestamp_ntz")).alias("last_built"))
    stale = minutes_between(F.col("last_built"), F.lit(now).cast("timestamp_ntz"))
    return a.select("last_built", stale.alias("minutes_stale"),
                    (F.col("last_built").isNull() | (stale > sla_minutes)).alias("stale"))


def gate_trailing(daily: DataFrame, date_col: str, value_col: str, days: int = 7,
                  tolerance: float = 0.5) -> DataFrame:
    """A date's volume against the average of the ``days`` calendar days before it.

    Each date's value is dealt to the ``days`` dates after it and averaged there, so a missing
    day does not widen the window and no task holds the whole history. A date with no
    history passes."""
    d = F.col(date_col).cast("date")
    later = daily.select(F.explode(F.sequence(F.date_add(d, 1), F.date_add(d, days))).alias("_day"),
                         F.col(value_col).alias("_v"))
    before = later.groupBy("_day").agg(F.avg("_v").alias("trailing_avg"))
    avg = F.col("trailing_avg")
    lo, hi = avg * (1 - tolerance), avg * (1 + tolerance)
    return daily.join(before, d == F.col("_day"), "left").select(
        date_col, value_col, "trailing_avg",
        (avg.isNull() | ((F.col(value_col) >= lo) & (F.col(value_col) <= hi))).alias("passed"))


def gate_distribution(df: DataFrame, baseline: DataFrame, col: str, tolerance: float = 0.05) -> DataFrame:
    """Q22: category shares against a baseline; a category missing on one side counts as share 0."""
    def shares(d: DataFrame, name: str) -> DataFrame:
        c = d.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        return c.select(col, (F.col("_n") / c.agg(F.sum("_n")).scalar()).alias(name))
    j = shares(df, "share").join(shares(baseline, "baseline_share"), col, "full")
    diff = F.abs(F.coalesce(F.col("share"), F.lit(0.0)) - F.coalesce(F.col("baseline_share"), F.lit(0.0)))
    return j.select(col, F.coalesce(F.col("share"), F.lit(0.0)).alias("share"),
                    F.coalesce(F.col("baseline_share"), F.lit(0.0)).alias("baseline_share"),
                    (diff <= tolerance).alias("passed"))


def gate_volume(df: DataFrame, lo: int, hi: int) -> DataFrame:
    """Q1: row count within [lo, hi]."""
    return run_gates(df, volume=(lo, hi)).filter(F.col("gate") == "volume")


def gate_valid(df: DataFrame, preds: dict[str, str]) -> DataFrame:
    """Q2: no row matches any invalid-row predicate."""
    return run_gates(df, invalid=preds).filter(F.col("gate").startswith("no_"))


def gate_unique(df: DataFrame, key: str) -> DataFrame:
    """Q3: count(*) = count(DISTINCT key) and the key is never NULL."""
    return run_gates(df, key=key).filter(F.col("gate") == "unique_" + key)


def assert_fresh(df: DataFrame, built_col: str, now: str, sla_minutes: int = 60) -> int:
    """Q9: raise when the newest ``built_col`` is older than the SLA (or there is none)."""
    r = freshness_of(df, built_col, now, sla_minutes).first()
    if r["stale"]:
        raise GateFailed("stale: %s minutes" % r["minutes_stale"])
    return int(r["minutes_stale"])


def reconcile(truth: DataFrame, actual: DataFrame, keys: list[str], measures: list[str],
              tol: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """Full outer join on ``keys``; per cell both sides, and a one-row
    summary: cells, cells missing on one side, mismatches per measure beyond ``tol``
    (the first measure compared exactly), largest absolute difference of each measure, the
    first measure's sum on both sides."""
    t = truth.select(*keys, *[F.col(m).alias("truth_" + m) for m in measures])
    a = actual.select(*keys, *[F.col(m).alias("actual_" + m) for m in measures])
    cells = t.join(a, keys, "full")
    first = measures[0]
    aggs = [F.count(F.lit(1)).alias("cells_compared"),
            F.count_if(F.col("truth_" + first).isNull() | F.col("actual_" + first).isNull())
            .alias("cells_missing_on_one_side")]
    for i, m in enumerate(measures):
        diff = F.abs(F.col("actual_" + m) - F.col("truth_" + m))
        aggs.append(F.count_if(diff != 0 if i == 0 else diff > tol).alias("%s_mismatches" % m))
        aggs.append(F.coalesce(F.max(diff), F.lit(0)).alias("max_%s_diff" % m))
    aggs += [F.sum(side + first).alias(side + first) for side in ("truth_", "actual_")]
    return cells, cells.agg(*aggs)
