"""Typing, one-outcome-per-row scoring, outcome profile, breaker.

Every row gets exactly one outcome: the name of the first rule it fails, or NULL
(valid). ``valid`` and ``rejected`` are complementary filters on that single column,
so no row can fall between two filters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The order-feed rules, in the order they are checked.
ORDER_RULES_SQL = [
    ("malformed_json", "_corrupt_record IS NOT NULL"),
    ("missing_order_id", "order_id IS NULL"),
    ("missing_country", "country IS NULL"),
    ("bad_or_missing_order_ts", "order_ts_t IS NULL"),
    ("bad_or_missing_updated_at", "updated_at_t IS NULL"),
    ("bad_or_missing_amount", "amount_d IS NULL"),
    ("negative_amount", "amount_d < 0"),
    ("bad_or_missing_items", "items_i IS NULL"),
    ("non_positive_items", "items_i <= 0"),
]
DEFAULT_MAX_REJECT_RATE = 0.05


def try_typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add typed copies; bad input becomes NULL, never an exception (ANSI-safe)."""
    out = df
    for name, (src, typ) in types.items():
        c = F.col(src)
        if typ == "timestamp":
            typed = F.try_to_timestamp(c)
        else:
            typed = c.try_cast(typ)
        out = out.withColumn(name, typed)
    return out


def type_order_fields(raw: DataFrame) -> DataFrame:
    return try_typed(raw, {"items_i": ("items", "int"), "amount_d": ("amount", "double"),
                           "order_ts_t": ("order_ts", "timestamp"),
                           "updated_at_t": ("updated_at", "timestamp")})


def reason_expr(rules: list[tuple[str, Column | str]]) -> Column:
    """P5: chained CASE; the first failing rule names the outcome, NULL = valid.

    Predicates must be written null-safe (a NULL predicate counts as 'passes')."""
    out = None
    for name, pred in rules:
        p = F.expr(pred) if isinstance(pred, str) else pred
        p = F.coalesce(p, F.lit(False))
        out = F.when(p, F.lit(name)) if out is None else out.when(p, F.lit(name))
    return out


def score(df: DataFrame, rules=None, col: str = "reject_reason") -> DataFrame:
    return df.withColumn(col, reason_expr(rules or ORDER_RULES_SQL))


def split(scored: DataFrame, col: str = "reject_reason"):
    """(valid, rejected) - complementary by construction."""
    return scored.filter(F.col(col).isNull()), scored.filter(F.col(col).isNotNull())


def outcome_profile(scored: DataFrame, col: str = "reject_reason") -> DataFrame:
    """Rows per outcome (NULL = valid) plus total and share, one small result."""
    counts = scored.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    w = Window.partitionBy()
    return counts.withColumn("total", F.sum("n").over(w)).withColumn("share", F.col("n") / F.col("total"))


@dataclass
class BreakerDecision:
    rows_in: int
    rejected: int
    reject_rate: float
    max_rate: float
    tripped: bool
    reason: str


def breaker(counts: dict, max_rate: float = DEFAULT_MAX_REJECT_RATE) -> BreakerDecision:
    """Q5: trip when the reject share is strictly above ``max_rate`` or there is no input.

    ``counts`` maps outcome (None = valid) to rows, e.g. from an observation."""
    valid = int(counts.get(None, 0) or 0)
    rejected = sum(int(v or 0) for k, v in counts.items() if k is not None)
    n = valid + rejected
    if n == 0:
        return BreakerDecision(0, 0, 0.0, max_rate, True, "no_rows")
    rate = rejected / n
    tripped = rate > max_rate
    return BreakerDecision(n, rejected, rate, max_rate, tripped, "reject_rate" if tripped else "ok")


def breaker_frame(scored: DataFrame, max_rate: float = DEFAULT_MAX_REJECT_RATE,
                  col: str = "reject_reason") -> DataFrame:
    """Q5 as a distributed one-row result: rows, rejected, rate, tripped."""
    agg = scored.agg(F.count(F.lit(1)).alias("rows_in"),
                     F.count(F.col(col)).alias("rejected"))
    rate = F.when(F.col("rows_in") > 0, F.col("rejected") / F.col("rows_in"))
    return agg.select(
        "rows_in", "rejected",
        F.coalesce(rate, F.lit(0.0)).alias("reject_rate"),
        ((F.col("rows_in") == 0) | (F.coalesce(rate, F.lit(0.0)) > F.lit(max_rate))).alias("tripped"))


def check_breaker(profile: DataFrame, max_rate: float = DEFAULT_MAX_REJECT_RATE,
                  col: str = "reject_reason") -> BreakerDecision:
    """Q5 on an outcome profile frame (A8 output: one small row per outcome)."""
    return breaker({r[col]: r["n"] for r in profile.collect()}, max_rate)
