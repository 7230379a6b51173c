"""Latest version per key, with a total order.

Implemented as an aggregate, ``max(struct(order..., tie_break, payload...))`` per
key: lexicographic struct order gives "latest, then tie-break", and an aggregate is
combined map-side before the shuffle, so a hot key (a replay storm on one order id)
reaches the final task as one row per map task instead of as every copy. The
window form (``row_number() = 1``) is kept for callers that want it; Spark plans it
with a partial ``WindowGroupLimit`` before the exchange.

Ties on the order columns are broken by a 64-bit hash of the payload and then by
the payload itself (D1), so the result never depends on task order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def latest_per_key(df: DataFrame, keys: list[str], order: list[str], method: str = "aggregate",
                   tie_break: bool = True, also: dict | None = None) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``order`` (then payload hash). ``also``: names and further
    aggregates over all rows of a key, from the same shuffle."""
    payload = [c for c in df.columns if c not in keys]
    # maps are neither orderable nor hashable: they cannot sit inside max(struct) and
    # are left out of the tie-break (the window form carries them along)
    plain = [c for c in payload if "map<" not in df.schema[c].dataType.simpleString()]
    if len(plain) < len(payload):
        method = "window"
    if method == "window":
        if also:
            raise ValueError("the window form has no further aggregates")
        w = Window.partitionBy(*keys).orderBy(
            *[F.col(c).desc_nulls_last() for c in order],
            *([F.xxhash64(*[F.col(c) for c in plain]).desc()] if tie_break and plain else []),
            *[F.col(c).desc_nulls_last() for c in plain])
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    top_fields = [F.col(c).alias("_o%d" % i) for i, c in enumerate(order)]
    if tie_break:
        top_fields.append(F.xxhash64(*[F.col(c) for c in payload]).alias("_tb"))
    # the order columns are in front already: they cross the shuffle once
    top_fields += [F.col(c) for c in payload if c not in order]
    held = {c: "_top._o%d" % i for i, c in reversed([*enumerate(order)])}
    return (df.groupBy(*keys)
            .agg(F.max(F.struct(*top_fields)).alias("_top"), *[a.alias(n) for n, a in (also or {}).items()])
            .select(*keys, *[F.col(held.get(c, "_top." + c)).alias(c) for c in payload], *(also or {})))


def current_state(df: DataFrame, keys: list[str], order: list[str], also: dict | None = None) -> DataFrame:
    """The current version of every key across all partitions of a log."""
    return latest_per_key(df, keys, order, also=also)
