"""Joins (J1-J11) with a size-checked broadcast.

A side is broadcast only after a bounded action proves it holds at most
``max_dim_rows`` rows (``limit(max+1).count()`` reads at most max+1 rows per
partition). Beyond that bound the join is left to the shuffle strategies, where
AQE may still switch to a broadcast from *measured* shuffle sizes, or split skewed
partitions (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default bound for an explicit broadcast: narrow dimension rows.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """Bounded check: True when ``df`` has <= max_rows rows.

    Costs at most one key-less pass over the candidate side (which the join reads
    anyway); nothing but a count reaches the driver."""
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint broadcast only for a side proven small; otherwise return it unchanged."""
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_dim_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Fact-to-dimension equi-join; the dimension is broadcast when proven small."""
    return fact.join(maybe_broadcast(dim, max_dim_rows), on=on, how=how)


def semi_filter(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys`` (``IN UNNEST(...)``).

    The key side is de-duplicated first (partial aggregation shrinks it before any
    shuffle); AQE turns the join into a broadcast when that side is measured small."""
    return df.join(keys.select(*([on] if isinstance(on, str) else on)).distinct(), on=on, how="left_semi")


def anti_filter(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``keys`` (NOT EXISTS / NOT MATCHED)."""
    return df.join(keys.select(*([on] if isinstance(on, str) else on)).distinct(), on=on, how="left_anti")


def detect_changes(src: DataFrame, cur: DataFrame, key: str, hash_col: str):
    """(new or changed source rows, current rows that a change expires).

    The hash comparison is null-safe (``<=>``), so a NULL hash is still a change."""
    c = cur.select(F.col(key).alias("_k"), F.col(hash_col).alias("_h"))
    j = src.join(c, src[key] == c["_k"], "left")
    inserts = j.filter(F.col("_k").isNull() | ~(F.col(hash_col).eqNullSafe(F.col("_h")))).drop("_k", "_h")
    expires = (src.join(c, src[key] == c["_k"], "inner")
               .filter(~F.col(hash_col).eqNullSafe(F.col("_h"))).drop("_k", "_h"))
    return inserts, expires


def as_of_join(fact: DataFrame, dim: DataFrame, key: str, at: Column | str,
               valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Attach the dimension version whose ``[valid_from, valid_to)`` holds ``at``.

    An equi-join on the key plus a range predicate: Spark plans it as a shuffled
    (or broadcast) hash/sort-merge join with the range as a post-join condition, so
    only versions of the same key are compared."""
    at = F.col(at) if isinstance(at, str) else at
    d = dim.withColumnRenamed(key, "_dim_key")
    cond = (fact[key] == d["_dim_key"]) & (at >= d[valid_from]) & (at < d[valid_to])
    return fact.join(d, cond, "left").drop("_dim_key")


def salted_join(fact: DataFrame, dim: DataFrame, key: str, salt_buckets: int, how: str = "inner") -> DataFrame:
    """Spread a hot key over ``salt_buckets`` tasks.

    Fact rows get a salt from a hash of the whole row; dimension rows are replicated
    once per salt value, so the output is exactly the plain join. Right and full joins
    would repeat unmatched dimension rows once per salt, so they are refused."""
    if how not in ("inner", "left", "left_outer", "left_semi", "semi", "left_anti", "anti"):
        raise ValueError("salted_join keeps the fact side only: %r is not supported" % how)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salt_buckets))
    f = fact.withColumn("_salt", salt)
    d = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return f.join(d, [key, "_salt"], how).drop("_salt")


def hot_keys(fact: DataFrame, key: str, min_share: float = 0.01) -> list:
    """Keys holding at least ``min_share`` of the rows: at most 1 / ``min_share`` of them.

    Counted over all rows; the counts are combined map-side, so a hot key reaches the
    shuffle as one row per task. Nulls join nothing and are left out."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot = counts.where(F.col(key).isNotNull() & (F.col("_n") >= F.lit(min_share) * total))
    return [r[0] for r in hot.select(key).collect()]


def heavy_hitters(fact: DataFrame, key: str, rows_per_task: int, tracked: int = 10_000) -> dict:
    """Keys with more than ``rows_per_task`` rows, and how many tasks each needs.

    One pass, a summary of at most ``tracked`` keys per task (frequent items; no shuffle by key).
    Its counts are never too low by more than a ``tracked``-th of the rows, so every key beyond that is
    found. A key that is missed or overcounted only gets another number of salts: the join stays exact."""
    top = fact.where(F.col(key).isNotNull()).agg(
        F.expr("approx_top_k(`%s`, %d, %d)" % (key, min(tracked, 10_000), max(tracked, 10_000))).alias("t")).first()
    return {r["item"]: -(-r["count"] // rows_per_task) for r in (top["t"] or []) if r["count"] > rows_per_task}


def _unmatched(dim: DataFrame, fact: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Dimension rows that no fact row has the key of (NULL keys among them), in the join's columns."""
    keys = fact.select(key).where(F.col(key).isNotNull()).distinct()
    lone = dim.join(keys, key, "left_anti")
    return lone.select(*[F.col(c) if c in dim.columns else F.lit(None).cast(fact.schema[c].dataType).alias(c)
                         for c in columns])


def weighted_salt_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", rows_per_task: int = 2_000_000,
                       tracked: int = 10_000) -> DataFrame:
    """A join in which every heavy key has its own number of salts.

    A key with n times ``rows_per_task`` rows is dealt to n tasks and its dimension
    rows are repeated n times; other keys are joined as they are. A salt depends on the row and on the task
    that reads it, so rows alike in every column are dealt out too, and a task that runs again deals as before.
    Exact for every join type: right and full joins are the fact-side join and the dimension
    rows without a fact row, added once."""
    if how in ("right", "right_outer", "full", "outer", "full_outer"):
        part = weighted_salt_join(fact, dim, key, "inner" if how.startswith("right") else "left", rows_per_task, tracked)
        return part.unionByName(_unmatched(dim, fact, key, part.columns))
    salts = heavy_hitters(fact, key, rows_per_task, tracked)
    if not salts:
        return fact.join(dim, key, how)
    # at most ``tracked`` rows: the side that is broadcast is bounded
    many = fact.sparkSession.createDataFrame(list(salts.items()), "_k string, _salts long" if isinstance(
        next(iter(salts)), str) else "_k %s, _salts long" % fact.schema[key].dataType.simpleString())
    many = F.broadcast(many)
    f = fact.join(many, fact[key] == many["_k"], "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*[fact[c] for c in fact.columns], F.spark_partition_id()),
                        F.coalesce("_salts", F.lit(1)))).drop("_k", "_salts")
    d = dim.join(many, dim[key] == many["_k"], "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1))).drop("_k", "_salts")
    return f.join(d, [key, "_salt"], how).drop("_salt")


def skew_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", min_share: float = 0.01,
              max_hot_dim_rows: int = DEFAULT_MAX_BROADCAST_ROWS, salt_buckets: int = 64) -> DataFrame:
    """Split hot keys off a fact-to-dimension join.

    A provably small dimension is simply broadcast. Otherwise rows of hot keys (one
    key may hold a third of the fact) join a broadcast of just
    the hot dimension rows - proven small first - so they never cross the network or
    pile into one task; if those rows are not provably small, the hot part takes a
    salted join instead. The rest takes the ordinary shuffle join (where AQE's skew
    handling still applies). The union is exactly the plain join, for right and full
    joins by adding the dimension rows without a fact row."""
    if how in ("right", "right_outer", "full", "outer", "full_outer"):
        part = skew_join(fact, dim, key, "inner" if how.startswith("right") else "left", min_share, max_hot_dim_rows, salt_buckets)
        return part.unionByName(_unmatched(dim, fact, key, part.columns))
    if has_at_most(dim, max_hot_dim_rows):
        # the whole dimension is provably small: a broadcast join never shuffles the
        # fact, so no key can be hot
        return fact.join(F.broadcast(dim), key, how)
    hot = hot_keys(fact, key, min_share)
    if not hot:
        return fact.join(dim, key, how)
    is_hot = F.col(key).isin(hot)
    hot_dim = dim.filter(is_hot)
    if has_at_most(hot_dim, max_hot_dim_rows):
        hot_part = fact.filter(is_hot).join(F.broadcast(hot_dim), key, how)
    else:
        hot_part = salted_join(fact.filter(is_hot), hot_dim, key, salt_buckets, how)
    cold_part = fact.filter(~is_hot | F.col(key).isNull()).join(dim.filter(~is_hot), key, how)
    return hot_part.unionByName(cold_part)
