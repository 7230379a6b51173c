"""Relational operators (P1-P3, P7-P10, A1-A15, O1-O3, SO1) as thin DataFrame functions.

They exist so user code reads like the reference's queries while Catalyst does the
work: projections prune the scan, filters are pushed to Parquet, aggregates run
partial-then-final, ``orderBy().limit()`` becomes ``TakeOrderedAndProject``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.files import external_parquet, replace_partitions


def in_range(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    """Half-open range ``lo <= ts < hi`` (pushed down to the scan)."""
    return df.filter((F.col(ts) >= F.lit(lo).cast("timestamp_ntz")) & (F.col(ts) < F.lit(hi).cast("timestamp_ntz")))


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """A1: rows per key (or one global count)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def money_sum(c: Column | str) -> Column:
    """Exact money sum: DECIMAL(18,2) addition, independent of task order."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(18,2)"))


def rollup(df: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """A2: grouped aggregates; ``measures`` maps output name -> aggregate expression."""
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])


def distinct_exact(df: DataFrame, col: str) -> DataFrame:
    """A4: exact distinct count."""
    return df.agg(F.count_distinct(F.col(col)).alias("distinct_" + col))


def distinct_approx(df: DataFrame, col: str, rsd: float = 0.05) -> DataFrame:
    """A5: HyperLogLog++ distinct count alone: one sketch per task goes to the shuffle, no value does."""
    return df.agg(F.approx_count_distinct(F.col(col), rsd).alias("approx"))


def relative_error(estimate: Column, exact: Column) -> Column:
    """A5: the error of an estimate against a count that is known otherwise."""
    return F.abs(estimate - exact) / F.when(exact != 0, exact)


def count_rules(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """COUNTIF per named predicate, one pass."""
    return df.agg(*[F.count_if(F.coalesce(F.expr(p), F.lit(False))).alias(n) for n, p in rules.items()])


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)``."""
    return num / F.nullif(den, F.lit(0))


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """O2: top-N by a total order; each task keeps N, the final merge keeps N."""
    return df.orderBy(*order).limit(n)


def union_all(*dfs: DataFrame) -> DataFrame:
    """SO1: UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def explode_join(df: DataFrame, arr: str, as_col: str, outer: bool = False) -> DataFrame:
    """Lateral unnest; a ``Generate`` inside the row, no shuffle."""
    gen = F.explode_outer if outer else F.explode
    return df.withColumn(as_col, gen(F.col(arr)))


def top_words(docs: DataFrame, text: str, n: int = 10) -> DataFrame:
    """Whole texts -> lower-case words -> count per word -> top n.

    The split and count are per row / partial aggregates; only n rows reach the driver."""
    from tidemark.functions.scalar import WHITESPACE
    words = docs.select(F.explode(F.split(F.lower(F.col(text)), WHITESPACE)).alias("word")).filter(F.col("word") != "")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return top_n(counts, [F.col("n").desc(), F.col("word").asc()], n)


def by_day(df: DataFrame, ts: str, measures: dict[str, Column], name: str = "day") -> DataFrame:
    """Group by calendar day of a timestamp."""
    return df.groupBy(F.to_date(F.col(ts)).alias(name)).agg(*[m.alias(n) for n, m in measures.items()])


def combine_per_key(df: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    """Associative per-key sum (partial sums combine map-side, exact decimals)."""
    return df.groupBy(key).agg(money_sum(value).cast("double").alias(name))


def join_rollup(fact: DataFrame, dim: DataFrame, on: str, group: list[str], measures: dict[str, Column],
                pre_aggregate: dict[str, Column] | None = None) -> DataFrame:
    """Fact -> dimension join, then group. With ``pre_aggregate`` (name -> partial
    aggregate of the fact per join key) the fact is reduced per key before the join,
    so the join sees one row per key and a hot key is one row."""
    f = fact.groupBy(on).agg(*[m.alias(n) for n, m in pre_aggregate.items()]) if pre_aggregate else fact
    return f.join(dim, on).groupBy(*group).agg(*[m.alias(n) for n, m in measures.items()])


def hll_sketches(df: DataFrame, group_col: str, col: str, lg_k: int = 14) -> DataFrame:
    """A5 roll-up form: one mergeable HyperLogLog sketch per group (e.g. per day), its
    standard error 1.04 / sqrt(2 ** lg_k) or less: 0.8 % at 14."""
    return df.groupBy(group_col).agg(F.hll_sketch_agg(F.col(col), lg_k).alias("sketch"))


def keep_sketches(path: str, df: DataFrame, group_col: str, col: str, changed=None, lg_k: int = 14) -> DataFrame:
    """A5: a table of one sketch per group, partitioned by it. With ``changed`` (group values),
    only those groups are read and sketched anew; a changed group without rows goes. Any roll-up over groups
    then unites a few kilobytes per group and never reads the rows again."""
    rows = df if changed is None else df.where(F.col(group_col).isin(list(changed)))
    replace_partitions(hll_sketches(rows, group_col, col, lg_k), path, group_col, changed)
    kind = df.schema[group_col].dataType.simpleString()
    return external_parquet(df.sparkSession, path, schema="sketch binary, `%s` %s" % (group_col, kind))


def hll_union_estimate(sketches: DataFrame, *by: str) -> DataFrame:
    """A5 roll-up form: distinct count over any set of groups = union of their sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx"))
