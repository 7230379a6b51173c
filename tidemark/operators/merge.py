"""MERGE rewrites for Parquet (no MERGE/DELETE statements there).

``merge_plan`` is the keyed three-way merge "update matched, insert new, delete target
rows absent from the source - within the affected scope only": one full outer join of
the rows in question, every row tagged with what happens to it. ``merge_table`` publishes a
plan: only partitions that hold an inserted, updated or deleted row are replaced, the
rows of theirs that the merge leaves alone included; a merge that changes nothing writes nothing.

``apply_changes`` applies a change feed to a state that remembers, per key, the sequence it has applied
and whether the key is deleted: a change that comes again, or after newer ones, is a
no-op whichever batch it is in.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.session import scratch_dir
from tidemark.sources import files

INSERT, UPDATE, DELETE, KEEP = "insert", "update", "delete", "keep"
SEQ, GONE = "applied_seq", "is_deleted"


class MergeError(Exception):
    """The source of a merge names a key more than once."""


def merge_scoped(target: DataFrame, source: DataFrame, scope: Column) -> DataFrame:
    """M1 where the source is the whole scope: target outside ``scope`` UNION ALL source."""
    keep = target.filter(~F.coalesce(scope, F.lit(False)))
    return keep.unionByName(source.select(*target.columns))


def _by_key(left: DataFrame, right: DataFrame, keys, prefix: str) -> Column:
    return reduce(and_, [left[k].eqNullSafe(right[prefix + k]) for k in keys])


def merge_plan(target: DataFrame, source: DataFrame, keys: list[str], scope: Column) -> DataFrame:
    """M1: (target's columns, ``action``, ``_was``: the row before as a struct).

    Target rows in ``scope`` without a source row are deleted, outside it they are kept;
    matched rows are updated wherever they are, and kept if nothing differs. NULL keys match NULL keys."""
    values = [c for c in target.columns if c not in keys]
    t = target.select("*", F.struct(*target.columns).alias("_was"), F.coalesce(scope, F.lit(False)).alias("_in_scope"))
    s = source.select(*[F.col(c).alias("_s_" + c) for c in target.columns], F.lit(True).alias("_sent"))
    j = t.join(s, _by_key(t, s, keys, "_s_"), "full")
    there, sent = F.col("_was").isNotNull(), F.col("_sent").isNotNull()
    alike = reduce(and_, [F.col(c).eqNullSafe(F.col("_s_" + c)) for c in values], F.lit(True))
    action = (F.when(~there, INSERT).when(sent & ~alike, UPDATE).when(sent, KEEP)
              .when(F.col("_in_scope"), DELETE).otherwise(KEEP))
    return j.select(*[F.when(sent, F.col("_s_" + c)).otherwise(F.col(c)).alias(c) for c in target.columns],
                    action.alias("action"), "_was")


def merge_table(path: str, source: DataFrame, keys: list[str], partition: str, scope: Column) -> dict[str, int]:
    """M1 as table maintenance; returns the rows per action.

    The target is read where ``scope`` or the source's partitions reach (a filter on the
    partition column, so other partitions are not opened) and where a source key lives
    elsewhere. Raises ``MergeError`` if the source repeats a key."""
    spark = source.sparkSession
    if not source.groupBy(*keys).count().where("count > 1").isEmpty():
        raise MergeError("the source names a key more than once: %s" % ", ".join(keys))
    table = files.external_parquet(spark, path, schema=source.schema)   # partition values as they are typed there
    source = source.select(*table.columns)
    keyed = source.select(*[F.col(k).alias("_s_" + k) for k in keys])
    if partition in keys:                       # a key then lives in one partition only
        reached = [r[0] for r in source.select(partition).distinct().collect()]     # bounded by the partitions written
        matched = F.coalesce(F.col(partition).isin(reached), F.lit(False)) if reached else F.lit(False)
        target = table.where(F.coalesce(scope, F.lit(False)) | matched)
    else:
        here = F.coalesce(scope, F.lit(False))
        outside = table.where(~here)
        target = table.where(here).unionByName(outside.join(keyed, _by_key(outside, keyed, keys, "_s_"), "left_semi"))
    work = scratch_dir(spark, "merge") + "/plan"
    merge_plan(target, source, keys, scope).write.parquet(work)
    plan = spark.read.parquet(work)
    changed = plan.where(F.col("action") != KEEP)
    counts = {r["action"]: r["n"] for r in plan.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [r[0] for r in changed.select(F.explode(F.array(F.col(partition), F.col("_was." + partition))).alias("p"))
             .where("p is not null").distinct().collect()]              # bounded by the partitions replaced
    if parts:
        gone = changed.where("_was is not null").select(*[F.col("_was." + k).alias("_s_" + k) for k in keys])
        old = table.where(F.col(partition).isin(parts))
        stay = old.join(gone, _by_key(old, gone, keys, "_s_"), "left_anti")
        new = changed.where(F.col("action") != DELETE).select(*table.columns)
        files.replace_partitions(stay.unionByName(new), path, partition, parts)
    return {a: counts.get(a, 0) for a in (INSERT, UPDATE, DELETE, KEEP)}


def cdc_state(target: DataFrame) -> DataFrame:
    """A table as the state that changes are applied to: nothing applied, nothing deleted."""
    return target.withColumns({SEQ: F.lit(None).cast("bigint"), GONE: F.lit(False)})


def apply_changes(state: DataFrame, changes: DataFrame, keys: list[str], seq: str, op: str = "op",
                  delete_value: str = "D", forget_before: int | None = None) -> DataFrame:
    """The state after a batch of changes, in any order and with repeats.

    The newest change of each key is applied if its sequence is beyond the one applied to
    the key before; a delete leaves a tombstone with its sequence, so an older change that comes later
    does not bring the key back. ``forget_before``: the feed promises to send no sequence
    below it again, and tombstones below it go."""
    cols = [c for c in state.columns if c not in (SEQ, GONE, *keys)]
    newest = latest_per_key(changes.select(*keys, seq, op, *cols), keys, [seq])
    c = newest.select(*[F.col(x).alias("_c_" + x) for x in (*keys, *cols)], F.col(seq).cast("bigint").alias("_c_seq"),
                      F.col(op).eqNullSafe(F.lit(delete_value)).alias("_c_gone"))
    j = state.withColumn("_there", F.lit(True)).join(c, _by_key(state, c, keys, "_c_"), "full")
    applies = F.col("_c_seq").isNotNull() & (F.col(SEQ).isNull() | (F.col("_c_seq") > F.col(SEQ)))
    gone = F.when(applies, F.col("_c_gone")).otherwise(F.col(GONE))
    out = [F.when(F.col("_there").isNull(), F.col("_c_" + k)).otherwise(F.col(k)).alias(k) for k in keys]
    out += [F.when(applies & F.col("_c_gone"), None).when(applies, F.col("_c_" + x)).otherwise(F.col(x)).alias(x)
            for x in cols]
    # a change without a sequence can't be ordered: it never applies, nor does it make a row
    after = j.where(F.col("_there").isNotNull() | F.col("_c_seq").isNotNull()).select(
        *out, F.when(applies, F.col("_c_seq")).otherwise(F.col(SEQ)).alias(SEQ), gone.alias(GONE))
    if forget_before is not None:
        after = after.where(~F.col(GONE) | (F.col(SEQ) >= forget_before))
    return after.select(*state.columns)


def visible(state: DataFrame) -> DataFrame:
    """The rows of a change-feed state that are not deleted, without its bookkeeping."""
    return state.where(~F.col(GONE)).drop(SEQ, GONE)


def apply_cdc(target: DataFrame, changes: DataFrame, key: str, seq: str, op: str = "op",
              delete_value: str = "D") -> DataFrame:
    """M13 for one batch onto a plain table; a feed of batches keeps ``cdc_state`` instead."""
    return visible(apply_changes(cdc_state(target), changes, [key], seq, op, delete_value)).select(*target.columns)
