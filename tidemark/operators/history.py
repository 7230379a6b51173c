"""M4, M5: versioned (SCD type 2) tables of any key and attributes, for batches of any date.

A table's versions and a batch are both read as events on the time line of a key: a
version starts, a version ends with no successor, a batch says what held from its date
on. Per key the events are put in order and the versions between them written out
again, so a batch that arrives late is spliced in: the version that covered its date is
closed there, and the new one ends where the next one begins. A batch event that says what
held already is no event. Starts of known versions never move, so their
surrogate keys (key columns, start) stay.

A date's batch is what arrived for that date: applied again, it changes nothing; another
batch for the same date replaces the earlier one, versions that only that one opened
included. Keys missing from the batch go on unless ``close_missing``.

``apply_batch`` maintains a table partitioned by ``valid_to``. It reads only partitions that end on or
after the batch's date, reworks only the keys that the batch or its earlier run touched,
and replaces only the partitions in which a version changed; an unchanged table is not written.
The changes themselves come back as a table (removed and added versions), which is what
dependent views refresh from (``operators.views``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import row_hash, surrogate_key
from tidemark.session import scratch_dir
from tidemark.sources import files

OPEN_END = dt.date(9999, 12, 31)
_ENDED, _STARTED, _TOLD = 0, 1, 2               # what wins on one date: the batch, then a start


@dataclass(frozen=True)
class Dimension:
    """Key and attribute columns of a versioned table."""
    keys: tuple[str, ...]
    attrs: tuple[str, ...]

    @classmethod
    def of(cls, keys, attrs) -> "Dimension":
        return cls((keys,) if isinstance(keys, str) else tuple(keys), tuple(attrs))

    @property
    def columns(self) -> list[str]:
        return ["sk", *self.keys, *self.attrs, "row_hash", "valid_from", "valid_to", "is_current"]

    def schema(self, batch: DataFrame) -> T.StructType:
        own = [T.StructField(c, batch.schema[c].dataType) for c in (*self.keys, *self.attrs)]
        return T.StructType([T.StructField("sk", T.StringType()), *own, T.StructField("row_hash", T.StringType()),
                             T.StructField("valid_from", T.DateType()), T.StructField("is_current", T.BooleanType()),
                             T.StructField("valid_to", T.DateType())])


@dataclass(frozen=True)
class Applied:
    """A maintained table, and the versions that the batch removed and added."""
    table: DataFrame
    removed: DataFrame
    added: DataFrame
    partitions: list[str]


def same(a: DataFrame, b: DataFrame, cols) -> Column:
    """Null-safe equality of ``cols`` of two frames (a NULL key is a key like any other)."""
    return reduce(and_, [a[c].eqNullSafe(b[c]) for c in cols])


def told(batch: DataFrame, dim: Dimension, effective) -> DataFrame:
    """A batch as events: its state of every key from ``effective`` on."""
    return batch.select(*dim.keys, *dim.attrs, row_hash(*dim.attrs).alias("row_hash"),
                        F.lit(effective).cast("date").alias("at"), F.lit(False).alias("gone"), F.lit(_TOLD).alias("src"))


def known(versions: DataFrame, dim: Dimension, effective) -> DataFrame:
    """Versions as events, without those of ``effective``: its batch is being told anew."""
    nothing = [F.lit(None).cast(versions.schema[a].dataType).alias(a) for a in dim.attrs]
    starts = versions.select(*dim.keys, *dim.attrs, "row_hash", F.col("valid_from").alias("at"),
                             F.lit(False).alias("gone"), F.lit(_STARTED).alias("src"))
    ends = versions.where(F.col("valid_to") < F.lit(OPEN_END)).select(
        *dim.keys, *nothing, F.lit(None).cast("string").alias("row_hash"), F.col("valid_to").alias("at"),
        F.lit(True).alias("gone"), F.lit(_ENDED).alias("src"))
    return starts.unionByName(ends).where(F.col("at") != F.lit(effective).cast("date"))


def missing(versions: DataFrame, batch: DataFrame, dim: Dimension, effective) -> DataFrame:
    """Events that end, on ``effective``, the keys alive just before it that the batch lacks."""
    day = F.lit(effective).cast("date")
    alive = versions.where((F.col("valid_from") < day) & (F.col("valid_to") >= day)).select(*dim.keys, *dim.attrs)
    lost = alive.join(batch.select(*dim.keys), same(alive, batch, dim.keys), "left_anti")
    return lost.select(*dim.keys, *dim.attrs, F.lit(None).cast("string").alias("row_hash"), day.alias("at"),
                       F.lit(True).alias("gone"), F.lit(_TOLD).alias("src"))


def chain(events: DataFrame, dim: Dimension) -> DataFrame:
    """The versions that lie between the events of each key: one shuffle and one sort by key."""
    ordered = Window.partitionBy(*dim.keys).orderBy("at", F.desc("src"), "row_hash")
    by_date = Window.partitionBy(*dim.keys).orderBy("at")
    one = (events.withColumn("_before", F.lag("at").over(ordered))
           .where(F.col("_before").isNull() | (F.col("_before") != F.col("at"))))
    state = F.struct(F.col("gone"), F.col("row_hash"))
    news = one.withColumn("_state", F.lag(state).over(by_date))
    repeats = F.when(F.col("_state").isNull(), F.col("gone")).otherwise(F.col("_state").eqNullSafe(state))
    kept = news.where((F.col("src") == _STARTED) | ~repeats)
    until = F.coalesce(F.lead("at").over(by_date), F.lit(OPEN_END))
    return (kept.withColumn("valid_to", until).where(~F.col("gone"))
            .select(surrogate_key(*[F.col(k) for k in dim.keys], F.col("at")).alias("sk"), *dim.keys, *dim.attrs, "row_hash",
                    F.col("at").alias("valid_from"), "valid_to", (F.col("valid_to") == F.lit(OPEN_END)).alias("is_current")))


def spliced(versions: DataFrame, batch: DataFrame, dim: Dimension, effective, close_missing: bool = False) -> DataFrame:
    """M4 as a frame: all versions after the batch of ``effective``, whenever it arrives.
    Versions that ended before it pass by without a shuffle."""
    day = F.lit(effective).cast("date")
    events = known(versions.where(F.col("valid_to") >= day), dim, effective).unionByName(told(batch, dim, effective))
    if close_missing:
        events = events.unionByName(missing(versions, batch, dim, effective))
    return versions.where(F.col("valid_to") < day).select(*dim.columns).unionByName(chain(events, dim))


def apply_batch(path: str, batch: DataFrame, dim: Dimension, effective, close_missing: bool = False) -> Applied:
    """M4 as table maintenance: splice the batch of ``effective`` into the table at ``path``."""
    spark, day = batch.sparkSession, F.lit(str(effective)).cast("date")
    schema = dim.schema(batch)
    work = scratch_dir(spark, "splice")
    if not files.path_exists(spark, path):
        first = chain(told(batch, dim, str(effective)), dim)
        files.replace_partitions(first.select(*schema.names), path, "valid_to")
        table = read(spark, path, schema, dim)
        return Applied(table, table.limit(0), table, files.list_partition_values(spark, path, "valid_to"))
    # the batch is read several times below, and may be costly to make
    batch.select(*dim.keys, *dim.attrs).write.parquet(work + "/batch")
    batch = spark.read.schema(batch.select(*dim.keys, *dim.attrs).schema).parquet(work + "/batch")
    table = read(spark, path, schema, dim)
    region = table.where(F.col("valid_to") >= day)
    again = region.where((F.col("valid_from") == day) | (F.col("valid_to") == day)).select(*dim.keys)
    touched = batch.select(*dim.keys).unionByName(again)
    lost = missing(region, batch, dim, str(effective)) if close_missing else None
    if lost is not None:
        touched = touched.unionByName(lost.select(*dim.keys))
    mine = region.join(touched, same(region, touched, dim.keys), "left_semi")
    events = known(mine, dim, str(effective)).unionByName(told(batch, dim, str(effective)))
    if lost is not None:
        events = events.unionByName(lost)
    # the changes: versions of the touched keys on one side only
    sides = mine.withColumn("_n", F.lit(-1)).unionByName(chain(events, dim).withColumn("_n", F.lit(1)))
    changes = sides.groupBy(*dim.columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    changes.write.parquet(work + "/changes")
    changes = spark.read.schema(changes.schema).parquet(work + "/changes")
    removed = changes.where(F.col("_n") < 0).select(*dim.columns)
    added = changes.where(F.col("_n") > 0).select(*dim.columns)
    parts = sorted(str(r[0]) for r in changes.select("valid_to").distinct().collect())     # bounded by the calendar
    if parts:
        old = table.where(F.col("valid_to").isin([dt.date.fromisoformat(p) for p in parts]))
        stay = old.join(removed, same(old, removed, (*dim.keys, "valid_from", "valid_to")), "left_anti")
        files.replace_partitions(stay.unionByName(added).select(*schema.names), path, "valid_to", parts)
    return Applied(read(spark, path, schema, dim), removed, added, parts)


def read(spark: SparkSession, path: str, schema: T.StructType, dim: Dimension) -> DataFrame:
    return files.external_parquet(spark, path, schema=schema).select(*dim.columns)
