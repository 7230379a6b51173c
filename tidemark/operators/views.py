"""U4: grouped views kept up to date from changes, retractions included.

A view holds count, sums, minima and maxima per group. ``refresh`` reads the view and the
rows that were added and removed; counts and sums add up, and a minimum (maximum) only
ever needs rows of the base table where the row that held it was taken away and nothing that
was added reaches it: those groups, and no others, are aggregated anew.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.history import same


@dataclass(frozen=True)
class View:
    """Group columns and measures: output name -> input column."""
    groups: tuple[str, ...]
    count: str = "n"
    sums: dict[str, str] = field(default_factory=dict)
    minima: dict[str, str] = field(default_factory=dict)
    maxima: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [*self.groups, self.count, *self.sums, *self.minima, *self.maxima]

    def full(self, df: DataFrame) -> DataFrame:
        """The view over all rows of ``df``."""
        return df.groupBy(*self.groups).agg(
            F.count(F.lit(1)).alias(self.count), *[F.sum(c).alias(n) for n, c in self.sums.items()],
            *[F.min(c).alias(n) for n, c in self.minima.items()],
            *[F.max(c).alias(n) for n, c in self.maxima.items()]).select(*self.columns)

    def changes(self, added: DataFrame, removed: DataFrame) -> DataFrame:
        """One row per group that changed: what came in (``_in_``) and what went (``_out_``)."""
        cols = list(dict.fromkeys([*self.groups, *self.sums.values(), *self.minima.values(), *self.maxima.values()]))
        both = added.select(*cols, F.lit(1).alias("_n")).unionByName(removed.select(*cols, F.lit(-1).alias("_n")))
        came, went = F.col("_n") > 0, F.col("_n") < 0
        aggs = [F.sum("_n").alias("_d_" + self.count)]
        aggs += [F.sum(F.when(came, F.col(c)).otherwise(-F.col(c))).alias("_d_" + n) for n, c in self.sums.items()]
        for names, f in ((self.minima, F.min), (self.maxima, F.max)):
            aggs += [f(F.when(came, F.col(c))).alias("_in_" + n) for n, c in names.items()]
            aggs += [f(F.when(went, F.col(c))).alias("_out_" + n) for n, c in names.items()]
        return both.groupBy(*self.groups).agg(*aggs)

    def merged(self, state: DataFrame, changes: DataFrame) -> DataFrame:
        """State after the changes, with ``_stale`` where a bound was withdrawn."""
        left = state.select(*[F.col(c).alias("_s_" + c) for c in state.columns])
        on = reduce(lambda a, b: a & b, [left["_s_" + g].eqNullSafe(changes[g]) for g in self.groups])
        j = left.withColumn("_old", F.lit(True)).join(changes.withColumn("_new", F.lit(True)), on, "full")
        here = F.col("_new").isNotNull()
        out = [F.when(here, F.col(g)).otherwise(F.col("_s_" + g)).alias(g) for g in self.groups]
        plus = lambda n: (F.coalesce(F.col("_s_" + n), F.lit(0)) + F.coalesce(F.col("_d_" + n), F.lit(0)))
        out.append(plus(self.count).cast("bigint").alias(self.count))
        out += [F.when(F.col("_s_" + n).isNull() & F.col("_d_" + n).isNull(), None).otherwise(plus(n))
                .cast(state.schema[n].dataType).alias(n) for n in self.sums]
        stale = F.lit(False)
        for names, reach, lost in ((self.minima, F.least, lambda gone, held: gone <= held),
                                   (self.maxima, F.greatest, lambda gone, held: gone >= held)):
            for n in names:
                was, came, went = F.col("_s_" + n), F.col("_in_" + n), F.col("_out_" + n)
                out.append(reach(was, came).alias(n))
                kept = F.coalesce(lost(came, went), F.lit(False))       # what came in reaches what went
                stale = stale | (F.coalesce(lost(went, was), F.lit(False)) & ~kept)
        return j.select(*out, stale.alias("_stale")).where(F.col(self.count) > 0)

    def refresh(self, state: DataFrame, added: DataFrame, removed: DataFrame, base: DataFrame | None = None) -> DataFrame:
        """The view after the changes. ``base`` is the table after them: read only if a
        group lost the row that held one of its bounds, and then for such groups only.
        Sums over columns that hold NULLs are not told apart from sums of nothing: a group
        whose every value was taken away sums to 0."""
        after = self.merged(state, self.changes(added, removed))
        if not self.minima and not self.maxima:
            return after.select(*self.columns)
        stale = after.where("_stale").select(*self.groups)
        if stale.isEmpty():
            return after.select(*self.columns)
        if base is None:
            raise ValueError("a group lost its least or greatest value: the base table is needed")
        bounds = [*self.minima, *self.maxima]
        fresh = base.join(stale, same(base, stale, self.groups), "left_semi").groupBy(*self.groups).agg(
            *[F.min(c).alias("_f_" + n) for n, c in self.minima.items()],
            *[F.max(c).alias("_f_" + n) for n, c in self.maxima.items()])
        fresh = fresh.select(*[F.col(g).alias("_g_" + g) for g in self.groups], *["_f_" + n for n in bounds])
        on = reduce(lambda a, b: a & b, [after[g].eqNullSafe(fresh["_g_" + g]) for g in self.groups])
        j = after.join(fresh, on, "left")
        held = lambda n: F.when(F.col("_stale"), F.col("_f_" + n)).otherwise(F.col(n)).alias(n)            # noqa: E731
        return j.select(*[held(c) if c in bounds else F.col(c) for c in self.columns])
