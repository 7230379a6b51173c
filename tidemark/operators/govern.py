"""Governed reads (row policy, authorized view, column policy).

Enforcement is by these functions: a policy becomes a filter Catalyst can push to the
scan, a column rule becomes a projection. Access control itself is out of scope.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class AccessDenied(PermissionError):
    pass


def apply_row_policy(df: DataFrame, policies: list[tuple[str, str]], principal: str) -> DataFrame:
    """G1: OR of the principal's policy predicates.

    Once any policy exists on the table, a principal without one sees zero rows;
    with no policies at all, everyone sees everything."""
    if not policies:
        return df
    mine = [F.expr(pred) for who, pred in policies if who == principal]
    if not mine:
        return df.filter(F.lit(False))
    return df.filter(F.coalesce(reduce(lambda a, b: a | b, mine), F.lit(False)))


def apply_policy_table(df: DataFrame, policy: DataFrame, principal: str, col: str) -> DataFrame:
    """G1, data-driven: the policy table lists (principal, allowed value of ``col``);
    a semi-join keeps the allowed rows (the policy side is small and broadcastable)."""
    allowed = policy.filter(F.col("principal") == principal).select(F.col("value").alias(col)).distinct()
    from tidemark.operators.joins import maybe_broadcast
    return df.join(maybe_broadcast(allowed), col, "left_semi")


def governed_view(df: DataFrame, cols: list[str], predicate: str, policies, principal: str) -> DataFrame:
    """Authorized view = row policy of the base table, then the view's filter and columns."""
    return apply_row_policy(df, policies, principal).filter(F.expr(predicate)).select(*cols)


def apply_column_policy(df: DataFrame, tags: dict[str, str], grants: dict[str, set], principal: str,
                        mode: str = "mask") -> DataFrame:
    """A tagged column needs a grant of its tag; untagged columns are free.

    mode: 'deny' raises, 'drop' removes the column, 'mask' replaces it by an md5
    (NULL stays NULL), 'null' replaces it by NULL."""
    allowed = grants.get(principal, set())
    out = []
    for c in df.columns:
        tag = tags.get(c)
        if tag is None or tag in allowed:
            out.append(F.col(c))
        elif mode == "deny":
            raise AccessDenied("column %s (tag %s) not granted to %s" % (c, tag, principal))
        elif mode == "drop":
            continue
        elif mode == "null":
            out.append(F.lit(None).cast(df.schema[c].dataType).alias(c))
        else:
            out.append(F.md5(F.col(c).cast("string")).alias(c))
    return df.select(*out)


def create_view(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Plain (temp) view."""
    df.createOrReplaceTempView(name)
    return spark.table(name)
