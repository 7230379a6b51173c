"""Scalar helpers (F1-F7, F12-F14): JVM built-ins composed, never Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITESPACE = r"[ \t\n\r\f]+"
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def collapse_ws(c: Column | str) -> Column:
    """REGEXP_REPLACE(x, r'\\s+', ' ') with an explicit, engine-neutral class."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, WHITESPACE, " ")


def snippet(c: Column | str, n: int = 60) -> Column:
    """SUBSTR(REGEXP_REPLACE(x, r'\\s+', ' '), 1, n): the collapse runs on the whole text."""
    return F.substring(collapse_ws(c), 1, n)


def iso_z(ts: Column | str) -> Column:
    """FORMAT_TIMESTAMP('%Y-%m-%dT%H:%M:%SZ', ts) in a UTC session."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, ISO_Z)


def minutes_between(start: Column, end: Column) -> Column:
    """TIMESTAMP_DIFF(end, start, MINUTE): whole minutes, truncated toward zero."""
    return F.timestamp_diff("MINUTE", start, end)


def parse_json_fields(df: DataFrame, col: str, ddl: str, out: str | None = None) -> DataFrame:
    """``from_json`` in PERMISSIVE mode into ``<col>_parsed``.

    A malformed document gives a NULL struct; a *missing* field is a NULL member,
    so presence checks are separate rules (see ``streaming.messaging``)."""
    return df.withColumn(out or col + "_parsed", F.from_json(F.col(col), ddl, {"mode": "PERMISSIVE"}))
