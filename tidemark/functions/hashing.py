"""Deterministic hashes (F8 uniform draw, F9 row hash, F10 surrogate key).

All are built-in JVM expressions, so they stay inside whole-stage codegen and give
the same value on every executor and on every re-run (re-runs must be idempotent).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The hash draw uses 15 hex digits (60 bits) of md5 over "<n>:<salt>"
# reduced modulo one million, so it is reproducible in any SQL engine with md5.
U01_HEX_DIGITS = 15
U01_BUCKETS = 1000000
NULL_MARKER = "\\N"


def u01_bucket(n, salt: str) -> Column:
    """Integer draw in [0, 1e6) from (n, salt): md5 prefix -> bigint -> mod 1e6."""
    n = F.col(n) if isinstance(n, str) else n
    h = F.md5(F.concat(n.cast("string"), F.lit(":" + salt)))
    as_int = F.conv(F.substring(h, 1, U01_HEX_DIGITS), 16, 10).cast("bigint")
    return F.pmod(as_int, F.lit(U01_BUCKETS))


def u01(n, salt: str) -> Column:
    """Uniform [0, 1) draw from (n, salt): ``u01_bucket / 1e6``."""
    return u01_bucket(n, salt) / F.lit(float(U01_BUCKETS))


def row_hash(*cols, sep: str = "|") -> Column:
    """Null-safe MD5 of several columns: a NULL attribute still changes the hash.
    Backslashes and separators inside a value are escaped, so ("a|b", "c") and
    ("a", "b|c") differ, and a literal ``\\N`` is not a NULL."""
    def part(c):
        v = (F.col(c) if isinstance(c, str) else c).cast("string")
        v = F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep))
        return F.coalesce(v, F.lit(NULL_MARKER))
    parts = [part(c) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def surrogate_key(*cols) -> Column:
    """Deterministic surrogate key (replaces GENERATE_UUID so re-runs are no-ops)."""
    return row_hash(*cols, sep="#")
