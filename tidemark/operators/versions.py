"""Versioned tables over Parquet (delete, snapshot, clone, time travel,
restore, rollback).

Parquet has no DELETE or time travel, so a table is a folder of immutable data
directories plus one small manifest per version listing the directories it reads.
Every change writes new data (copy-on-write) or only a new manifest (append,
snapshot, clone, rollback); nothing is ever read and overwritten in one plan. The
file format's own commit protocol is not rebuilt; this is the user-level pattern.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files


class ReadOnlyTable(RuntimeError):
    pass


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, read_only: bool = False, expires_at: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.read_only, self.expires_at = read_only, expires_at

    # -------------------------------------------------------------- manifests
    def _manifest_dir(self) -> str:
        return self.root + "/_manifest"

    def manifests(self) -> list[dict]:
        out = [json.loads(files.read_small_text(self.spark, p)) for p in files.list_files(self.spark, self._manifest_dir())]
        return sorted(out, key=lambda m: m["version"])

    def latest_version(self) -> int | None:
        ms = self.manifests()
        return ms[-1]["version"] if ms else None

    def _commit_manifest(self, paths: list[str], committed_at: int | None, op: str) -> int:
        if self.read_only:
            raise ReadOnlyTable("%s is a read-only snapshot" % self.root)
        v = (self.latest_version() or 0) + 1
        m = {"version": v, "committed_at": int(committed_at if committed_at is not None else time.time() * 1e6),
             "paths": paths, "operation": op}
        files.write_small_text(self.spark, "%s/v=%09d.json" % (self._manifest_dir(), v), json.dumps(m))
        return v

    # ------------------------------------------------------------------ writes
    def commit(self, df: DataFrame, mode: str = "overwrite", committed_at: int | None = None) -> int:
        """Overwrite (new file list) or append (old list + new directory)."""
        v = (self.latest_version() or 0) + 1
        data = "%s/data/v=%09d" % (self.root, v)
        df.write.mode("overwrite").parquet(data)
        prev = self._paths(self.latest_version()) if mode == "append" and self.latest_version() else []
        return self._commit_manifest(prev + [data], committed_at, mode)

    def delete(self, predicate: Column, committed_at: int | None = None) -> int:
        """M6: keyed DELETE as copy-on-write of the surviving rows into a new version."""
        return self.commit(self.read().filter(~F.coalesce(predicate, F.lit(False))), "overwrite", committed_at)

    def rollback(self, version: int, committed_at: int | None = None) -> int:
        """A new version whose manifest is an older version's file list (no data copied)."""
        return self._commit_manifest(self._paths(version), committed_at, "rollback_to_%d" % version)

    def snapshot(self, dst: str, expire_after_micros: int | None = None, committed_at: int | None = None) -> "VersionedTable":
        """M7: read-only copy of the current version (metadata only), optional expiry."""
        now = int(committed_at if committed_at is not None else time.time() * 1e6)
        snap = VersionedTable(self.spark, dst)
        snap._commit_manifest(self._paths(self.latest_version()), now, "snapshot")
        marker = {"read_only": True, "expires_at": now + expire_after_micros if expire_after_micros else None}
        files.write_small_text(self.spark, dst.rstrip("/") + "/_snapshot.json", json.dumps(marker))
        return VersionedTable(self.spark, dst, True, marker["expires_at"])

    def clone(self, dst: str, committed_at: int | None = None) -> "VersionedTable":
        """M7: writable copy sharing the data files (metadata only)."""
        c = VersionedTable(self.spark, dst)
        c._commit_manifest(self._paths(self.latest_version()), committed_at, "clone")
        return c

    def restore(self, source: "VersionedTable", predicate: Column, committed_at: int | None = None) -> int:
        """M9: append the rows of another table (a snapshot) that match ``predicate``."""
        return self.commit(source.read().filter(predicate), "append", committed_at)

    # ------------------------------------------------------------------- reads
    def _paths(self, version: int | None) -> list[str]:
        for m in self.manifests():
            if m["version"] == version:
                return list(m["paths"])
        raise KeyError("no version %s in %s" % (version, self.root))

    def read(self, version: int | None = None, now_micros: int | None = None) -> DataFrame:
        if self.expires_at and now_micros and now_micros > self.expires_at:
            raise ReadOnlyTable("snapshot %s expired" % self.root)
        v = version if version is not None else self.latest_version()
        return self.spark.read.parquet(*self._paths(v))

    def version_as_of(self, micros: int) -> int:
        """M8: the last version committed at or before ``micros``."""
        ok = [m["version"] for m in self.manifests() if m["committed_at"] <= micros]
        if not ok:
            raise KeyError("no version of %s at %d" % (self.root, micros))
        return max(ok)

    def read_as_of(self, micros: int) -> DataFrame:
        """M8: FOR SYSTEM_TIME AS OF ``TIMESTAMP_MICROS(micros)``."""
        return self.read(self.version_as_of(micros))


def log_as_of(log: DataFrame, keys: list[str], order: list[str], ts_col: str, at) -> DataFrame:
    """M8 on an append log: rows known at ``at`` (``ts_col <= at``), newest per key."""
    from tidemark.operators.latest import latest_per_key
    return latest_per_key(log.filter(F.col(ts_col) <= F.lit(at).cast("timestamp")), keys, order)
