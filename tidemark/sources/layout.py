"""Physical layout (partition, cluster, both), guarded reads,
partition statistics and measured scans.

Clustering = ``repartitionByRange`` on the cluster key + ``sortWithinPartitions``:
each file then covers a narrow key range and Parquet row-group min/max statistics
let a point filter skip most row groups. Partitioning = directories per value, so a
filter on the partition column never opens the other directories.
"""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files


class MissingPartitionFilter(ValueError):
    pass


#: Bytes of rows (before compression) that one file of a clustered table holds.
FILE_BYTES = 256 * 1024 * 1024
#: Partitions that one task writes at most, where there are many small ones.
FILES_PER_TASK = 200


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row holds: text and binary by length, nested columns as JSON, others 8."""
    def size(f):
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 4
        if kind in ("array", "map", "struct"):
            return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0))
        return F.lit(8)
    return sum((size(f) for f in df.schema.fields), F.lit(0)).cast("long")


def table_bytes(df: DataFrame) -> int:
    """Bytes of all rows (one aggregate over them)."""
    return int(df.agg(F.sum(row_bytes(df))).first()[0] or 0)


def file_bytes_for(df: DataFrame, least: int, most_files: int) -> int:
    """Bytes per file: ``least`` for a small table, so that it fills several; a larger one has larger files
    instead of more than ``most_files``, until they hold ``FILE_BYTES``. Every task of a write costs the driver
    its result and its sample of the ranges, so their number must not follow the rows of a table of small files."""
    return max(least, min(FILE_BYTES, -(-table_bytes(df) // most_files)))


def files_for(df: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """How many files of ``file_bytes`` the rows fill."""
    return max(1, -(-table_bytes(df) // file_bytes))


def tasks_for(df: DataFrame, part_col: str, file_bytes: int = FILE_BYTES) -> int:
    """How many tasks write a partitioned table: as many as its bytes fill files, and at least
    one per ``FILES_PER_TASK`` partitions (every partition costs its writer a file)."""
    r = df.agg(F.sum(row_bytes(df)).alias("b"), F.count_distinct(F.col(part_col)).alias("p")).first()
    return max(1, -(-int(r["b"] or 0) // file_bytes), -(-int(r["p"]) // FILES_PER_TASK))


def write_partitioned(df: DataFrame, path: str, part_col: str, part_expr: Column | None = None,
                      file_bytes: int = FILE_BYTES) -> str:
    """Partition by a (derived) column. Rows are dealt out by ranges of (partition, row hash), so
    a task holds a run of small partitions, or a part of a hot one."""
    d = df.withColumn(part_col, part_expr) if part_expr is not None else df
    spread = F.xxhash64(*[F.col(c) for c in d.columns if c != part_col] or [F.lit(0)])
    (d.repartitionByRange(tasks_for(d, part_col, file_bytes), part_col, spread).sortWithinPartitions(part_col)
     .write.mode("overwrite").partitionBy(part_col).parquet(path))
    return path


def write_clustered(df: DataFrame, path: str, cols: list[str], n_files: int | None = None,
                    file_bytes: int = FILE_BYTES) -> str:
    """Range-partition on the cluster key, sort inside each file. As many files as the rows
    fill, unless ``n_files`` says otherwise; equal keys are parted by a hash of the row."""
    n = n_files or files_for(df, file_bytes)
    spread = F.xxhash64(*[F.col(c) for c in df.columns if c not in cols] or [F.lit(0)])
    (df.repartitionByRange(n, *cols, spread).sortWithinPartitions(*cols)
     .write.mode("overwrite").parquet(path))
    return path


def write_partitioned_clustered(df: DataFrame, path: str, part_col: str, part_expr: Column | None,
                                cols: list[str], n_files: int | None = None, file_bytes: int = FILE_BYTES) -> str:
    """Partition directories, clustered (range + sort) inside each. Ranges run over
    (partition, cluster key, row hash): a partition with more than ``file_bytes`` spans several
    files of disjoint key ranges, small neighbouring ones share a task."""
    d = df.withColumn(part_col, part_expr) if part_expr is not None else df
    n = n_files or tasks_for(d, part_col, file_bytes)
    spread = F.xxhash64(*[F.col(c) for c in d.columns if c not in cols and c != part_col] or [F.lit(0)])
    (d.repartitionByRange(n, part_col, *cols, spread).sortWithinPartitions(part_col, *cols)
     .write.mode("overwrite").partitionBy(part_col).parquet(path))
    return path


def guarded_read(spark: SparkSession, root: str, part_col: str, predicate: str) -> DataFrame:
    """A read of a partitioned table must prune on its partition column.

    The plan decides, not the wording: a predicate that names the column but folds away
    (``m = m OR 1 = 1``) or only excludes nulls reads every partition and is refused."""
    if not predicate:
        raise MissingPartitionFilter("a filter on partition column %s is required" % part_col)
    df = files.external_parquet(spark, root).filter(F.expr(predicate))
    if not prunes(df, part_col):
        raise MissingPartitionFilter("%r prunes nothing on partition column %s" % (predicate, part_col))
    return df


def prunes(df: DataFrame, part_col: str) -> bool:
    """Whether every file scan of the plan has a filter on ``part_col`` that is more than IS NOT NULL:
    the expressions of the scans themselves are read, so no cut-off plan text can mislead."""
    scans = _scans(df._jdf.queryExecution().sparkPlan())
    return all(any(part_col in _names(e) and e.getClass().getSimpleName() != "IsNotNull"
                   for e in _each(scan.partitionFilters())) for scan in scans)


def _names(expression) -> set[str]:
    return {a.name() for a in _each(expression.references().toSeq())}


def _each(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _scans(node) -> list:
    """The file scans of a physical plan, below adaptive stages too."""
    name = node.getClass().getSimpleName()
    if name == "FileSourceScanExec":
        return [node]
    if name == "AdaptiveSparkPlanExec":
        return _scans(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return _scans(node.plan())
    return [s for child in _each(node.children()) for s in _scans(child)]


def measured_scan(df: DataFrame) -> dict:
    """Q16: what reading ``df`` took: files, bytes and partitions opened by its scans, rows they
    gave, and the rows of the result. From the metrics of the plan that ran (a count that
    reads every column of ``df``), not from an estimate."""
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("x"))
    n = seen.collect()[0]["n"]
    total = {"rows": n, "files_read": 0, "bytes_read": 0, "partitions_read": 0, "rows_read": 0}
    for scan in _scans(seen._jdf.queryExecution().executedPlan()):
        metrics = scan.metrics()
        for name, key in (("files_read", "numFiles"), ("bytes_read", "filesSize"), ("partitions_read", "numPartitions"),
                          ("rows_read", "numOutputRows")):
            if metrics.contains(key):
                total[name] += int(metrics.apply(key).value())
    return total


def partition_stats(spark: SparkSession, root: str, col: str) -> DataFrame:
    """Number of partitions, first and last value (directory listing, no data read)."""
    vals = files.list_partition_values(spark, root, col)
    return spark.createDataFrame([(len(vals), vals[0] if vals else None, vals[-1] if vals else None)],
                                 "partitions bigint, first string, last string").select(
        "partitions", F.to_date("first").alias("first"), F.to_date("last").alias("last"))


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def metadata_count(spark: SparkSession, path: str, where: str | None = None) -> tuple[int, bool]:
    """COUNT(*) answered from Parquet footers (the reference's "0 bytes" count): the
    read goes through the DataSource V2 Parquet scan with aggregate push-down, so no
    column is decoded. A filter on partition columns keeps the push-down; a filter on
    data columns falls back to a normal (pruned) count. Returns (rows, pushed)."""
    keys = {"spark.sql.sources.useV1SourceList": None, "spark.sql.parquet.aggregatePushdown": "true"}
    saved = {k: spark.conf.get(k, None) for k in keys}
    v1 = [s for s in (saved["spark.sql.sources.useV1SourceList"] or "").split(",") if s.strip() != "parquet"]
    keys["spark.sql.sources.useV1SourceList"] = ",".join(v1)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.read.parquet(path)
        if where:
            df = df.filter(F.expr(where))
        agg = df.groupBy().count()
        pushed = "PushedAggregation: [COUNT(*)]" in plan_text(agg, "simple")
        return int(agg.first()[0]), pushed
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
