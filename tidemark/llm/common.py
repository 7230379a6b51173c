"""Small helpers shared by the operators: shared scratch tables and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet("%s/%s.parquet" % (sf_dir, name))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder of ``spark.checkpoint.dir``."""
    return "%s/llm/%s-%s" % (checkpoint_root(spark), name, uuid.uuid4().hex[:12])


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh shared table and read back: cuts the lineage, and a
    lost executor costs only the reader's own tasks. The shuffle files of the write go with it."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


class Rounds:
    """The shared tables of a loop: a table goes when the next one of its name is written."""

    def __init__(self) -> None:
        self.held: dict = {}

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        out = saved(df, name)
        self.drop(name)
        self.held[name] = out
        return out

    def drop(self, *names: str) -> None:
        """Remove the named tables that this loop wrote (all of them without names)."""
        for name in names or list(self.held):
            out = self.held.pop(name, None)
            if out is not None:
                jvm = out.sparkSession.sparkContext._jvm
                path = jvm.org.apache.hadoop.fs.Path(out._saved_at)
                path.getFileSystem(out.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def free_names(names, taken, suffix: str) -> list[str]:
    """``names`` with ``suffix`` put, as often as needed, to those that are in ``taken``
    (letter case aside), so that no two are alike."""
    used, out = {t.lower() for t in taken} | {n.lower() for n in names if n.lower() not in {t.lower() for t in taken}}, []
    for name in names:
        if name.lower() in {t.lower() for t in taken}:
            while name.lower() in used:
                name += suffix
            used.add(name.lower())
        out.append(name)
    return out


def arrow_scan(fn, kind, arguments: int = 1):
    """``fn`` (an iterator of Arrow arrays, or tuples of them, to an iterator of Arrow arrays)
    as a column function: only its arguments go to Python, every other column passes by. Marked
    non-deterministic so that a filter on the result never evaluates it a second time."""
    import pyarrow as pa
    given = pa.Array if arguments == 1 else tuple[(pa.Array,) * arguments]
    fn.__annotations__ = {"batches": Iterator[given], "return": Iterator[pa.Array]}
    return F.arrow_udf(fn, kind).asNondeterministic()


def in_training_fold(doc_id) -> F.Column:
    """Rows a model may learn from: crc32 of the id as text, mod 3, is not 1.
    A null id belongs to neither fold (NULL)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def held_out(doc_id) -> F.Column:
    return F.coalesce(~in_training_fold(doc_id), F.lit(False))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph given as distinct (a, b) long pairs.

    Alternates the large-star and small-star steps until the edge set no longer
    changes; each step is one shuffle by node and the edge set never grows, so hub nodes
    do not concentrate rows beyond their own edges (which are combined map-side by
    ``min``). Returns (node, root) for every node that has an edge, root = smallest
    node id of its component. No links or components reach the driver; only a count and
    a checksum per round do."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    rounds = Rounds()
    e = rounds.saved(e, "edges")

    def stamp(x):
        return tuple(x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def star(x, large: bool):
        both = x.select("u", "v")
        if large:
            both = both.union(x.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:                                   # each edge hangs from its larger end
            both = x.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("lo"))
        low = low.select("u", F.least("u", "lo").alias("lo"))
        j = both.join(low, "u")
        if large:                               # larger neighbours hang from the smallest
            out = j.where("v > u").select(F.col("v").alias("u"), F.col("lo").alias("v"))
        else:
            out = (j.select(F.col("v").alias("u"), F.col("lo").alias("v"))
                   .union(low.select("u", F.col("lo").alias("v"))))
        return out.where("u <> v").distinct()

    before = None
    while True:
        e = rounds.saved(star(star(e, True), False), "edges")
        now = stamp(e)
        if now == before:
            break
        before = now
    roots = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(e.select("v", F.col("v").alias("root")).distinct())
