"""Session helpers: one place that builds a session and finds shared scratch space.

Scratch space is always taken from ``spark.checkpoint.dir`` (the shared folder a
cluster names for lineage cuts and intermediate tables). Only when that setting is
absent *and* the master is local (tests, the local bench) do we create our own
folder under /tmp. Every run gets a fresh, uniquely named sub-folder, so nothing
ever has to be cleared.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the library relies on for deterministic results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "tidemark", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the library's settings. Master, shuffle partitions and driver memory
    are the cluster's to choose: they are set only when passed (driver memory for an
    explicit local master, where the driver does the work)."""
    b = (SparkSession.builder.appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         # size post-shuffle partitions by bytes (advisory 64 MB), not by core count:
         # fewer, fuller tasks and files at every scale
         .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # streaming state (dedup ids, windows, panes) on local disk per executor, not in
         # the JVM heap; checkpointed to the shared folder like any state store
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory", "8g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (UTC, dynamic partition overwrite)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set our own only when unset and the master is local (tests / bench)."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        jdir = sc._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))   # core setting: on the context
        root = sc._jsc.sc().getCheckpointDir().get()
    elif sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    path = "%s/tidemark/%s-%s" % (checkpoint_root(spark), name, uuid.uuid4().hex[:12])
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jpath)
    return path
