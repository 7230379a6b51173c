"""Build (once per session and input folder) the order lakehouse from driver tables.

GN1/GN2 derive a dirty bronze feed from ``orders`` ⨝ ``customer`` ⨝ ``nation``; S17
lands it as JSON partitioned by ingest date; C4 backfills silver and gold over every
ingest partition. Registered queries then read these layers, so their work grows
with the driver tables.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession

from tidemark.plans import generate, medallion
from tidemark.session import ensure_conf, scratch_dir
from tidemark.sources import files
from tidemark.sources.tables import Tables

# Fixed build time of the registered lake, so gold rows are reproducible.
BUILT_AT = "2026-08-31 06:00:00"
# The registered lake has day partitions; its calendar runs sixty times as fast as that of the orders, so that a day
# of the small driver tables holds hundreds of orders, late ones and corrections among them.
GRAIN, PACE = "day", 60
# The lake of ``reconcile_summary`` keeps the orders' own calendar, with month partitions.
OWN_CALENDAR = ("month", 1)
_LOCK = threading.Lock()
_BUILT: dict = {}
_BRONZE: dict = {}


def write_bronze(spark: SparkSession, sf_dir: str, root: str, grain: str = "month", pace: int = 1) -> list[str]:
    """Land the dirty feed as JSON partitions. Orders are range-partitioned on
    (order date, key) first - the sample reads two columns, not the generated feed -
    so each task generates a narrow run of dates (arrival = order date + 0..6 days)
    and writes few partition folders; a hot date still spans several tasks."""
    t = Tables(spark, sf_dir)
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    orders = t.orders.repartitionByRange(n, "o_orderdate", "o_orderkey")
    lines = generate.bronze_feed(orders, t.customer, t.nation, grain, pace)
    files.export_json(lines, root, clustered=True)
    return files.list_partition_values(spark, root, "ingest_date")


def _code_fingerprint() -> str:
    """Hash of the modules that decide what the lake contains: a lake built by other
    code is never reused."""
    import hashlib
    import inspect
    from tidemark.functions import hashing
    from tidemark.operators import latest, validate
    h = hashlib.sha1()
    for mod in (generate, medallion, files, validate, latest, hashing):
        h.update(inspect.getsource(mod).encode())
    return h.hexdigest()[:12]


def _input_stamp(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and modification times of the source files: tables written anew never
    meet a lake of the old ones."""
    found = []
    for name in ("orders", "customer", "nation"):
        fs, p = files._fs(spark, "%s/%s.parquet" % (sf_dir, name))
        found += sorted((st.getPath().getName(), st.getLen(), st.getModificationTime()) for st in fs.listStatus(p))
    return repr(found)


def _pointer_path(spark: SparkSession, sf_dir: str, grain: str, pace: int) -> str:
    import hashlib
    from tidemark.session import checkpoint_root
    tag = hashlib.sha1(("%s|%s|%d|%s|%s" % (sf_dir, grain, pace, _code_fingerprint(), _input_stamp(spark, sf_dir))).encode()).hexdigest()[:16]
    return "%s/tidemark/_lakes/%s.json" % (checkpoint_root(spark), tag)


def _load_pointer(spark: SparkSession, path: str, grain: str):
    import json
    if not files.path_exists(spark, path):
        return None
    d = json.loads(files.read_small_text(spark, path))
    lake = medallion.Lake(d["root"], grain=grain, gold_grain=grain)
    if not files.path_exists(spark, lake.gold):
        return None
    r = d["silver"]
    run = medallion.SilverRun(r["dates"], r["rows_in"], r["valid"], r["rejected"], r["reject_rate"],
                              r["reject_reasons"], r["silver_rows"], r["duplicates_removed"], [], r["seconds"])
    return lake, d["parts"], {"silver": run, "gold": d["gold"]}


def _save_pointer(spark: SparkSession, path: str, lake, parts, result) -> None:
    import json
    r = result["silver"]
    d = {"root": lake.root, "parts": parts, "gold": result["gold"],
         "silver": {"dates": r.dates, "rows_in": r.rows_in, "valid": r.valid, "rejected": r.rejected,
                    "reject_rate": r.reject_rate, "reject_reasons": r.reject_reasons, "silver_rows": r.silver_rows,
                    "duplicates_removed": r.duplicates_removed, "seconds": r.seconds}}
    files.write_small_text(spark, path, json.dumps(d))


def build_lake(spark: SparkSession, sf_dir: str, grain: str = GRAIN, pace: int = PACE) -> tuple[medallion.Lake, list[str], dict]:
    """Bronze written once and backfilled once per input folder and code version.

    Reused within a session (memo) and across sessions through a small pointer file
    in the shared checkpoint folder, written only after the build completed."""
    ensure_conf(spark)
    key = _key(spark, sf_dir, grain, pace)
    with _LOCK:
        found = _found(spark, sf_dir, grain, pace)
        if found is None:
            lake, parts = _bronze(spark, sf_dir, grain, pace)
            result = medallion.backfill(spark, lake, parts[0], parts[-1], built_at=BUILT_AT)
            _save_pointer(spark, _pointer_path(spark, sf_dir, grain, pace), lake, parts, result)
            found = (lake, parts, result)
        _BUILT[key] = found
        return found


def build_bronze(spark: SparkSession, sf_dir: str, grain: str = GRAIN, pace: int = PACE) -> tuple[medallion.Lake, list[str]]:
    """Only the bronze of ``build_lake`` (which goes on from it), for a caller that builds layers of its own over it."""
    ensure_conf(spark)
    with _LOCK:
        found = _found(spark, sf_dir, grain, pace)
        return found[:2] if found else _bronze(spark, sf_dir, grain, pace)


def _key(spark, sf_dir, grain, pace):
    return spark.sparkContext.applicationId, sf_dir, grain, pace, _input_stamp(spark, sf_dir)


def _found(spark, sf_dir, grain, pace):
    """A lake that is complete: of this session, or of another one."""
    key = _key(spark, sf_dir, grain, pace)
    if key in _BUILT and files.path_exists(spark, _BUILT[key][0].gold):
        return _BUILT[key]
    return _load_pointer(spark, _pointer_path(spark, sf_dir, grain, pace), grain)


def _bronze(spark, sf_dir, grain, pace):
    key = _key(spark, sf_dir, grain, pace)
    if key not in _BRONZE or not files.path_exists(spark, _BRONZE[key][0].bronze):
        lake = medallion.Lake(scratch_dir(spark, "lake"), grain=grain, gold_grain=grain)
        _BRONZE[key] = (lake, write_bronze(spark, sf_dir, lake.bronze, grain, pace))
    return _BRONZE[key]
