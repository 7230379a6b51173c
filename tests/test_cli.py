"""The command line runs the lakehouse end to end in its own Spark session."""

import json
import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    p = subprocess.run([sys.executable, "-m", "tidemark", *args, "--master", "local[2]"], cwd=REPO,
                       capture_output=True, text=True, timeout=600)
    lines = [x for x in p.stdout.splitlines() if x.startswith("METRICS ")]
    return p.returncode, json.loads(lines[-1][8:]) if lines else None


def test_generate_backfill_verify():
    lake = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/lake"
    rc, gen = _run("generate", "--tables", "/root/testdata/sf0.001", "--lake", lake)
    assert rc == 0 and gen["partitions"] > 1
    rc, bf = _run("backfill", "--lake", lake, "--ingest_from", gen["first"], "--ingest_to", gen["last"])
    assert rc == 0 and bf["silver"]["rows_in"] == bf["silver"]["valid"] + bf["silver"]["rejected"]
    rc, v = _run("verify", "--lake", lake, "--tables", "/root/testdata/sf0.001")
    assert rc == 0 and v["cells_missing_on_one_side"] == 0 and v["orders_mismatches"] == 0
    rc, _ = _run("bronze-to-silver", "--lake", lake, "--ingest_date", "1990-01-01")
    assert rc == 2          # the partition of a daily run must exist
