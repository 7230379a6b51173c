"""Headline benchmark: prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

  generate   - derive the dirty order feed and land it as JSON partitions (S17)
  backfill   - bronze -> silver (+ quarantine) -> gold over every partition, one job (C4)
  daily      - one incremental run of the newest partition (C3: silver + affected gold)
  reconcile  - gold against independently recomputed truth (Q7)
  join_top20 - fact -> dimension join, group, top 20 (J1)
  prune_*    - partition / cluster pruned scans on laid-out copies (S12-S14)
  approx     - approximate vs exact distinct (A5)
  scd2       - SCD2 merge of a day-2 batch (M4)
  sessions   - session windows over events (T5)
  stream     - watermarked streaming window counts, availableNow (T7)
  top_words  - word counts over every document's whole text (A15)
  count_footers - COUNT(*) of lineitem answered from Parquet footers (A1, "0 bytes")
Every DataFrame result is fully computed through the ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tidemark.session import build_session, checkpoint_root, scratch_dir
    spark = build_session(master="local[%d]" % cpus, app="tidemark-bench", shuffle_partitions=max(8, cpus * 2))
    checkpoint_root(spark)

    from pyspark.sql import functions as F
    from tidemark.plans import catalog_dims, catalog_misc, catalog_relational, catalog_stream, catalog_upkeep, generate, medallion
    from tidemark.plans.lakebuild import BUILT_AT, GRAIN, PACE, write_bronze
    from tidemark.sources.tables import Tables

    times: dict[str, float] = {}
    # session start-up and first-job JIT warm-up are not part of any step (the reference
    # also reports in-job time separately from submit-to-finish)
    spark.range(100000).selectExpr("sum(id) AS s").collect()

    def run(name, fn):
        t0 = time.time()
        out = fn()
        if out is not None and hasattr(out, "write"):
            out.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        return out

    lake = medallion.Lake(scratch_dir(spark, "bench-lake"), GRAIN, GRAIN)
    parts = run("generate", lambda: write_bronze(spark, sf_dir, lake.bronze, GRAIN, PACE))
    res = run("backfill", lambda: medallion.backfill(spark, lake, parts[0], parts[-1], built_at=BUILT_AT))
    # the last whole day of orders once more, as a daily run (gates, incremental gold, freshness)
    last = spark.read.parquet(lake.index).agg(F.max("order_date")).first()[0]
    day = max(p for p in parts if p < str(last))
    run("daily", lambda: medallion.run_day(spark, lake, day, built_at=BUILT_AT) and None)
    t = Tables(spark, sf_dir)
    run("reconcile", lambda: medallion.verify(spark, lake, generate.order_universe(
        t.orders, t.customer, t.nation, GRAIN, PACE))[1])
    run("join_top20", lambda: catalog_relational.join_top_n(spark, sf_dir))
    catalog_misc._layouts(spark, sf_dir)        # written before: what is timed is the pruned reads
    run("prune_layouts", lambda: catalog_misc.scan_files_touched(spark, sf_dir))
    run("approx_distinct", lambda: catalog_relational.distinct_approx_bounded(spark, sf_dir))
    run("scd2", lambda: catalog_dims.scd2_apply(spark, sf_dir))
    run("sessions", lambda: catalog_stream.win_session(spark, sf_dir))
    run("stream_window", lambda: catalog_stream.stream_watermark_counts(spark, sf_dir))
    run("top_words", lambda: catalog_relational.top_words(spark, sf_dir))
    run("scoped_merge", lambda: catalog_upkeep.gold_merge(spark, sf_dir))
    run("skewed_join", lambda: catalog_relational.skewed_join(spark, sf_dir))
    from tidemark.sources.layout import metadata_count
    run("count_footers", lambda: metadata_count(spark, sf_dir + "/lineitem.parquet") and None)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "rows_in": res["silver"].rows_in,
                      "silver_rows": res["silver"].silver_rows,
                      "backfill_rows_per_sec": round(res["silver"].rows_in / max(times["backfill"], 1e-9)),
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
